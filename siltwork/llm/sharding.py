"""Shards by balanced label propagation: linked documents move together, counts stay even.

Every row starts in a shard by hash. Iterative joins then move linked rows towards the shard that most of their
neighbours are in, under quotas: a shard admits linked rows only up to its share of all rows, whole neighbourhoods
before parts of others (candidates are counted by shard and hash cell, 256 cells a shard, and cells are admitted while
they fit). On odd steps only neighbours of smaller number vote, so that two ends of a link never swap places. It ends
when no row gains by moving, or after ``steps``. What moves is counted on the driver: shards * 257 numbers a step.

A last step makes counts exact: shards differ by one row at most (law ``rows``). Rows are numbered within their shard,
linked ones first; those beyond the quota, single rows before linked ones, fill the free slots of other shards.
Numbering sorts by range over all partitions and adds up the partitions' counts, so no shard is gathered in one task.

For op2 the links join equal texts. A group of more than half a quota is split into blocks, each with a hub of its own
that links to the group's; so a group of copies however large has no more than one link for each row. ``cut_links``
counts the links whose ends are apart.

Defined results: a null text has size 16, CRC 0 and no links; null and repeated doc_ids are rows of their own; an
empty table gives an empty result; extra columns are ignored (the pipeline stage returns them beside the shard).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm._graph import apart
from siltwork.llm._store import stage

CELLS = 256


def _lookup(values: list, kind: str, at: Column) -> Column:
    """The value at this place of a list of bounded length, which travels as one literal."""
    return F.get(F.from_json(F.lit(json.dumps(values)), f"array<{kind}>"), at.cast("int"))


def propagated(links: DataFrame, labels: DataFrame, full: list[int], quota: int, steps: int = 4) -> DataFrame:
    """(node, label) after label propagation.

    links: u, v; labels: node, label, a row for every node of the links, in a table; full: the nodes of each label; quota: the most that a label admits.
    """
    shards = len(full)
    both = stage(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u <> v").distinct(), "links")
    for step in range(1, steps + 1):
        heard = both.filter("v < u") if step % 2 else both
        none = F.lit(None).cast("long")
        votes = heard.join(labels.select(F.col("node").alias("_v"), "label"), F.col("v") == F.col("_v")).select("u", "label", F.lit(1).alias("n"), F.col("v").alias("near"), F.lit(0).alias("own"))
        votes = votes.unionByName(labels.select(F.col("node").alias("u"), "label", F.lit(0).alias("n"), none.alias("near"), F.lit(1).alias("own")))
        sums = votes.groupBy("u", "label").agg(F.sum("n").alias("n"), F.min("near").alias("near"), F.max("own").alias("own"))
        # Most votes win, of equal ones the smallest shard.
        best = sums.groupBy("u").agg(F.max(F.struct("n", (-F.col("label")).alias("k"), "near")).alias("best"), F.max(F.when(F.col("own") == 1, F.struct("label", "n"))).alias("own"))
        gains = F.col("best.n") > F.col("own.n")
        state = stage(best.select(
            F.col("u").alias("node"), F.col("own.label").alias("label"), F.when(gains, (-F.col("best.k")).cast("int")).alias("to"),
            F.when(gains, F.pmod(F.xxhash64("best.near"), F.lit(CELLS)).cast("int")).alias("cell")), "state")
        wanted = {(r.to, r.cell): r.n for r in state.filter("to is not null").groupBy("to", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # shards * CELLS rows at most
        if not wanted:
            return state.select("node", "label")
        room, admitted = list(full), [False] * (shards * CELLS)
        for (to, cell), n in sorted(wanted.items()):
            if room[to] + n <= quota:
                room[to] += n
                admitted[to * CELLS + cell] = True
        moves = F.coalesce(_lookup(admitted, "boolean", F.col("to") * CELLS + F.col("cell")), F.lit(False))
        labels = state.select("node", F.when(moves, F.col("to")).otherwise(F.col("label")).alias("label"))
        if step < steps and any(admitted):
            left = {r.label: r.n for r in state.filter(moves).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
            full = [n - left.get(s, 0) for s, n in enumerate(room)]
    return labels


def evened(rows: DataFrame, shards: int) -> DataFrame:
    """Rows (at, start, linked, hub, ...) with shard and slot; counts of shards differ by one at most."""
    cols = ["start", F.when(F.col("linked"), 0).otherwise(1), "hub", "at"]
    placed = stage(rows.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranges")
    parts = placed.groupBy("_part", "start").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).collect()  # partitions + shards rows
    full, starts = [0] * shards, []
    for r in sorted(parts, key=lambda r: (r.start, r._part)):
        starts.append((r._part, r.start, full[r.start] - r.first))
        full[r.start] += r.n
    table = F.broadcast(rows.sparkSession.createDataFrame(starts, "_p int, _s int, _add long"))
    slots = placed.join(table, (F.col("_part") == F.col("_p")) & (F.col("start") == F.col("_s"))).withColumn("slot", F.col("_at") + F.col("_add")).drop("_part", "_at", "_p", "_s", "_add")
    total = sum(full)
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    over, free, taken, given = [], [], 0, 0
    for s in range(shards):
        over.append(given - quota[s])
        given += max(0, full[s] - quota[s])
        if full[s] < quota[s]:
            free.append((s, taken, full[s]))
            taken += quota[s] - full[s]
    literal = lambda xs: F.array(*map(F.lit, xs)) if xs else F.array(F.lit(0))
    moved = F.col("slot") >= F.get(literal(quota), F.col("start"))
    nth = F.col("slot") + F.get(literal(over), F.col("start"))
    # The free stretch that holds the nth place: the last that begins at or before it.
    stretch = F.size(F.filter(literal([b for _, b, _ in free]), lambda b: b <= nth)) - 1
    shard = F.when(moved, F.get(literal([s for s, _, _ in free]), stretch)).otherwise(F.col("start"))
    slot = F.when(moved, nth + F.get(literal([f - b for _, b, f in free]), stretch)).otherwise(F.col("slot"))
    return slots.select("*", shard.cast("int").alias("shard"), slot.cast("long").alias("place")).drop("slot").withColumnRenamed("place", "slot")


def equal_texts(rows: DataFrame, half: int) -> DataFrame:
    """(at, root, hub, start) of rows (at, h0, h1, start) whose digest others share; groups of more than ``half`` rows have a hub for each block."""
    groups = rows.filter("h0 is not null").groupBy("h0", "h1").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("root")).filter("c > 1").select(apart(F.col("h0")).alias("_h0"), apart(F.col("h1")).alias("_h1"), "c", "root")
    members = stage(rows.select("at", "h0", "h1", "start").join(groups, (F.col("h0") == F.col("_h0")) & (F.col("h1") == F.col("_h1"))).select(
        "at", "root", "start", F.when(F.col("c") > half, F.pmod(F.xxhash64("at", F.lit(1)), F.ceil(F.col("c") / half))).otherwise(F.lit(0)).alias("block")), "members")
    hubs = members.groupBy("root", "block").agg(F.min("at").alias("hub")).select(apart(F.col("root")).alias("_root"), F.col("block").alias("_block"), "hub")
    return stage(members.join(hubs, (F.col("root") == F.col("_root")) & (F.col("block") == F.col("_block"))).select("at", "root", "hub", "start"), "linked")


def links_of(linked: DataFrame) -> DataFrame:
    return linked.select(F.col("at").alias("u"), F.when(F.col("at") == F.col("hub"), F.col("root")).otherwise(F.col("hub")).alias("v")).filter("u <> v")


def cut_links(links: DataFrame, placed: DataFrame) -> DataFrame:
    """One row (n_links, n_cut): links (u, v), and those whose ends are in different shards; placed: at, shard."""
    of = lambda c: placed.select(F.col("at").alias(f"_{c}"), F.col("shard").alias(f"shard_{c}"))
    both = links.join(of("u"), F.col("u") == F.col("_u")).join(of("v"), F.col("v") == F.col("_v"))
    return both.agg(F.count(F.lit(1)).alias("n_links"), F.count_if(F.col("shard_u") != F.col("shard_v")).alias("n_cut"))


def sharded(rows: DataFrame, shards: int = 40, steps: int = 4) -> DataFrame:
    """Per row (at, doc_id, text) of a table with unique ``at``: at, doc_id, size, text_crc32, shard, slot; equal texts are linked."""
    text = F.col("text")
    slim = stage(rows.select(
        "at", "doc_id", (F.octet_length(F.coalesce(text, F.lit(""))) + 16).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(text.isNotNull(), F.xxhash64(text)).alias("h0"), F.when(text.isNotNull(), F.xxhash64(F.lit(7), text)).alias("h1"),
        F.pmod(F.xxhash64("at"), F.lit(shards)).cast("int").alias("start"),
    ), "slim")
    total = slim.count()
    linked = equal_texts(slim, max(1, total // (2 * shards)))
    counts = {r.start: r.n for r in linked.groupBy("start").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = propagated(links_of(linked), linked.select(F.col("at").alias("node"), F.col("start").alias("label")), [counts.get(s, 0) for s in range(shards)], total // shards, steps)
    named = linked.join(labels, F.col("at") == F.col("node")).select(F.col("at").alias("_at"), "hub", "label")
    every = slim.drop("h0", "h1").join(named, F.col("at") == F.col("_at"), "left").select(
        "at", "doc_id", "size", "text_crc32", F.coalesce("label", "start").alias("start"), F.col("hub").isNotNull().alias("linked"), F.coalesce("hub", "at").alias("hub"))
    return evened(every, shards).select("at", "doc_id", "size", "text_crc32", "shard", "slot")


def op2_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: all documents in 40 shards, law ``rows``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sharded(docs.withColumn("at", F.monotonically_increasing_id())).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the corpus pipeline: the documents with ``shard`` and ``slot`` (which replace columns of those names)."""
    rows = stage(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("at")), "numbered")
    placed = sharded(rows.select("at", "row.doc_id", "row.text")).select(F.col("at").alias("_at"), "shard", "slot")
    columns = [F.col(f"row.{c}").alias(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
    return rows.join(placed, F.col("at") == F.col("_at")).select(*columns, "shard", "slot")


QUERIES = {"op2_balanced_shards": op2_balanced_shards}
ORACLES: dict[str, str] = {}
