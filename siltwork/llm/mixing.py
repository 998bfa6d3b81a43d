"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Every document starts with rate q (1 by default). Of all rates up to ``most``, those nearest to q in Kullback-Leibler
divergence, weighted by size, are sought under token constraints of two kinds: each source's words sum to the source's
target, exactly; and the words of each moment, by default of each band of document length, sum to the moment's share of
the corpus, softly: a gap costs its square, so that constraints which contradict each other still have a solution. The
solution has the form r = least(most, q * exp(l of the source + m of the document's moments)).

Newton iterations solve the convex dual for m. For given m the multiplier l of each source has a closed form (documents
that stop at ``most`` are those of the largest tilts), so iterations run over the sources' distributed sums with l
eliminated; gradient and Hessian have one row for each moment, whatever the number of sources and documents.

Rates are then rounded to whole copies: sources are split by hash into blocks of about ``block`` documents, and in each
block, from the largest document to the smallest, what rounding left over is carried to the next document, so that a
block ends within a small document of its target. Rows that agree in key, size and rate are one record with a count
until the end, however many they are. All choices hang on the rows alone: reruns agree.

Defined results: a null text has size 0 and takes 0 words; a null source is a source of its own, last in order; an
empty table gives an empty result; repeated rows are documents of their own. Extra columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwork.llm._store import stage
from siltwork.llm._text import n_words_of

#: Tables of sources up to this many rows are broadcast; larger ones join by shuffle.
MOST_BROADCAST = 50_000
#: The bands of document length in words: up to each of these, and beyond.
BANDS = (100, 300, 1000)
#: How much a moment may miss its share: the gap over the share is this times the moment's multiplier.
SOFT = 0.02
#: Documents of one fold of the rounding, whose decisions are the bits of a number.
FOLD = 32


def _bounded(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= MOST_BROADCAST else table


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size).

    Sources in order take the weights in turn. A target stops at ``most`` times its source's size; the excess is
    reshared by weight until none is above: sorted by size over weight, those below the final level are capped.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("double")
    t = sizes.withColumn("w", w).withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    every = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("all", share * F.sum("source_size").over(every)).withColumn("all_w", F.sum("w").over(every))
    # If all sources before this one in the order are capped, the rest share what is left at this level.
    t = t.withColumn("level", (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(every)
    t = t.withColumn("final", first["level"])
    return t.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("w"), F.col("cap"))).alias("target"))


def length_bands(size: Column) -> list[Column]:
    """One indicator for each band of document length."""
    edges = (0, *BANDS)
    return [((size > a) & (size <= b)).cast("double") for a, b in zip(edges, BANDS, strict=False)] + [(size > BANDS[-1]).cast("double")]


def _tilts(cells: Column, m: list[float]) -> Column:
    """Cells with ``w``, q tilted by the moments, from the largest to the smallest."""
    power = lambda c: F.aggregate(F.zip_with(c["x"], F.array(*map(F.lit, m)), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.array_sort(F.transform(cells, lambda c: F.struct((-c["q"] * F.exp(power(c))).alias("k"), c["size"].alias("size"), c["x"].alias("x"))))


def _scale(tilted: Column, target: Column, most: float) -> Column:
    """exp(l): what tilts times it, held to ``most``, sum to the target."""
    rest = F.aggregate(tilted, F.lit(0.0), lambda s, c: s - c["size"] * c["k"])

    def stop(s: Column, c: Column) -> Column:
        full = (target - s["held"]) * -c["k"] > most * s["rest"]
        return F.struct(F.when(full, s["held"] + most * c["size"]).otherwise(s["held"]).alias("held"), F.when(full, s["rest"] + c["size"] * c["k"]).otherwise(s["rest"]).alias("rest"))

    return F.aggregate(tilted, F.struct(F.lit(0.0).cast("double").alias("held"), rest.alias("rest")), stop, lambda s: F.when(s["rest"] > 0, F.greatest(target - s["held"], F.lit(0.0)) / s["rest"]).otherwise(F.lit(1e300)))


def balanced(docs: DataFrame, goals: DataFrame, n: int, most: float = 2.0, steps: int = 30, within: float = 1e-9, soft: float = SOFT) -> tuple[DataFrame, list[float], int]:
    """((source, scale), multipliers of the moments, Newton steps taken); docs: source, size, q and x, an array of ``n`` moments.

    A document's rate is least(most, q * scale * exp(multipliers . x)). Documents of a source that agree in q and x are
    summed first; a source has as many such cells as there are combinations of the moments and of q, and they meet in
    one row. With the bands of length and q from a fixed grid that is a bounded number; a continuous q has to be rounded
    to one before it is passed.
    """
    per = docs.groupBy("source", "q", "x").agg(F.sum("size").cast("double").alias("size")).filter("size > 0")
    cells = per.groupBy("source").agg(F.collect_list(F.struct("q", "x", "size")).alias("cells"), F.sum("size").alias("own"), *[F.sum(F.col("size") * F.col("x")[i]).alias(f"s{i}") for i in range(n)])
    cells = stage(cells.join(_bounded(goals.select(F.col("source").alias("_s"), "target")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "cells")
    whole = cells.agg(F.sum("own").alias("own"), F.sum("target").alias("target"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(n)]).first()
    share = np.array([whole.target * whole[f"s{i}"] / whole.own for i in range(n)]) if whole.own else np.zeros(n)
    live, m, taken = np.flatnonzero(share > 0), np.zeros(n), 0
    pairs = [(i, j) for i in live for j in live if j <= i]
    for _ in range(steps if len(live) else 0):
        tilted = cells.select("source", "target", _tilts(F.col("cells"), m.tolist()).alias("tilted"))
        flat = tilted.select("source", _scale(F.col("tilted"), F.col("target"), most).alias("scale"), "tilted").select("source", "scale", F.explode("tilted").alias("c"))
        tilt = F.col("scale") * -F.col("c.k")
        flat = flat.select("source", (F.col("c.size") * F.least(F.lit(most), tilt)).alias("w"), F.when(tilt < most, F.col("c.size") * tilt).otherwise(0.0).alias("free"), F.col("c.x").alias("x"))
        sums = flat.groupBy("source").agg(
            F.sum("free").alias("h"), *[F.sum(F.col("w") * F.col("x")[int(i)]).alias(f"f{i}") for i in live], *[F.sum(F.col("free") * F.col("x")[int(i)]).alias(f"g{i}") for i in live],
            *[F.sum(F.col("free") * F.col("x")[int(i)] * F.col("x")[int(j)]).alias(f"a{i}_{j}") for i, j in pairs])
        # A source's multiplier follows the moments', which takes a rank-one part out of its share of the Hessian.
        got = sums.agg(*[F.sum(f"f{i}").alias(f"f{i}") for i in live], *[F.sum(F.col(f"a{i}_{j}") - F.coalesce(F.try_divide(F.col(f"g{i}") * F.col(f"g{j}"), "h"), F.lit(0.0))).alias(f"h{i}_{j}") for i, j in pairs]).first()
        gap = share[live] - np.array([got[f"f{i}"] for i in live]) - soft * share[live] * m[live]
        if np.abs(gap).max() <= within * whole.target:
            break
        step = np.linalg.solve(np.array([[got[f"h{max(i, j)}_{min(i, j)}"] for j in live] for i in live]) + soft * np.diag(share[live]), gap)
        m[live] += step * min(1.0, 1.0 / max(1e-12, np.abs(step).max()))
        taken += 1
    m = np.round(m, 10)  # sums over partitions differ in their last bits from run to run
    return cells.select("source", _scale(_tilts(F.col("cells"), m.tolist()), F.col("target"), most).alias("scale")), m.tolist(), taken


def _rounded(docs: Column) -> Column:
    """Of each document of a block, in order, how many of its ``n`` rows get one copy beyond the whole part of the rate.

    What rounding owes is carried on. Decisions of FOLD documents are gathered in one array, so no array grows by single elements beyond that.
    """
    empty = F.array().cast("array<long>")

    def add(s: Column, d: Column) -> Column:
        owed = s["owed"] + d["size"] * d["n"] * (d["rate"] - F.floor(d["rate"]))
        fits = F.when((d["size"] > 0) & (d["rate"] > F.floor(d["rate"])), F.least(d["n"], F.greatest(F.lit(0), F.floor(owed / d["size"] + 0.5)))).otherwise(0).cast("long")
        return F.struct((owed - fits * d["size"]).cast("double").alias("owed"), F.concat(s["more"], F.array(fits)).alias("more"))

    def fold(s: Column, part: Column) -> Column:
        begin = F.struct(F.element_at(s, -1)["owed"].alias("owed"), empty.alias("more"))
        return F.concat(s, F.array(F.aggregate(part, begin, add)))

    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(docs) / FOLD).cast("int") - 1, F.lit(0))), lambda i: F.slice(docs, i * FOLD + 1, FOLD))
    return F.flatten(F.transform(F.aggregate(parts, F.array(F.struct(F.lit(0.0).alias("owed"), empty.alias("more"))), fold), lambda s: s["more"]))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, q: Column | None = None, block: int = 256, key: str = "doc_id", moments=length_bands) -> DataFrame:
    """Per row of ``docs``: its ``key``, source, size, source_size, target, rate, copies, taken."""
    sized = docs.select(key, "source", n_words_of(F.col("text")).alias("size"), (F.lit(1.0) if q is None else q).cast("double").alias("q"))
    own = moments(F.col("size"))
    sized = stage(sized.withColumn("x", F.array(*own).cast("array<double>")).groupBy(key, "source", "size", "q", "x").agg(F.count(F.lit(1)).alias("n")), "sizes")
    rows = sized.withColumn("size", F.col("size") * F.col("n"))
    sums = stage(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("records")), "sources")
    goals = stage(targets(sums.select("source", "source_size"), weights, share, most), "targets")
    scales, m, _ = balanced(rows, goals, len(own), most)
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    table = goals.join(sums.select(F.col("source").alias("_n"), "records"), same("source", "_n")).drop("_n").join(scales.withColumnRenamed("source", "_s"), same("source", "_s"), "left").drop("_s")
    table = stage(table.withColumnRenamed("source", "_s"), "table")
    power = F.aggregate(F.zip_with("x", F.from_json(F.lit(json.dumps(m)), "array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x) if m else F.lit(0.0)
    rate = F.when(F.col("size") > 0, F.least(F.col("q") * F.coalesce("scale", F.lit(1.0)) * F.exp(power), F.lit(most))).otherwise(F.least(F.col("q"), F.lit(most)))
    near = F.round(rate)
    # Rates that are whole but for the last bits are whole.
    rated = sized.join(_bounded(table), same("source", "_s")).withColumn("rate", F.when(F.abs(rate - near) < 1e-9, near).otherwise(rate))
    part = F.pmod(F.xxhash64(key, "size"), F.ceil(F.col("records") / block))
    blocks = rated.groupBy("source", part.alias("part"), "source_size", "target").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("k"), key, "size", "rate", "n"))).alias("docs")
    ).withColumn("more", _rounded(F.col("docs")))
    found = blocks.select("source", "source_size", "target", F.explode(F.arrays_zip("docs", "more")).alias("d")).select(
        F.col(f"d.docs.{key}").alias(key), "source", F.col("d.docs.size").alias("size"), "source_size", "target", F.col("d.docs.rate").alias("rate"), F.col("d.docs.n").alias("n"), F.col("d.more").alias("more"))
    # Records become rows again, a thousand at a time.
    found = found.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(1000).cast("long"))))
    found = found.withColumn("_nth", F.explode(F.sequence("_from", F.least(F.col("_from") + 999, F.col("n") - 1))))
    copies = (F.floor("rate") + (F.col("_nth") < F.col("more")).cast("long")).cast("int")
    return found.withColumn("copies", copies).select(key, "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op10_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: all documents, weights 5, 2, 1 in turn, 150 % of all words, two copies at most, bands of length as moments."""
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the corpus pipeline: every row as often as the mix takes it; a document without words is kept once.

    Rows are numbered in a staged copy, so that repeated rows and null doc_ids are rows of their own.
    """
    rows = stage(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("at")), "numbered")
    taken = mixed(rows.select("at", "row.source", "row.text"), key="at").select(F.col("at").alias("_at"), F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies")).alias("n")).filter("n > 0")
    return rows.join(taken, F.col("at") == F.col("_at")).select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


QUERIES = {"op10_entropy_mix": op10_entropy_mix}
ORACLES: dict[str, str] = {}
