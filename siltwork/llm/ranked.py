"""Ranked lexical search over a tiered index, exact for every item.

The index is a table with a row for each shard, which is the documents of a few MB of text. A shard's postings (term,
document, occurrences) stand in tiers by their impact, as estimated from the shard's own frequencies: a column set for
each tier, so that a search reads the columns of the tiers that it needs. Beside a tier stands, for each term, what
bounds the postings below it: the most occurrences and the shortest document among them. Any statistics of the whole
collection turn these into a bound on a posting's part of a score, so the index does not depend on how the estimate
came out, and shards can be added without touching the others.

A search counts its terms' documents over all shards, then scores the first tier of every shard. What the postings read
so far add up to is at least there of a document's score; with the bounds of the terms not yet seen in it, it is at most
so much. An item's 20th best score so far is a floor: a shard none of whose documents can reach it is done with for that
item, and one whose bounds are all zero is complete. Shards that lack either proof fall through to the next tier, for
these items alone; the last tier leaves no bound. So the ranking is that of all documents, ties included.

Items are worked off in blocks of at most ``block`` items and about ``block_bytes`` of text; what is broadcast (the
block's terms, weights and floors) is bounded by them, as is what the driver gets. A task keeps its own 20 best scores of
each item and sends only what can still matter.

Defined results: a null or empty text, and one without a term, is no document of the collection and is never found; items
that are null or without terms find nothing; equal rows of items count once, other rows with one item_id are ranked each;
documents with one doc_id are ranked each, null doc_ids after all others; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwork.llm._store import stage
from siltwork.llm._text import pieces, small_batches

#: Bytes that separate terms become spaces, and A-Z lower case.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
#: Least impact of a posting in all tiers but the last, as a share of the largest that a shard can hold.
TIERS = (0.2, 0.08)
TOP = 20
#: Shards up to which the list of those that are open is broadcast.
FEW = 100_000
#: Cells (documents by items) that a task holds at a time.
CELLS = 1 << 20
FIXED = "shard long, docs long, terms long, doc_id array<long>, n array<int>, term array<string>, df array<int>"
PAIR = "item int, shard long, upper long, whole boolean, found array<struct<doc_id:long,score:long>>"


def terms_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(FOLD).split()


def _runs(starts: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``many`` of them, one run after another."""
    return np.arange(int(many.sum())) + np.repeat(starts - np.cumsum(many) + many, many)


def _columns(tier: int, last: int) -> list[str]:
    return [f"c{tier}", f"d{tier}", f"f{tier}", *([f"most{tier}", f"least{tier}"] if tier < last else [])]


def _shard(number: int, ids: pa.Array, texts: list[str | None], tiers: tuple[float, ...]) -> dict:
    """A shard's row; documents are in the order of doc_id, null ones last."""
    words = [terms_of(t) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    order = pc.sort_indices(ids).to_numpy()
    order = order[n[order] > 0]
    n = n[order]
    coded = pa.array([x for i in order.tolist() for x in words[i]], pa.binary()).dictionary_encode()
    docs, size = len(order), len(coded.dictionary)
    key, tf = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(1, docs) + np.repeat(np.arange(docs), n), return_counts=True)
    term, doc = key // max(1, docs), key % max(1, docs)
    df = np.bincount(term, minlength=size)
    # The impact by the shard's own numbers, over that of a term of one document that has nothing else.
    total = max(1, int(n.sum()))
    impact = (np.log((2 * docs + 2) / (2 * df + 1)) / math.log((2 * docs + 2) / 3) if docs else np.empty(0))[term] * tf / (tf + 0.012 * (75 + 25 * n[doc] * docs / total))
    tier = sum(((impact < t).astype(np.int64) for t in tiers), np.zeros(len(term), np.int64))
    out = {"shard": number, "docs": docs, "terms": int(n.sum()), "doc_id": ids.take(pa.array(order)), "n": n, "term": coded.dictionary.cast(pa.string()), "df": df}
    for k in range(len(tiers) + 1):
        at = np.flatnonzero(tier == k)
        out |= {f"c{k}": np.bincount(term[at], minlength=size), f"d{k}": doc[at], f"f{k}": tf[at]}
        if k < len(tiers):
            below = np.flatnonzero(tier > k)
            most, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int32).max, np.int64)
            np.maximum.at(most, term[below], tf[below])
            np.minimum.at(least, term[below], n[doc[below]])
            out |= {f"most{k}": most, f"least{k}": least}
    return out


def build(docs: DataFrame, tiers: tuple[float, ...] = TIERS, shard: int = 2_000_000) -> DataFrame:
    """The index of all rows of ``docs``, written: a row for each shard of about ``shard`` bytes of text."""
    last = len(tiers)
    schema = FIXED + "".join(f", {c} array<int>" for k in range(last + 1) for c in _columns(k, last))
    names = [x.split()[0] for x in schema.split(", ")]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for b in pieces(batches, "text", shard):
            row = _shard((part << 33) + seq, b.column("doc_id").cast(pa.int64()), b.column("text").to_pylist(), tiers)
            seq += 1

            def column(x) -> pa.Array:
                if isinstance(x, int):
                    return pa.array([x], pa.int64())
                x = x if isinstance(x, pa.Array) else pa.array(x, pa.int32())
                return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)

            yield pa.RecordBatch.from_arrays([column(row[c]) for c in names], names=names)

    with small_batches(docs.sparkSession):
        return stage(docs.select("doc_id", "text").mapInArrow(made, schema), "tiers", maxRecordsPerFile=8)


@dataclass
class Block:
    """Items of one block: their distinct terms in order, and for each term the items that ask it and how often."""

    terms: pa.Array
    starts: np.ndarray
    items: np.ndarray
    often: np.ndarray
    size: int
    weights: np.ndarray = None
    rows: int = 0
    total: int = 0

    @staticmethod
    def of(texts: list[str | None]) -> Block:
        asked = sorted((t, i, n) for i, text in enumerate(texts) for t, n in Counter(terms_of(text)).items())
        terms = sorted({t for t, _, _ in asked})
        place = {t: v for v, t in enumerate(terms)}
        v = np.array([place[t] for t, _, _ in asked], np.int64)
        starts = np.searchsorted(v, np.arange(len(terms) + 1))
        return Block(pa.array(terms, pa.binary()).cast(pa.string()), starts, np.array([i for _, i, _ in asked], np.int64), np.array([n for _, _, n in asked], np.int64), len(texts))

    def shares(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The part of a posting's score that its term's weight is multiplied with."""
        m = 75 + 25 * n * self.rows // max(1, self.total)
        return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _cells(block: Block, open_: np.ndarray, docs: int, d: np.ndarray, v: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """For each of ``values`` of postings (document d, term v): sums by document and open item, times how often the item asks the term.

    Terms that many items ask are multiplied as matrices, the others one by one.
    """
    place = np.full(block.size, -1)
    place[open_] = np.arange(len(open_))
    asked = place[block.items] >= 0
    of = np.repeat(np.arange(len(block.starts) - 1), np.diff(block.starts))[asked]
    items, often = place[block.items[asked]], block.often[asked]
    many = np.bincount(of, minlength=len(block.starts) - 1)
    starts = np.cumsum(many) - many
    # Sums stay below this bound, so that products of doubles are whole numbers.
    small = float(often.sum()) * float(block.weights.max(initial=0)) * 1e6 < 2**53
    hot = np.flatnonzero(many > max(8, len(open_) // 16)) if small else np.empty(0, np.int64)
    number = np.full(len(many), -1)
    number[hot] = np.arange(len(hot))
    one = np.flatnonzero(number[v] < 0)
    rest = one[many[v[one]] > 0]
    spread = _runs(starts[v[rest]], many[v[rest]])
    cell = np.repeat(d[rest], many[v[rest]]) * len(open_) + items[spread]
    both = np.flatnonzero(number[v] >= 0)
    by_item = np.zeros((len(hot), len(open_)))
    warm = number[of] >= 0
    by_item[number[of[warm]], items[warm]] = often[warm]
    out = []
    for x in values:
        total = np.zeros(docs * len(open_), np.int64)
        np.add.at(total, cell, np.repeat(x[rest], many[v[rest]]) * often[spread])
        total = total.reshape(docs, len(open_))
        if len(both):
            dense = np.zeros((docs, len(hot)))
            dense[d[both], number[v[both]]] = x[both]  # a posting for each document and term
            total += (dense @ by_item).astype(np.int64)
        out.append(total)
    return out


def _scored(row: dict[str, np.ndarray], block: Block, tier: int, last: int, open_: np.ndarray, floor: np.ndarray) -> Iterator[tuple[int, int, bool, np.ndarray, np.ndarray]]:
    """(item, upper, whole, documents, scores) of the open items of a shard whose tiers up to ``tier`` are read, where they can still matter; raises the floors."""
    local = pc.fill_null(pc.index_in(row["term"], value_set=block.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    hit = np.flatnonzero(local >= 0)
    n = row["n"].astype(np.int64)
    docs = len(n)
    if not docs or not len(open_):
        return
    parts = []
    for k in range(tier + 1):
        count = row[f"c{k}"].astype(np.int64)
        at = _runs((np.cumsum(count) - count)[hit], count[hit])
        parts.append((np.repeat(local[hit], count[hit]), row[f"d{k}"][at].astype(np.int64), row[f"f{k}"][at].astype(np.int64)))
    v, d, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
    impact = block.weights[v] * block.shares(tf, n[d])
    rest = np.zeros(len(block.terms), np.int64)
    if tier < last:
        most, least = row[f"most{tier}"][hit].astype(np.int64), row[f"least{tier}"][hit].astype(np.int64)
        rest[local[hit]] = np.where(most > 0, block.weights[local[hit]] * block.shares(most, np.where(most > 0, least, 0)), 0)
    of = np.repeat(np.arange(len(block.terms)), np.diff(block.starts))
    beyond = np.zeros(block.size, np.int64)
    np.add.at(beyond, block.items, block.often * rest[of])
    step = max(1, CELLS // docs)
    for some in (open_[i : i + step] for i in range(0, len(open_), step)):
        low, *seen = _cells(block, some, docs, d, v, [impact, rest[v]] if tier < last else [impact])
        upper = low + beyond[some] - seen[0] if seen else low
        best = upper.max(axis=0)
        least = np.partition(low, docs - TOP, axis=0)[docs - TOP] if docs > TOP else np.zeros(len(some), np.int64)
        doc, item = np.nonzero(low >= np.maximum(least, floor[some]))
        score = low[doc, item]
        order = np.lexsort((doc, -score, item))
        doc, item, score = doc[order], item[order], score[order]
        first = np.searchsorted(item, np.arange(len(some) + 1))
        for i, whole in enumerate((beyond[some] == 0).tolist()):
            own = slice(first[i], min(first[i] + TOP, first[i + 1]))
            if own.start < own.stop or (best[i] >= floor[some[i]] and not whole):
                yield int(some[i]), int(best[i]), whole, doc[own], score[own]


def _pairs(index: DataFrame, block: Block, tier: int, last: int, floor: np.ndarray) -> DataFrame:
    """(item, shard, upper, whole, found) by the tiers up to ``tier``; index may have a column ``open``, the items that are sought."""
    shared = index.sparkSession.sparkContext.broadcast((vars(block), floor))
    columns = ["shard", "doc_id", "n", "term", *[c for k in range(tier) for c in _columns(k, last)[:3]], *_columns(tier, last), *[c for c in index.columns if c == "open"]]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, floor = Block(**shared.value[0]), shared.value[1].copy()
        kept: dict[int, np.ndarray] = {}
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].values if c != "shard" else b.column(c)[r].as_py() for c in columns}
                row = {c: x if c in ("shard", "term", "doc_id") else x.to_numpy() for c, x in row.items()}
                open_ = np.sort(row["open"]) if "open" in row else np.arange(block.size)
                out = list(_scored(row, block, tier, last, open_.astype(np.int64), floor))
                for item, _, _, _, score in out:
                    kept[item] = best = np.sort(np.concatenate([kept.get(item, score[:0]), score]))[-TOP:]
                    if len(best) == TOP:
                        floor[item] = max(floor[item], best[0])
                many = np.array([len(x[3]) for x in out], np.int64)
                docs = np.concatenate([x[3] for x in out]) if out else np.empty(0, np.int64)
                score = np.concatenate([x[4] for x in out]) if out else docs
                found = pa.StructArray.from_arrays([row["doc_id"].take(pa.array(docs)), pa.array(score)], ["doc_id", "score"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int32()), pa.array([row["shard"]] * len(out), pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.bool_()),
                     pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)), pa.int32()), found)], names=["item", "shard", "upper", "whole", "found"])

    with small_batches(index.sparkSession):
        return stage(index.select(*columns).mapInArrow(search, PAIR), "scored")


def _ranked(pairs: DataFrame) -> DataFrame:
    """(item, rank, doc_id, score) of the best in these rows."""
    each = pairs.select("item", F.explode("found").alias("x")).select("item", "x.doc_id", "x.score")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)


def _frequencies(index: DataFrame, block: Block) -> np.ndarray:
    """Documents of the whole collection that hold each term of the block."""
    terms = block.terms

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for b in batches:
            for r in range(b.num_rows):
                at = pc.index_in(b.column("term")[r].values, value_set=terms)
                there = at.is_valid().to_numpy(zero_copy_only=False)
                total[at.drop_null().to_numpy()] += b.column("df")[r].values.to_numpy()[there]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["v", "df"])

    out = np.zeros(len(terms), np.int64)
    with small_batches(index.sparkSession):
        found = index.select("term", "df").mapInArrow(count, "v long, df long").groupBy("v").agg(F.sum("df").alias("df")).toArrow()  # the block's terms at most
    out[found["v"].to_numpy()] = found["df"].to_numpy()
    return out


def _searched(index: DataFrame, block: Block, last: int) -> DataFrame:
    """(item, rank, doc_id, score) of one block's items."""
    floor, done, rows = np.ones(block.size, np.int64), [], index
    for tier in range(last + 1):
        now = _pairs(rows, block, tier, last, floor)
        done.append(now.filter("whole"))
        if tier < last:
            every = reduce(DataFrame.unionByName, [*done, now.filter("not whole")])
            for r in _ranked(every).filter(F.col("rank") == TOP).collect():  # a row for each item of the block at most
                floor[r.item] = max(floor[r.item], r.score)
            least = F.get(F.lit(floor.tolist()), F.col("item"))
            left = stage(now.filter(~F.col("whole") & (F.col("upper") >= least)).groupBy("shard").agg(F.collect_list("item").alias("open")), "open")
            few = left.count()
            rows = index.join(F.broadcast(left) if few <= FEW else left, "shard")
    return _ranked(reduce(DataFrame.unionByName, done))


def search(index: DataFrame, items: DataFrame, block: int = 1000, block_bytes: int = 256_000) -> DataFrame:
    """(item_id, rank, doc_id, score): of each item (item_id, text) the best TOP documents of an index (see ``build``) with a score above 0."""
    spark = items.sparkSession
    items = items.filter("text is not null").select("item_id", "text").distinct()
    last = sum(c.startswith("c") and c[1:].isdigit() for c in index.columns) - 1
    size = index.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first()
    r = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    parts, out = max(1, -(-r.n // block), -(-r.bytes // block_bytes)), []
    kind = items.schema["item_id"].dataType.simpleString()
    for i in range(parts):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).collect()  # a block
        asked = Block.of([x.text for x in mine])
        if not len(asked.terms) or not size.docs:
            continue
        asked.rows, asked.total = size.docs, size.terms
        asked.weights = np.floor(1000 * np.log((2 * size.docs + 2) / (2 * _frequencies(index, asked) + 1))).astype(np.int64)
        names = spark.createDataFrame([(k, x.item_id) for k, x in enumerate(mine)], f"item int, item_id {kind}")
        out.append(_searched(index, asked, last).join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


def op13_tiered_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: all benchmark items against an index of all documents."""
    return search(build(spark.read.parquet(f"{sf_dir}/documents.parquet")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Every document that shares a term with an item, scored and ranked.
OP13_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY ALL),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM d),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, docs),
q AS (SELECT item_id, term, count(*) AS qf FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
r AS (SELECT item_id, doc_id, sum(qf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (doc_id), s GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 20
"""

QUERIES = {"op13_tiered_search": op13_tiered_search}
ORACLES = {"op13_tiered_search": OP13_SQL}
