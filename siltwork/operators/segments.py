"""A sparse index in segments: what is added is indexed alone, and the counts of all segments add up.

A segment holds the postings of the documents of one addition in blocks of at most ``BLOCK`` postings of a term (and of a
few thousand documents, so that postings travel together), each with bounds (most occurrences, shortest document), the documents with their terms, and signed changes of the terms'
document counts: an addition that replaces or removes documents takes their terms back and names them as gone from the
segments that hold them. A state is the list of its segments' names; files are never changed, so earlier states stay
readable, and two states that grew from one are joined by joining their lists. ``merged`` makes one segment of many.

Blocks are written where they are made. Which documents an addition replaces is found by ids alone, and ids that are gone
go out to the tasks, up to ``IDS`` of a segment, so that neither postings nor documents' terms are shuffled.

A search for the best k needs few blocks: the blocks with the highest bounds give every query a score that k documents
reach; a block is read only if its bound, with the highest bounds of the query's other terms, reaches that score. Where the
queries' terms have more postings in all than ``SHARE`` to a document, documents are scored where their terms are read instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwork.functions.text import tokens
from siltwork.operators import bm25
from siltwork.operators.bm25 import words_of
from siltwork.operators.caches import Folder
from siltwork.store import small_batches, stage

#: Postings of a block; segments before they are merged; blocks of each term that give a query its first scores.
BLOCK, MOST, FIRST = 128, 8, 2
#: Ids of a segment that go out to all tasks, and postings of the terms of all queries, to a document, that are joined and summed.
IDS, SHARE = 4_000_000, 1.0
#: Texts that a task counts at a time, and documents whose postings it blocks at a time.
ROWS, DOCUMENTS = bm25.ROWS, 4096
BLOCKS = "term string, ids array<long>, tfs array<int>, dls array<int>, most int, least int"
DOCS = "id long, dl long, terms array<string>, tfs array<int>"
TERMS = "term string, df long"
STATS = "n long, length long"
GONE = "segment string, id long"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the postings of rows (id, dl, terms, tfs): of each batch of documents, the postings of a term together."""
    for batch in batches:
        for at in range(0, batch.num_rows, DOCUMENTS):
            b = batch.slice(at, DOCUMENTS)
            terms = b.column("terms")
            many = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
            if not many.sum():
                continue
            coded = terms.flatten().dictionary_encode()
            code, doc = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(b.num_rows), many)
            order = np.argsort(code, kind="stable")
            code, doc, tf = code[order], doc[order], b.column("tfs").flatten().to_numpy(zero_copy_only=False)[order]
            run = np.flatnonzero(np.diff(code, prepend=-1))
            place = np.arange(len(code)) - np.repeat(run, np.diff(np.append(run, len(code))))
            start = np.flatnonzero(place % BLOCK == 0)
            ends, dl = pa.array(np.append(start, len(code)).astype(np.int32)), b.column("dl").to_numpy()[doc]
            lists = [pa.ListArray.from_arrays(ends, x) for x in (b.column("id").take(pa.array(doc)), pa.array(tf, pa.int32()), pa.array(dl, pa.int32()))]
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(code[start])), *lists, pa.array(np.maximum.reduceat(tf, start), pa.int32()), pa.array(np.minimum.reduceat(dl, start), pa.int32())], names=["term", "ids", "tfs", "dls", "most", "least"])


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """DOCS of rows (id, t): the distinct tokens of each text with their occurrences, a few hundred texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            b = batch.slice(at, ROWS)
            words, row, n = words_of(b.column("t"))
            coded = words.dictionary_encode()
            size = max(1, len(coded.dictionary))
            pairs, tf = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
            ends = pa.array(np.append(0, np.cumsum(np.bincount(pairs // size, minlength=len(n)))), pa.int32())
            terms = coded.dictionary.take(pa.array(pairs % size))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n), pa.ListArray.from_arrays(ends, terms), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))], names=["id", "dl", "terms", "tfs"])


class Segments:
    """Segments below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._many = spark, path.rstrip("/"), {}

    def _read(self, state: list[str], kind: str, schema: str) -> DataFrame:
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/{s}/{kind}").withColumn("segment", F.lit(s)) for s in state]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], f"{schema}, segment string")

    def _gone(self, names: list[str], state: list[str]) -> list[tuple[str, DataFrame]]:
        """Ids (_id) that the segments named took from segments of the state, by segment, marked to go out to all tasks if they are few."""
        at = [f"{self.path}/{s}/gone" for s in names if "gone" in Folder(self.spark, f"{self.path}/{s}").names()]
        if not at:
            return []
        gone = self.spark.read.schema(GONE).parquet(*at)
        if (key := tuple(at)) not in self._many:
            self._many[key] = {r.segment: r["count"] for r in gone.groupBy("segment").count().collect()}  # a row a segment
        those = [(s, gone.filter(F.col("segment") == s).select(F.col("id").alias("_id")), n) for s, n in sorted(self._many[key].items()) if s in state]
        return [(s, F.broadcast(ids) if n <= IDS else ids) for s, ids, n in those]

    def _live(self, rows: DataFrame, state: list[str]) -> DataFrame:
        """Rows (segment, id, ...) of documents that no later segment replaced."""
        for s, ids in self._gone(state, state):
            rows = rows.join(ids, (F.col("id") == F.col("_id")) & (F.col("segment") == s), "left_anti")
        return rows

    def added(self, state: list[str], docs: DataFrame, removed: DataFrame | None = None) -> list[str]:
        """The state with these documents (id, text), in place of those of the same ids, and without the ids of ``removed``."""
        name = f"segment-{uuid.uuid4().hex}"
        at = f"{self.path}/{name}"
        rows = docs.select(F.col("id").cast("long").alias("id"), F.lower(F.coalesce("text", F.lit(""))).alias("t"))
        with small_batches(self.spark):
            rows.mapInArrow(_forward, DOCS).write.parquet(f"{at}/docs")
        mine = self.spark.read.schema(DOCS).parquet(f"{at}/docs")
        change = mine.select("dl", "terms", F.lit(1).alias("sign"))
        ids = mine.select("id") if removed is None else mine.select("id").unionByName(removed.select("id"))
        if state:
            have = self._live(self._read(state, "docs", DOCS).select("segment", "id"), state)
            have.join(ids.distinct(), "id", "left_semi").select("segment", "id").write.parquet(f"{at}/gone")
            for s, those in self._gone([name], state):
                old = self._read([s], "docs", DOCS).join(those, F.col("id") == F.col("_id"), "left_semi")
                change = change.unionByName(old.select("dl", "terms", F.lit(-1).alias("sign")))
        change.select(F.explode("terms").alias("term"), "sign").groupBy("term").agg(F.sum("sign").alias("df")).filter("df <> 0").write.parquet(f"{at}/terms")
        change.agg(F.coalesce(F.sum("sign"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("sign") * F.col("dl")), F.lit(0)).alias("length")).write.parquet(f"{at}/stats")
        self._write_blocks(mine, at)
        state = [*state, name]
        return self.merged(state) if len(state) > MOST else state

    def _write_blocks(self, docs: DataFrame, at: str) -> None:
        """Blocks where documents are read, of some thousands of them at a time."""
        with small_batches(self.spark):
            docs.select("id", "dl", "terms", "tfs").mapInArrow(_blocks, BLOCKS).write.parquet(f"{at}/blocks")

    def merged(self, state: list[str]) -> list[str]:
        """One segment with what is live in all; texts are not read again."""
        name = f"segment-{uuid.uuid4().hex}"
        at = f"{self.path}/{name}"
        self._live(self._read(state, "docs", DOCS), state).select("id", "dl", "terms", "tfs").write.parquet(f"{at}/docs")
        self.terms(state).write.parquet(f"{at}/terms")
        self._read(state, "stats", STATS).agg(F.sum("n").alias("n"), F.sum("length").alias("length")).write.parquet(f"{at}/stats")
        self._write_blocks(self.spark.read.schema(DOCS).parquet(f"{at}/docs"), at)
        return [name]

    def drop(self, names: list[str]) -> None:
        """Removes segments that no state needs any more."""
        for name in names:
            Folder(self.spark, self.path).drop(name)

    def terms(self, state: list[str]) -> DataFrame:
        return self._read(state, "terms", TERMS).groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")

    def _postings(self, blocks: DataFrame, state: list[str]) -> DataFrame:
        each = blocks.withColumn("x", F.explode(F.arrays_zip("ids", "tfs", "dls")))
        return self._live(each.select(*[c for c in blocks.columns if c not in ("ids", "tfs", "dls")], F.col("x.ids").alias("id"), F.col("x.tfs").alias("tf"), F.col("x.dls").alias("dl")), state)

    def postings(self, state: list[str], queries: DataFrame | None = None) -> DataFrame:
        """(term, id, tf, dl, segment, ...) of live documents; with ``queries`` (query), of the blocks of their terms only."""
        blocks = self._read(state, "blocks", BLOCKS)
        if queries is not None:
            blocks = blocks.join(queries.select(F.explode(tokens(F.col("query"))).alias("term")).distinct(), "term", "left_semi")
        return self._postings(blocks, state)

    def index(self, state: list[str], queries: DataFrame | None = None) -> bm25.Bm25:
        """The index that a state is, for bm25.scores (of these queries)."""
        size = self._read(state, "stats", STATS).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("length").alias("length")).first()
        raw = stage(self.terms(state).withColumn("raw", F.log(F.lit(size.n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)), "terms")
        mean = raw.agg(F.avg("raw").alias("x")).first().x
        known = raw.select("term", "df", F.when(F.col("raw") < 0, bm25.EPSILON * F.lit(mean)).otherwise(F.col("raw")).alias("idf"))
        # As literals: rows that the driver holds would start Python workers of their own.
        stats = self.spark.range(1).select(F.lit(size.n).cast("long").alias("n"), F.lit(size.length / size.n if size.n else None).cast("double").alias("avgdl"), F.lit(mean).cast("double").alias("avg_idf"))
        docs = self._live(self._read(state, "docs", DOCS), state).select("id", "dl", "terms", "tfs")
        return bm25.Bm25(self.postings(state, queries).select("id", "dl", "term", "tf"), known, stats, docs)

    def top(self, state: list[str], queries: DataFrame, k: int, digits: int = 6) -> DataFrame:
        """(query_id, id, score, rank): the best ``k`` of each query (query_id, query) by BM25, reading the blocks that can matter, or documents where those would be most."""
        ix = self.index(state, queries)
        asked = queries.select("query_id", F.explode(tokens(F.col("query"))).alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qf"))
        asked = stage(asked.join(ix.terms, "term").join(F.broadcast(ix.stats.select("avgdl"))), "asked")
        size = asked.join(F.broadcast(ix.stats.select("n"))).agg(F.min("idf").alias("least"), F.sum("df").alias("postings"), F.max("n").alias("n")).first()
        if size.n and (size.least < 0 or size.postings > SHARE * size.n):  # no bound holds for parts of a score that lower it
            return bm25.nearest(ix, queries, k, digits=digits).drop("norm")
        part = lambda tf, dl: F.col("qf") * F.col("idf") * tf * (bm25.K1 + 1) / (tf + bm25.K1 * (1 - bm25.B + bm25.B * dl / F.col("avgdl")))
        blocks = self._read(state, "blocks", BLOCKS).join(asked, "term").withColumn("bound", part(F.col("most"), F.col("least")))
        order = Window.partitionBy("query_id", "term").orderBy(F.desc("bound"), "segment", F.get("ids", F.lit(0)))
        scores = lambda rows: self._postings(rows, state).groupBy("query_id", "id").agg(F.sum(part(F.col("tf"), F.col("dl"))).alias("score"))
        first = blocks.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= FIRST)
        floor = bm25.top(scores(first), k, digits=digits).filter(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("score").alias("floor"))
        most = blocks.groupBy("query_id", "term").agg(F.max("bound").alias("bound"))
        limits = most.join(floor, F.col("query_id") == F.col("_q"), "left").select("query_id", "term", "bound", "floor")
        total = most.groupBy(F.col("query_id").alias("_q")).agg(F.sum("bound").alias("total"))
        # A block must reach this; rounding at the last digits is allowed for.
        limits = stage(limits.join(total, F.col("query_id") == F.col("_q")).select(F.col("query_id").alias("_q"), F.col("term").alias("_t"), (F.coalesce("floor", F.lit(0.0)) - F.col("total") + F.col("bound") - 10.0**-digits).alias("needed")), "limits")
        needed = blocks.join(limits, (F.col("query_id") == F.col("_q")) & (F.col("term") == F.col("_t")) & (F.col("bound") >= F.col("needed")))
        return bm25.top(scores(needed), k, digits=digits)
