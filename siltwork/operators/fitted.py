"""Vectors of texts fitted to a corpus: TF-IDF weights under a fixed random projection.

Every term stands for 256 signs, the bits of its SHA-256; a text's vector is the sum of its terms' signs, each times its
occurrences and its inverse document frequency in the corpus. So the cosine of two vectors estimates that of the texts'
TF-IDF vectors, with an error of about a sixteenth. Terms that many texts have, FREQUENT at most, are summed where the
texts are read. No other term is held anywhere: its occurrences are joined to its weight by term, and a text's rows meet
in one task, in order, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.operators import bm25
from siltwork.store import small_batches, stage

DIMENSION = 256
#: Weights that a task spreads over signs at a time, texts that it reads at a time, and terms whose weights go out to all tasks.
ROWS, TEXTS, FREQUENT = 1024, 256, 1 << 18


def _bits(terms: list[bytes]) -> np.ndarray:
    """32 bytes for each term."""
    return np.frombuffer(b"".join([sha256(t).digest() for t in terms]), np.uint8).reshape(-1, DIMENSION // 8)


def _sums(bits: np.ndarray, code: np.ndarray, weight: np.ndarray, row: np.ndarray, total: np.ndarray) -> None:
    """Adds weights times the signs of their terms to the rows of ``total``; ``row`` does not fall."""
    for at in range(0, len(code), ROWS):
        c, w, r = code[at : at + ROWS], weight[at : at + ROWS], row[at : at + ROWS]
        first = np.flatnonzero(np.diff(r, prepend=-1))
        # A sign is 1 less twice the bit.
        total[r[first]] += np.add.reduceat(w, first)[:, None] - 2 * np.add.reduceat(np.unpackbits(bits[c], axis=1) * w[:, None], first, axis=0)


def _vectors(total: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1) * DIMENSION, pa.int32()), pa.array(total.ravel()))


def _frequent(idf: dict[bytes, float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows (id, t) with terms, (id, embedding, terms, tfs): the sum over terms that ``idf`` has, and the others with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weight, bits = {t: i for i, t in enumerate(idf)}, np.array([*idf.values(), np.nan]), _bits(list(idf))
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                b = whole.slice(at, TEXTS)
                words = [t.split() for t in b.column("t").cast(pa.binary()).to_pylist()]
                n = np.array([len(w) for w in words], np.int64)
                coded = pa.array(list(chain.from_iterable(words)), pa.binary()).dictionary_encode()
                size, own = max(1, len(coded.dictionary)), np.array([place.get(t, -1) for t in coded.dictionary.to_pylist()], np.int64)
                pairs, tf = np.unique(np.repeat(np.arange(len(n)), n) * size + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
                row, code, total = pairs // size, pairs % size, np.zeros((len(n), DIMENSION))
                rare = own[code] < 0
                here = own[code[~rare]]
                _sums(bits, here, tf[~rare] * weight[here], row[~rare], total)
                ends = pa.array(np.append(0, np.cumsum(np.bincount(row[rare], minlength=len(n)))), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, x) for x in (coded.dictionary.take(pa.array(code[rare])).cast(pa.string()), pa.array(tf[rare], pa.int64()))]
                yield pa.RecordBatch.from_arrays([b.column("id"), _vectors(total), *lists], names=["id", "embedding", "terms", "tfs"]).filter(pa.array(n > 0))

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, embedding) of rows (id, term, weight, embedding), of which the last or the two before are null, that come in the order of id."""
    held, total = None, None

    for b in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
        ids = b.column("id").to_numpy()
        row = np.cumsum(np.diff(ids, prepend=ids[0]) != 0)
        sums, names = np.zeros((row[-1] + 1, DIMENSION)), ids[np.flatnonzero(np.diff(row, prepend=-1))]
        whole, part = np.flatnonzero(b.column("term").is_null().to_numpy(zero_copy_only=False)), np.flatnonzero(b.column("term").is_valid().to_numpy(zero_copy_only=False))
        if len(whole):
            np.add.at(sums, row[whole], b.column("embedding").take(pa.array(whole)).flatten().to_numpy().reshape(-1, DIMENSION))
        if len(part):
            coded = b.column("term").take(pa.array(part)).cast(pa.binary()).dictionary_encode()
            _sums(_bits(coded.dictionary.to_pylist()), coded.indices.to_numpy(), b.column("weight").take(pa.array(part)).to_numpy(), row[part], sums)
        if held == names[0]:
            sums[0] += total
        elif held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), _vectors(total[None, :])], names=["id", "embedding"])
        if len(names) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(names[:-1], pa.int64()), _vectors(sums[:-1])], names=["id", "embedding"])
        held, total = names[-1], sums[-1]
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), _vectors(total[None, :])], names=["id", "embedding"])


def _joined(rows: DataFrame) -> DataFrame:
    return rows.filter("id is not null").repartition("id").sortWithinPartitions("id", "term").mapInArrow(_summed, "id long, embedding array<double>")


def _frequent_terms(weights: DataFrame) -> dict[bytes, float]:
    """The weights of the terms of most texts, at most FREQUENT; terms of equally many texts go together."""
    least, n = None, 0
    for r in weights.groupBy("df").count().orderBy(F.desc("df")).toLocalIterator():  # a row for each document count that some term has
        n += r["count"]
        if n > FREQUENT:
            break
        least = r.df
    return {} if least is None else {r.term.encode(): r.idf for r in weights.filter(F.col("df") >= least).select("term", "idf").collect()}


def fitted(corpus: DataFrame, queries: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Vectors (id, embedding) of a corpus (id, text), written, and by its weights those of queries (query_id, query) as (query_id, embedding). Texts without terms have none.

    Ids are integers that are not null; terms that the corpus lacks weigh as those of no text.
    """
    docs = bm25._texts(corpus, "id", "text").filter("id is not null").withColumn("id", F.col("id").cast("long"))
    size, counts = bm25.counted(bm25._texts(corpus, "id", "text"))
    n = size.first().n
    weights = stage(counts.withColumn("idf", F.log((F.lit(n) + 1) / (F.col("df") + 1)) + 1), "weights")
    with small_batches(corpus.sparkSession):
        parts = stage(docs.mapInArrow(_frequent(_frequent_terms(weights)), "id long, embedding array<double>, terms array<string>, tfs array<long>"), "parts")
        rare = parts.select("id", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("id", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf"))
        rare = rare.join(weights, "term").select("id", "term", (F.col("tf") * F.col("idf")).alias("weight"), F.lit(None).cast("array<double>").alias("embedding"))
        base = parts.select("id", F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("weight"), "embedding")
        own = stage(_joined(base.unionByName(rare)), "vectors")
        if queries is None:
            return own, None
        asked = bm25.postings_of(queries.select(F.col("query_id").alias("id"), F.col("query").alias("text")))
        known = weights.join(asked.select("term").distinct(), "term", "left_semi")  # so that the weights need no shuffle
        asked = asked.join(known, "term", "left").select("id", "term", (F.col("tf") * F.coalesce("idf", F.log(F.lit(n) + 1.0) + 1)).alias("weight"), F.lit(None).cast("array<double>").alias("embedding"))
        return own, stage(_joined(asked).withColumnRenamed("id", "query_id"), "vectors")
