"""Toxicity by logistic regression over hashed word n-grams and skip-grams, trained with FTRL-proximal.

A document's features are its distinct words (lower-cased in A-Z, without punctuation at their ends), the first 4 and
6 bytes of words, which compounds of a word share, pairs of neighbours and pairs with one word between, hashed to 2^20
places, pairs to one half and the rest to the other. Each counts once, pairs with value 0.4, so length alone scores
nothing. FTRL-proximal keeps a learning rate for each coordinate, and its L1 term leaves few weights that are not zero:
these are all that is broadcast, at most 2^20. Features of fewer than three training documents are left out.

The model is fitted on a bounded sample, ``most`` labelled documents in the order of a hash of doc_id and ``most_places``
of their features, in one task whose memory these parameters bound; every document is scored over its whole text. Rows with crc32(doc_id) mod 5 = 0
are held out of training. Labels, lang, source and doc_id are no inputs of a score.

Defined results: a null or empty text gets the score of no features; a null doc_id counts as held out; labels that are
null count for nothing, and a document labelled twice is toxic if either says so; without labels of both kinds every
score is the same, below 0.5, and nothing is predicted; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm._text import hashes, mix, pieces, small_batches

BITS = 20
HALF = 1 << (BITS - 1)
#: The intercept without labels of both kinds: nothing is predicted.
UNLEARNED = -2.0
STEMS, PAIR_VALUE, LEAST_DOCS = (4, 6), 0.4, 3
PUNCTUATION = b".,;:!?\"'()[]{}"
_PAIR, _SKIP = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all features of the texts, repeats included, and the number of the text that each comes from."""
    words = [[] if t is None else [w.strip(PUNCTUATION) for w in t.encode().lower().split()] for t in texts]
    flat = list(chain.from_iterable(words))
    h = mix(hashes(flat))
    doc = np.repeat(np.arange(len(texts)), np.fromiter(map(len, words), np.int64, len(words)))
    low = np.uint64(64 - BITS + 1)
    found, of = [h >> low], [doc]
    for k in STEMS:
        found.append(mix(hashes([w[:k] for w in flat]) + np.uint64(k)) >> low)
        of.append(doc)
    for gap, salt in ((1, _PAIR), (2, _SKIP)):
        if len(h) > gap:
            same = doc[gap:] == doc[:-gap]
            found.append((mix(h[:-gap] * salt + h[gap:])[same] >> low) + np.uint64(HALF))
            of.append(doc[gap:][same])
    return np.concatenate(found).astype(np.int64), np.concatenate(of)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "text", 2_000_000):
        place, doc = features(b.column("text").to_pylist())
        key = np.unique((doc << BITS) | place)
        counts = np.bincount(key >> BITS, minlength=b.num_rows)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        at = pa.ListArray.from_arrays(offsets, pa.array((key & ((1 << BITS) - 1)).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([b.column("k"), b.column("y"), at], names=["k", "y", "at"])


def ftrl(rows: list[tuple[int, np.ndarray]], epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 1.5, l2: float = 0.01) -> tuple[np.ndarray, float]:
    """Weights and intercept after ``epochs`` passes over (label, places)."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(at) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(epochs):
        for y, places in rows:
            at, x = np.append(places, 1 << BITS), np.append(np.where(places < HALF, 1.0, PAIR_VALUE), 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - rate * w
            n[at] += g * g
    w = weights(np.arange((1 << BITS) + 1))
    return w[:-1], float(w[-1])


def _fitted(most: int):
    """Reads labelled rows in order, as far as ``most`` places go, and gives the weights that are not zero, and the intercept at place -1."""

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, rows, left = [], [], most
        for b in batches:
            ends = b.column("at").offsets.to_numpy()
            at = b.column("at").values.to_numpy()
            for y, lo, hi in zip(b.column("y").to_pylist(), ends.tolist(), ends[1:].tolist(), strict=False):
                if (left := left - (hi - lo)) < 0:
                    break
                labels.append(y)
                rows.append(at[lo:hi].copy())
            if left < 0:
                break
        for _ in batches:  # what the bound leaves out is read, so that Spark can end the task
            continue
        if len(set(labels)) < 2:
            found = [-1], [UNLEARNED]
        else:
            docs = np.zeros(1 << BITS, np.int64)
            for r in rows:
                docs[r] += 1  # places are distinct
            w, b = ftrl([(y, r[docs[r] >= LEAST_DOCS].astype(np.int64)) for y, r in zip(labels, rows, strict=True)])
            at = np.flatnonzero(w)
            found = np.append(at, -1), np.append(w[at], b)
        yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.float64())], names=["at", "w"])

    return fitted


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, most: int = 12_000, most_places: int = 1 << 26) -> tuple[np.ndarray, np.ndarray, float]:
    """(places, weights, intercept) from at most ``most`` labelled rows that are not held out, and as many of them as ``most_places`` features (4 bytes each) go."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("y"))
    chosen = known.filter(~held_out(F.col("_id"))).select("_id", "y", F.xxhash64("_id").alias("k")).orderBy("k", "_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("k", F.col("y").cast("int").alias("y"), "text")
    featured = rows.mapInArrow(_featured, "k long, y int, at array<int>").repartition(1).sortWithinPartitions("k", "y")
    with small_batches(docs.sparkSession):
        found = featured.mapInArrow(_fitted(most_places), "at long, w double").toArrow()  # 2^20 rows at most
    at, w = found["at"].to_numpy(), found["w"].to_numpy()
    return at[at >= 0], w[at >= 0], float(w[at < 0][0]) if len(at) else UNLEARNED


def scores(texts: list[str | None], model: tuple[np.ndarray, np.ndarray, float], dense: np.ndarray) -> np.ndarray:
    place, doc = features(texts)
    hit = np.flatnonzero(dense[place])
    key = np.unique((doc[hit] << BITS) | place[hit])
    place = key & ((1 << BITS) - 1)
    total = np.bincount(key >> BITS, weights=dense[place] * np.where(place < HALF, 1.0, PAIR_VALUE), minlength=len(texts)) + model[2]
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def _dense(model: tuple[np.ndarray, np.ndarray, float]) -> np.ndarray:
    dense = np.zeros(1 << BITS)
    dense[model[0]] = model[1]
    return dense


def toxicity(docs: DataFrame, labels: DataFrame, most: int = 12_000) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = _dense(model.value)
        for b in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores(b.column("text").to_pylist(), model.value, dense))], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: all documents."""
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the corpus pipeline: documents scored 0.5 or more go."""
    model = spark.sparkContext.broadcast(fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = _dense(model.value)
        for b in pieces(batches, "text"):
            yield b.filter(pa.array(scores(b.column("text").to_pylist(), model.value, dense) < 0.5))

    return docs.mapInArrow(clean, docs.schema)


QUERIES = {"op9_ftrl_toxicity": op9_ftrl_toxicity}
ORACLES: dict[str, str] = {}
