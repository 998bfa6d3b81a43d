"""Exact nearest neighbours for batches of queries.

Queries go out in blocks of bounded size; each task multiplies its vectors with a block, a bounded number of products at
a time, and keeps the best k of every query, so that what is shuffled is k rows a query and task, whatever the corpus
holds. With more than one block, each block's result is written before the next is fetched: the driver holds one block
of queries at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.store import stage

#: Queries of a block, and products or numbers of vectors that a task holds at a time (8 bytes each).
BLOCK, PRODUCTS = 1024, 1 << 19
METRICS = ("cosine", "dot", "euclid")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def best_of(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int, digits: int) -> np.ndarray:
    """Places of the best ``k`` of each query among (query, id, score); ties, after rounding, go by id."""
    order = np.lexsort((ids, -np.round(scores, digits), query))
    q = query[order]
    first = np.searchsorted(q, q)
    return order[np.arange(len(q)) - first < k]


def _searched(rows: DataFrame, block: list, k: int, metric: str, least: float | None, digits: int) -> DataFrame:
    """(query_id, id, score): the best k of every task for one block of queries of one dimension."""
    ids, parts, q = np.array([r.query_id for r in block]), np.array([r.part for r in block]), np.array([r.embedding for r in block])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        qn, step = np.linalg.norm(q, axis=1), max(1, PRODUCTS // max(q.shape))
        for whole in batches:
            whole = whole.filter(pa.compute.equal(pa.compute.list_value_length(whole.column("embedding")), q.shape[1]))
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                v, own = _matrix(b.column("embedding")), b.column("id").to_numpy()
                s = q @ v.T
                if metric == "cosine":
                    d = qn[:, None] * np.linalg.norm(v, axis=1)[None, :]
                    s = np.divide(s, d, out=np.zeros_like(s), where=d > 0)
                elif metric == "euclid":
                    s = -np.sqrt(np.maximum(qn[:, None] ** 2 + (v**2).sum(axis=1)[None, :] - 2 * s, 0))
                ok = parts[:, None] == b.column("part").to_numpy()[None, :]
                if least is not None:
                    ok &= s >= least
                # What is below a query's kth best of this slice cannot be among its best; ties with it stay.
                if s.shape[1] > k:
                    r = np.where(ok, np.round(s, digits), -np.inf)
                    ok &= r >= -np.partition(-r, k - 1, axis=1)[:, k - 1 : k]
                i, j = np.nonzero(ok)
                i, j, s = np.concatenate([kept[0], i]), np.concatenate([kept[1], own[j]]), np.concatenate([kept[2], s[i, j]])
                first = best_of(i, j, s, k, digits)
                kept = (i[first], j[first], s[first])
        yield pa.RecordBatch.from_arrays([pa.array(ids[kept[0]]), pa.array(kept[1]), pa.array(kept[2])], names=["query_id", "id", "score"])

    return rows.mapInArrow(best, "query_id long, id long, score double")


def top_k(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine", least: float | None = None, digits: int = 6, block: int = BLOCK) -> DataFrame:
    """(query_id, id, score, rank): vectors (id, embedding), queries (query_id, embedding), ids integers.

    Where both have a column ``part`` (an integer), only vectors of the query's own part count. ``euclid`` scores are negative distances. ``least`` drops lower scores before ranking. Ties, after rounding, go by
    id. Null vectors and vectors of another dimension than the query's are left out.
    """
    if metric not in METRICS:
        raise ValueError(f"metric is one of {METRICS}")
    part = F.col("part") if "part" in vectors.columns and "part" in queries.columns else F.lit(0)
    asked = queries.filter("embedding is not null and query_id is not null").select("query_id", part.cast("long").alias("part"), F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("n"))
    sizes = {r.n: r["count"] for r in asked.groupBy("n").count().collect()}  # a row for each dimension
    rows, parts = vectors.filter("embedding is not null and id is not null").select("id", part.cast("long").alias("part"), "embedding"), []
    blocks = [(n, i, -(-count // block)) for n, count in sorted(sizes.items()) for i in range(-(-count // block))]
    order = Window.partitionBy("query_id").orderBy(F.round("score", digits).desc(), F.col("id").asc())
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    for n, i, of in blocks:
        found = asked.filter((F.col("n") == n) & (F.pmod(F.xxhash64("query_id"), F.lit(of)) == i)).orderBy("query_id").collect()
        if found:
            part = ranked(_searched(rows, found, k, metric, least, digits))
            parts.append(stage(part, "nearest") if len(blocks) > 1 else part)
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_id long, id long, score double, rank int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
