"""Approximate nearest neighbours by an inverted file: k-means centroids, vectors in lists by their nearest centroid.

Centroids are fitted by Spark's k-means on a sample of about ``sample`` vectors, chosen by a hash of the id; every
vector is then put into the list of its nearest centroid, a Parquet folder of its own. Large lists are split over
files by ranges of id. A search compares a query with the centroids, reads the lists of the ``probes`` nearest ones only
(partition pruning), and scores what it reads exactly. With as many probes as lists the result is the exact one; how
many a wanted recall takes depends on the vectors, and ``calibrate`` measures it.

Vectors can be added and taken out at any time without touching other files: additions carry a growing number, and a row is dead if its
id was added or taken out under a larger one. ``compact`` rewrites the lists without dead rows. One writer at a time is
assumed; readers see an addition from the moment its number is noted, which happens last.

Null vectors, null ids and vectors of another dimension than the index are left out; of rows of one addition that share
an id the one of least hash counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwork.operators.caches import Folder
from siltwork.operators.dense import BLOCK, PRODUCTS, _matrix, best_of, top_k
from siltwork.store import stage

#: Vectors of the sample that centroids are fitted on, about, and most lists.
SAMPLE, MOST_LISTS = 100_000, 4096
METRICS = ("cosine", "euclid")
ROWS = "id long, embedding array<double>, seq long, list int"
GONE = "id long, before long"


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def nearest_lists(x: np.ndarray, centroids: np.ndarray, metric: str, probes: int) -> np.ndarray:
    """The ``probes`` nearest centroids of each row, nearest first; ties go to the smaller number."""
    far = -(_unit(x) @ _unit(centroids).T) if metric == "cosine" else (centroids**2).sum(1)[None, :] - 2 * x @ centroids.T
    return np.argsort(far, axis=1, kind="stable")[:, :probes]


def centroids_of(vectors: DataFrame, lists: int, metric: str, sample: int = SAMPLE, seed: int = 7) -> np.ndarray:
    """At most ``lists`` centroids of vectors (id, embedding) of one dimension."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = vectors.count()
    some = vectors.filter(F.pmod(F.xxhash64("id"), F.lit(max(1, n // sample))) == 0).filter(F.exists("embedding", lambda v: v != 0))
    some = stage(some.select("id", "embedding").orderBy("id"), "sampled").select(array_to_vector("embedding").alias("features"))
    if not some.limit(1).count():
        return np.zeros((1, vectors.select(F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()[0]))
    model = KMeans(k=max(2, lists), seed=seed, maxIter=10, distanceMeasure="cosine" if metric == "cosine" else "euclidean").fit(some)
    return np.array(model.clusterCenters())


class Inverted:
    """An index below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    @property
    def _note(self) -> dict:
        return self.folder.note("index")

    def build(self, vectors: DataFrame, metric: str = "cosine", lists: int | None = None, sample: int = SAMPLE) -> Inverted:
        """An index of vectors (id, embedding) of the dimension that most of them have; about the root of their number of lists."""
        if metric not in METRICS:
            raise ValueError(f"metric is one of {METRICS}")
        sizes = vectors.filter("embedding is not null and id is not null").groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
        if sizes is None:
            raise ValueError("there is no vector to build an index of")
        lists = lists or max(1, min(MOST_LISTS, round(math.sqrt(sizes["count"]))))
        own = vectors.filter(F.size("embedding") == sizes.n).select("id", F.col("embedding").cast("array<double>").alias("embedding"))
        centroids = centroids_of(own, lists, metric, sample)
        self.folder.note("index", {"metric": metric, "dimension": sizes.n, "seq": 0, "files": 0, "centroids": centroids.tolist()})
        self.add(vectors)
        return self

    def _assigned(self, vectors: DataFrame, seq: int) -> DataFrame:
        note = self._note
        metric, centroids = note["metric"], np.array(note["centroids"])

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _matrix(b.column("embedding"))
                at = nearest_lists(x, centroids, metric, 1)[:, 0] if len(x) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("embedding"), pa.array(np.full(len(x), seq)), pa.array(at.astype(np.int32))], names=["id", "embedding", "seq", "list"])

        rows = vectors.filter((F.size("embedding") == note["dimension"]) & F.col("id").isNotNull())
        one = rows.groupBy(F.col("id").cast("long").alias("id")).agg(F.min_by(F.col("embedding").cast("array<double>"), F.xxhash64("embedding")).alias("embedding"))
        return one.mapInArrow(assign, ROWS)

    def _write(self, rows: DataFrame, files: int, mode: str) -> None:
        rows.repartitionByRange("list", "id").write.mode(mode).partitionBy("list").parquet(f"{self.folder.path}/lists-{files}")

    def add(self, vectors: DataFrame) -> int:
        """Puts vectors in, in place of those of the same ids; the addition's number."""
        note = self._note
        seq = note["seq"] + 1
        rows = stage(self._assigned(vectors, seq), "assigned")
        if seq > 1:
            self._bury(rows.select("id"), seq)
        self._write(rows, note["files"], "append")
        self.folder.note("index", note | {"seq": seq})
        return seq

    def remove(self, ids: DataFrame) -> int:
        """Takes vectors out by id."""
        note = self._note
        seq = note["seq"] + 1
        self._bury(ids.filter("id is not null").select(F.col("id").cast("long").alias("id")).distinct(), seq)
        self.folder.note("index", note | {"seq": seq})
        return seq

    def _bury(self, ids: DataFrame, seq: int) -> None:
        ids.select("id", F.lit(seq).cast("long").alias("before")).write.mode("append").parquet(f"{self.folder.path}/gone-{self._note['files']}")

    def rows(self, lists: list[int] | None = None) -> DataFrame:
        """Live rows, of these lists."""
        note = self._note
        if f"lists-{note['files']}" not in self.folder.names():
            return self.spark.createDataFrame([], ROWS)
        rows = self.spark.read.schema(ROWS).parquet(f"{self.folder.path}/lists-{note['files']}").filter(F.col("seq") <= note["seq"])
        rows = rows if lists is None else rows.filter(F.col("list").isin(lists))
        if f"gone-{note['files']}" not in self.folder.names():
            return rows
        gone = self.spark.read.schema(GONE).parquet(f"{self.folder.path}/gone-{note['files']}").filter(F.col("before") <= note["seq"]).groupBy(F.col("id").alias("_id")).agg(F.max("before").alias("before"))
        return rows.join(gone, (F.col("id") == F.col("_id")) & (F.col("seq") < F.col("before")), "left_anti")

    def compact(self) -> None:
        """Rewrites the lists without dead rows; readers take the new files from the moment that they are noted."""
        note = self._note
        rows = self.rows()
        rows.repartitionByRange("list", "id").write.mode("overwrite").partitionBy("list").parquet(f"{self.folder.path}/lists-{note['files'] + 1}")
        self.folder.note("index", note | {"files": note["files"] + 1})
        self.folder.drop(f"lists-{note['files']}")
        self.folder.drop(f"gone-{note['files']}")

    def calibrate(self, k: int = 10, least: float = 0.95, sample: int = 256) -> int:
        """Notes and gives the fewest probes with which about ``sample`` indexed vectors, chosen by a hash of the id, find ``least`` of their ``k`` nearest others.

        One exact search of the sample; where each neighbour's list stands among the vector's nearest lists says the rest.
        """
        note = self._note
        rows = self.rows()
        some = rows.filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(max(1, rows.count() // sample))) == 0).select(F.col("id").alias("query_id"), "embedding")
        near = top_k(rows.select("id", "embedding"), some, k + 1, note["metric"]).filter("id <> query_id").join(rows.select("id", "list"), "id")
        found = near.join(some, "query_id").select("embedding", "list").toArrow()  # sample times k rows
        if not found.num_rows:
            return self.folder.note("index", note | {"probes": 1})["probes"]
        order = nearest_lists(_matrix(found["embedding"].combine_chunks()), np.array(note["centroids"]), note["metric"], MOST_LISTS)
        place = np.sort((order == found["list"].to_numpy()[:, None]).argmax(1)) + 1
        return self.folder.note("index", note | {"probes": int(place[min(len(place) - 1, math.ceil(least * len(place)))])})["probes"]

    def search(self, queries: DataFrame, k: int, probes: int | None = None, digits: int = 6, block: int = BLOCK) -> DataFrame:
        """(query_id, id, score, rank): the best ``k`` of the ``probes`` nearest lists of each query (query_id, embedding); scores and ties as in dense.top_k.

        Without a number of probes, that of the last calibration counts, or 8 where there was none.
        """
        note = self._note
        probes = probes or note.get("probes", 8)
        centroids, metric = np.array(note["centroids"]), note["metric"]
        asked = queries.filter((F.size("embedding") == note["dimension"]) & F.col("query_id").isNotNull()).select("query_id", F.col("embedding").cast("array<double>").alias("embedding"))
        of, found = max(1, -(-asked.count() // block)), []
        for i in range(of):
            mine = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(of)) == i).orderBy("query_id").collect()  # a block
            if mine:
                q = np.array([r.embedding for r in mine])
                lists = nearest_lists(q, centroids, metric, probes)
                rows = self.rows(sorted({int(x) for x in lists.ravel()}))
                found.append(stage(_ranked(_scored(rows, np.array([r.query_id for r in mine]), q, lists, k, metric, digits), k, digits), "nearest"))
        out = found[0] if found else self.spark.createDataFrame([], "query_id long, id long, score double, rank int")
        for other in found[1:]:
            out = out.unionByName(other)
        return out


def _scored(rows: DataFrame, ids: np.ndarray, q: np.ndarray, lists: np.ndarray, k: int, metric: str, digits: int) -> DataFrame:
    """(query_id, id, score): of each task the best k of each query among the rows of its lists."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        asks = {int(one): np.flatnonzero((lists == one).any(1)) for one in np.unique(lists)}
        for b in batches:
            of, own, v = b.column("list").to_numpy(), b.column("id").to_numpy(), _matrix(b.column("embedding"))
            parts = [kept]
            for one in np.unique(of).tolist():
                mine, at = asks.get(one, np.empty(0, np.int64)), np.flatnonzero(of == one)
                for some in np.array_split(at, -(-len(at) * max(1, len(mine)) // PRODUCTS)) if len(mine) else ():
                    s = q[mine] @ v[some].T
                    if metric == "cosine":
                        d = np.linalg.norm(q[mine], axis=1)[:, None] * np.linalg.norm(v[some], axis=1)[None, :]
                        s = np.divide(s, d, out=np.zeros_like(s), where=d > 0)
                    else:
                        s = -np.sqrt(np.maximum((q[mine] ** 2).sum(1)[:, None] + (v[some] ** 2).sum(1)[None, :] - 2 * s, 0))
                    r = np.round(s, digits)
                    i, j = np.nonzero(r >= np.partition(r, -k, axis=1)[:, -k][:, None] if r.shape[1] > k else np.ones(r.shape, bool))
                    parts.append((mine[i], own[some[j]], s[i, j]))
            i, j, s = (np.concatenate(x) for x in zip(*parts, strict=True))
            first = best_of(i, j, s, k, digits)
            kept = (i[first], j[first], s[first])
        yield pa.RecordBatch.from_arrays([pa.array(ids[kept[0]]), pa.array(kept[1]), pa.array(kept[2])], names=["query_id", "id", "score"])

    return rows.select("id", "embedding", "list").mapInArrow(best, "query_id long, id long, score double")


def _ranked(scored: DataFrame, k: int, digits: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.round("score", digits).desc(), F.col("id").asc())
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(query_id, recall): share of the exact result (query_id, id) that was found."""
    hit = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return hit.groupBy("query_id").agg((F.count("hit") / F.count(F.lit(1))).alias("recall"))
