"""Expiry, audit rows and staged versions of an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def expires_at(now: Column, days: int) -> Column:
    """When a chunk expires: never if ``days`` is not positive."""
    return now + F.make_dt_interval(F.lit(days)) if days > 0 else F.lit(None).cast("timestamp_ntz")


def lives(now: Column) -> Column:
    """Whether a point (expires_at) has not expired."""
    return F.coalesce(F.col("expires_at") >= now, F.lit(True))


def unexpired(points: DataFrame, now: Column) -> DataFrame:
    return points.filter(lives(now))


def upserted(documents: DataFrame, new: DataFrame) -> DataFrame:
    """Documents by hash, earliest created_at and latest last_updated; rows without a hash are skipped."""
    rows = documents.unionByName(new, allowMissingColumns=True).filter(F.length("content_hash") > 0)
    return rows.groupBy("content_hash").agg(F.min_by("doc_id", F.struct("created_at", "doc_id")).alias("doc_id"), F.min("created_at").alias("created_at"), F.max("last_updated").alias("last_updated"))


def current_runs(log: DataFrame) -> DataFrame:
    """The last event of each run (run_id, event_at, id, ...) of an append-only log."""
    last = Window.partitionBy("run_id").orderBy(F.col("event_at").desc(), F.col("id").desc())
    return log.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def latest(evals: DataFrame, value: str = "recall_at_5") -> DataFrame:
    """One row: the value of the newest row by (created_at, id)."""
    return evals.agg(F.max_by(value, F.struct("created_at", "id")).alias(f"latest_{value}"))


def health(log: DataFrame, evals: DataFrame, documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """The latest completed run with its own latest recall, and the sizes of the tables; no row without a completed run."""
    run = log.filter("completed_at is not null").groupBy().agg(F.max(F.struct("completed_at", "id", "run_id", "status")).alias("r")).filter("r is not null").select("r.run_id", F.col("r.completed_at").alias("last_run_time"), F.col("r.status").alias("last_status"))
    recall = evals.groupBy("run_id").agg(F.max_by("recall_at_5", F.struct("created_at", "id")).alias("last_recall"))
    n = lambda df, name: F.broadcast(df.agg(F.count(F.lit(1)).alias(name)))
    return run.join(recall, "run_id", "left").join(n(documents, "total_documents")).join(n(chunks, "total_chunks")).drop("run_id")


def promoted(production: DataFrame, staging: DataFrame) -> DataFrame:
    """The next production version: staged points, and all earlier ones that they do not replace (by document)."""
    return staging.unionByName(production.join(staging.select("source_uri").distinct(), "source_uri", "left_anti"))


class Pointer:
    """A name that is switched at once: each value is a folder of its own number, and the highest counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._p = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _all(self) -> list[tuple[int, str]]:
        at = self._p(self.path)
        names = [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return sorted((int(n.split("-", 1)[0]), n.split("-", 1)[1]) for n in names)

    def get(self) -> str | None:
        return self._all()[-1][1] if self._all() else None

    def put(self, value: str) -> None:
        n = self._all()[-1][0] + 1 if self._all() else 1
        self._fs.mkdirs(self._p(f"{self.path}/{n}-{value}"))


class Versions:
    """Versions of a collection as folders, and a pointer that names the one in use; the one before stays as a backup."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.pointer = spark, path.rstrip("/"), Pointer(spark, f"{path.rstrip('/')}/current")
        self._p = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def current(self) -> str | None:
        return self.pointer.get()

    def read(self, version: str | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={version or self.current()}")

    def stage(self, version: str, points: DataFrame) -> DataFrame:
        points.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        return self.read(version)

    def promote(self, version: str) -> None:
        """Readers see the new version from the moment its pointer exists."""
        self.pointer.put(version)

    def discard(self, version: str) -> bool:
        if version == self.current():
            return False
        return self._fs.delete(self._p(f"{self.path}/v={version}"), True)

    def info(self) -> dict:
        """Points of the version in use, or nothing if there is none."""
        return {"version": self.current(), "points_count": self.read().count()} if self.current() else {}


class Collections:
    """Named collections below a path, each with its metric, its dimension and its versions."""

    def __init__(self, spark: SparkSession, path: str):
        from siltwork.operators.caches import Folder

        self.spark, self.folder = spark, Folder(spark, path)

    def ensure(self, name: str, dimension: int, metric: str = "cosine") -> bool:
        """Creates the collection if there is none; False if there is one, whose dimension and metric must agree."""
        wanted = {"dimension": int(dimension), "metric": metric}
        if (there := self.folder.note(f"{name}/collection")) is not None:
            if there != wanted:
                raise ValueError(f"{name} has {there}, not {wanted}")
            return False
        self.folder.note(f"{name}/collection", wanted)
        return True

    def versions(self, name: str) -> Versions:
        return Versions(self.spark, f"{self.folder.path}/{name}")

    def upsert(self, name: str, version: str, points: DataFrame) -> DataFrame:
        """Writes a version; vectors of another dimension than the collection's fail the write."""
        n = self.folder.note(f"{name}/collection")["dimension"]
        checked = F.when(F.size("embedding") == n, F.col("embedding")).otherwise(F.raise_error(F.lit(f"a vector has not {n} dimensions")))
        return self.versions(name).stage(version, points.withColumn("embedding", checked))

    def delete(self, name: str) -> bool:
        return self.folder.drop(name)

    def info(self) -> DataFrame:
        """(name, metric, dimension, points_count) of all collections; those without a version in use have 0 points."""
        rows = []
        for name in self.folder.names():
            note = self.folder.note(f"{name}/collection") or {}
            rows.append((name, note.get("metric"), note.get("dimension"), self.versions(name).info().get("points_count", 0)))
        return self.spark.createDataFrame(rows, "name string, metric string, dimension long, points_count long")
