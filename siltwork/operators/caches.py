"""Caches of what a search needs, by collection and version: an entry of another version, or too old, is not found."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltwork.operators import answer_cache, bm25

ANSWER = "entry_id long, collection string, settings string, embedding array<double>, answer string, results array<string>, cached_at timestamp_ntz"


class Folder:
    """JSON notes and tables below a path, through the file system that Spark uses."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._p = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def note(self, name: str, value: dict | None = None) -> dict | None:
        """Writes a note, or reads it; None if there is none."""
        at = self._p(f"{self.path}/{name}.json")
        if value is not None:
            out = self._fs.create(at, True)
            out.write(bytearray(json.dumps(value).encode()))
            out.close()
            return value
        if not self._fs.exists(at):
            return None
        stream = self._fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def at(self, name: str):
        return self._fs.makeQualified(self._p(f"{self.path}/{name}"))

    def drop(self, name: str) -> bool:
        return self._fs.delete(self._p(f"{self.path}/{name}"), True)

    def names(self) -> list[str]:
        at = self._p(self.path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []


class SearchCache:
    """The sparse index of a collection, saved under the version of the points it was built from."""

    def __init__(self, spark: SparkSession, path: str, ttl: float = 300):
        self.spark, self.folder, self.ttl = spark, Folder(spark, path), ttl

    def put(self, collection: str, version: str, index: bm25.Bm25, now: float) -> None:
        bm25.save(index, f"{self.folder.path}/{collection}/{version}")
        self.folder.note(f"{collection}/current", {"version": version, "saved_at": now})

    def get(self, collection: str, version: str, now: float) -> bm25.Bm25 | None:
        """The index, if it is of this version and not older than the time to live (seconds)."""
        note = self.folder.note(f"{collection}/current")
        if note is None or note["version"] != version or now - note["saved_at"] > self.ttl:
            return None
        return bm25.load(self.spark, f"{self.folder.path}/{collection}/{version}")

    def invalidate(self, collection: str) -> bool:
        return self.folder.drop(collection)


class ChunkCache:
    """The chunks of a collection as a search loads them, one table for each version, found while it is young."""

    def __init__(self, spark: SparkSession, path: str, ttl: float = 300):
        self.spark, self.folder, self.ttl = spark, Folder(spark, path), ttl

    def put(self, collection: str, version: str, chunks: DataFrame, now: float) -> None:
        """The note comes last, so a table that was not written whole is not found."""
        chunks.write.mode("overwrite").parquet(f"{self.folder.path}/{collection}/{version}")
        self.folder.note(f"{collection}/{version}", {"saved_at": now, "schema": chunks.schema.json()})

    def get(self, collection: str, version: str, now: float) -> DataFrame | None:
        note = self.folder.note(f"{collection}/{version}")
        if note is None or now - note["saved_at"] > self.ttl:
            return None
        return self.spark.read.schema(StructType.fromJson(json.loads(note["schema"]))).parquet(f"{self.folder.path}/{collection}/{version}")

    def load(self, collection: str, version: str, now: float, make: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
        """The chunks, and whether the cache had them; otherwise they are made and kept, and older versions go."""
        if (held := self.get(collection, version, now)) is not None:
            return held, True
        for name in self.folder.names():
            if name == collection:
                for old in Folder(self.spark, f"{self.folder.path}/{collection}").names():
                    if old.removesuffix(".json") != version:
                        self.folder.drop(f"{collection}/{old}")
        self.put(collection, version, make(), now)
        return self.get(collection, version, now), False

    def invalidate(self, collection: str) -> bool:
        return self.folder.drop(collection)


class AnswerCache:
    """Answers by collection, settings and embedding of the question; a failed write is the caller's to ignore.

    Entries lie in folders by collection and by slot of time, so a lookup lists the slots that can hold live entries and
    nothing older; ``expire`` removes the others.
    """

    def __init__(self, spark: SparkSession, path: str, ttl: int = answer_cache.TTL_SECONDS):
        self.spark, self.path, self.ttl, self.folder = spark, path.rstrip("/"), ttl, Folder(spark, path)

    def _slot(self, at: Column) -> Column:
        return F.floor(F.unix_timestamp(at.cast("timestamp")) / max(60, self.ttl)).cast("long")

    def put(self, answers: DataFrame, now: Column) -> None:
        """answers: entry_id, collection, settings, embedding, answer, results."""
        rows = answers.withColumn("embedding", F.col("embedding").cast("array<double>")).withColumn("cached_at", now)
        rows = rows.select(*[c.split(" ")[0] for c in ANSWER.split(", ")]).withColumn("slot", self._slot(F.col("cached_at")))
        rows.write.mode("append").partitionBy("collection", "slot").parquet(f"{self.path}/entries")

    def entries(self, now: Column | None = None) -> DataFrame:
        """All entries; with ``now``, those of slots that can hold live ones."""
        if "entries" not in self.folder.names():
            return self.spark.createDataFrame([], ANSWER)
        rows = self.spark.read.schema(f"{ANSWER}, slot long").parquet(f"{self.path}/entries")
        return (rows if now is None else rows.filter(F.col("slot") >= self._slot(now) - 1)).drop("slot")

    def get(self, probes: DataFrame, now: Column, threshold: float = answer_cache.THRESHOLD) -> DataFrame:
        """(query_id, entry_id, similarity, answer, results) of the probes that an entry answers."""
        return answer_cache.answered(probes, self.entries(now), now, threshold, self.ttl)

    def invalidate(self, collection: str) -> bool:
        return self.folder.drop(f"entries/collection={collection}")

    def expire(self, now: Column) -> int:
        """Removes the slots that hold no live entry; how many there were."""
        least, gone = self.spark.range(1).select(self._slot(now) - 1).first()[0], 0
        for part in Folder(self.spark, f"{self.path}/entries").names():
            for slot in Folder(self.spark, f"{self.path}/entries/{part}").names() if part.startswith("collection=") else ():
                if slot.startswith("slot=") and int(slot[5:]) < least:
                    gone += self.folder.drop(f"entries/{part}/{slot}")
        return gone
