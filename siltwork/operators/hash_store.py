"""Confirmed content hashes in buckets, with Bloom filters that say which buckets a batch of documents has to read.

A confirmation appends one file for each bucket that it touches, and a Bloom filter of the file's hashes. A lookup tests
a batch's distinct hashes against the filters of their buckets: what no filter knows is new, and only the buckets of the
others are read. A bucket with more than ``every`` files is written anew as one, without hashes that have outlived their
time. A log of entries (see manifest.Log) names the files of each bucket, so writers that meet see each other: the
second one looks again at what is confirmed by then.

Of a hash that was confirmed more than once the first live confirmation stands. Null and empty hashes are never new
documents' and are not stored. A bucket should hold about a million hashes; there are ``buckets`` of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.operators import dedup
from siltwork.operators.caches import Folder
from siltwork.operators.manifest import Log
from siltwork.store import stage

BUCKETS, EVERY = 64, 8
#: Bits for each hash of a filter, and bits that a hash sets: one in about a hundred unknown hashes passes.
BITS, PROBES = 10, 7
ROWS = "content_hash string, confirmed_at timestamp_ntz"
FILTERS = "bucket int, bits binary"


def _numbers() -> list[Column]:
    """Two numbers of a hash, from its first thirty hexadecimal digits; of other strings, from their own hash."""
    of = F.when(F.col("content_hash").rlike("^[0-9a-f]{64}$"), F.col("content_hash")).otherwise(F.sha2("content_hash", 256))
    return [F.conv(F.substring(of, at, 15), 16, 10).cast("long").alias(name) for name, at in (("h1", 1), ("h2", 16))]


def _places(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    return (h1[:, None] % size + np.arange(PROBES) * (h2 % size)[:, None]) % size


def _filter(table: pa.Table) -> pa.Table:
    size = -(-max(64, BITS * table.num_rows) // 8) * 8
    bits = np.zeros(size, np.uint8)
    bits[_places(table["h1"].to_numpy(), table["h2"].to_numpy(), size).ravel()] = 1
    return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def _maybe(hashes: pa.Table, filters: pa.Table) -> pa.Table:
    """The hashes that some filter of their bucket may hold."""
    h1, h2 = hashes["h1"].to_numpy(), hashes["h2"].to_numpy()
    known = np.zeros(len(h1), bool)
    for packed in filters["bits"].to_pylist():
        bits = np.unpackbits(np.frombuffer(packed, np.uint8))
        known |= bits[_places(h1, h2, len(bits))].all(1).astype(bool)
    return hashes.select(["content_hash", "bucket"]).filter(pa.array(known))


class HashStore:
    """The hashes below a path."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, every: int = EVERY, days: int = dedup.TTL_DAYS):
        self.spark, self.path, self.buckets, self.every, self.days = spark, path.rstrip("/"), buckets, every, days
        self.log, self.folder = Log(spark, f"{self.path}/log"), Folder(spark, self.path)

    def _files(self) -> dict[str, list[str]]:
        n = self.log.last()
        return self.log.entry(n)["files"] if n else {}

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("content_hash"), F.lit(self.buckets)).cast("int")

    def rows(self, files: dict[str, list[str]] | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Confirmations (content_hash, confirmed_at), of these buckets."""
        files = self._files() if files is None else files
        paths = [f"{self.path}/data/{f}/bucket={b}" for b, part in files.items() if buckets is None or int(b) in buckets for f in part]
        return self.spark.read.schema(ROWS).parquet(*paths) if paths else self.spark.createDataFrame([], ROWS)

    def live(self, now: Column, buckets: list[int] | None = None) -> DataFrame:
        """Hashes that have not outlived their time, with their first live confirmation."""
        return dedup.live(self.rows(buckets=buckets), now, self.days).groupBy("content_hash").agg(F.min("confirmed_at").alias("confirmed_at"))

    def known(self, hashes: DataFrame, now: Column) -> tuple[DataFrame, list[int]]:
        """(content_hash) of these hashes that are live, and the buckets that were read for it."""
        files = self._files()
        asked = hashes.filter(F.length("content_hash") > 0).select("content_hash").distinct().select("content_hash", self.bucket().alias("bucket"), *_numbers())
        parts = {f for part in files.values() for f in part}
        if not parts:
            return self.spark.createDataFrame([], "content_hash string"), []
        held = self.spark.createDataFrame([(int(b), f) for b, part in files.items() for f in part], "_bucket int, _file string")
        filters = self.spark.read.option("basePath", f"{self.path}/filters").schema(f"{FILTERS}, file string").parquet(*[f"{self.path}/filters/file={f}" for f in sorted(parts)])
        filters = filters.join(F.broadcast(held), (F.col("bucket") == F.col("_bucket")) & (F.col("file") == F.col("_file")), "left_semi")  # buckets times files of each
        maybe = stage(asked.groupBy("bucket").cogroup(filters.select(F.col("bucket").alias("_b"), "bits").groupBy("_b")).applyInArrow(_maybe, "content_hash string, bucket int"), "maybe")
        hit = sorted(r.bucket for r in maybe.select("bucket").distinct().collect())  # as many as buckets
        return maybe.join(dedup.live(self.rows(files, hit), now, self.days).select("content_hash"), "content_hash", "left_semi").select("content_hash"), hit

    def new_documents(self, docs: DataFrame, now: Column) -> DataFrame:
        """Documents (content_hash, ...) whose hash is not confirmed and live."""
        known, _ = self.known(docs, now)
        return docs.filter(F.length("content_hash") > 0).join(known, "content_hash", "left_anti")

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """A file's name and the buckets that it has rows of."""
        name = uuid.uuid4().hex
        rows = rows.withColumn("bucket", self.bucket()).repartition("bucket")
        rows.write.partitionBy("bucket").parquet(f"{self.path}/data/{name}")
        written = self.spark.read.schema(f"{ROWS}, bucket int").parquet(f"{self.path}/data/{name}")
        written.select("bucket", *_numbers()).groupBy("bucket").applyInArrow(_filter, FILTERS).write.parquet(f"{self.path}/filters/file={name}")
        return name, [x[7:] for x in Folder(self.spark, f"{self.path}/data/{name}").names() if x.startswith("bucket=")]

    def confirm(self, landed: DataFrame, now: Column) -> int:
        """Confirms hashes (content_hash) that are not live yet; the number of the log's entry."""
        while True:
            n, files = self.log.last(), self._files()
            name, mine = self._write(self.new_documents(landed.select("content_hash").distinct(), now).withColumn("confirmed_at", now))
            if not mine:
                return n
            merged = {b: [*files.get(b, []), *([name] if b in mine else [])] for b in {*files, *mine}}
            if self.log.commit(n + 1, {"files": merged}):
                long = [int(b) for b, part in merged.items() if len(part) > self.every]
                return self.compact(now, long) if long else n + 1

    def _replaced(self, keep: Callable, buckets: list[int] | None) -> int:
        while True:
            n, files = self.log.last(), self._files()
            those = [b for b in files if buckets is None or int(b) in buckets]
            name, mine = self._write(keep(self.rows(files, [int(b) for b in those])))
            left = {b: part for b, part in files.items() if b not in those} | {b: [name] for b in mine}
            if self.log.commit(n + 1, {"files": left}):
                return n + 1

    def compact(self, now: Column, buckets: list[int] | None = None) -> int:
        """Writes these buckets (all by default) as one file each, with live hashes only."""
        return self._replaced(lambda rows: dedup.live(rows, now, self.days).groupBy("content_hash").agg(F.min("confirmed_at").alias("confirmed_at")), buckets)

    def forget(self, hashes: DataFrame) -> list[int]:
        """Takes hashes out; the buckets that were written anew for it."""
        gone = stage(hashes.filter(F.length("content_hash") > 0).select("content_hash").distinct(), "forgotten")
        hit = sorted(r[0] for r in gone.select(self.bucket()).distinct().collect())  # as many as buckets
        if hit:
            self._replaced(lambda rows: dedup.forget(rows, gone), hit)
        return hit

    def vacuum(self) -> int:
        """Removes files that the last entry does not name; how many. Not while another writer is at work."""
        used = {f for part in self._files().values() for f in part}
        gone = [f for f in Folder(self.spark, f"{self.path}/data").names() if f not in used]
        for f in gone:
            self.folder.drop(f"data/{f}")
            self.folder.drop(f"filters/file={f}")
        return len(gone)
