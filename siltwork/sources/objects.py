"""Objects of a store as a data source of Spark's: listed and planned once, read in parallel, and watched as a stream.

A store is two functions: ``listing`` gives its objects (key, size in bytes, time of change in seconds) and ``get`` the
bytes of one. Objects are packed into partitions of about ``part_bytes``, larger ones alone. An object that cannot be read
is a row with its error instead of content, so one bad object neither fails the read nor goes unseen; ``attempts`` are
made at each. As a stream, objects count as new by their time of change and key, so one that is written again comes again.
Streams plan what changed since their last offset, and every object of a batch is read by a task of its own partition.
"""

from __future__ import annotations

import datetime
import os
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from siltwork.sources.documents import EXTENSIONS, decoded

SCHEMA = "key string, size long, modified timestamp, content binary, error string"
PART_BYTES, ATTEMPTS = 64 << 20, 3


class Object(NamedTuple):
    key: str
    size: int
    changed: float


class Part(InputPartition):
    def __init__(self, objects: list[tuple]):
        self.objects = objects


def planned(objects: Iterable[Object], part_bytes: int = PART_BYTES) -> list[Part]:
    """Objects in order of key, packed until a partition is full."""
    parts, full = [], part_bytes
    for one in sorted(objects):
        if full + one.size > part_bytes or full >= part_bytes:
            parts.append([])
            full = 0
        parts[-1].append(tuple(one))
        full += max(1, one.size)
    return [Part(p) for p in parts]


def rows(part: Part, get: Callable[[str], bytes], attempts: int = ATTEMPTS) -> Iterator[tuple]:
    """A row for each object, with its content or the error of the last attempt."""
    for key, size, changed in part.objects:
        content, error = None, None
        for _ in range(attempts):
            try:
                content, error = bytes(get(key)), None
                break
            except Exception as e:  # noqa: BLE001  what a store raises is its own affair
                error = f"{type(e).__name__}: {e}"[:500]
        yield key, size, datetime.datetime.fromtimestamp(changed, datetime.UTC), content, error


def store(name: str, listing: Callable[[], Iterable[tuple]], get: Callable[[str], bytes], part_bytes: int = PART_BYTES, attempts: int = ATTEMPTS) -> type[DataSource]:
    """A data source of this name; ``listing`` and ``get`` run in Python workers, so they take what they need with them."""

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return planned([Object(*x) for x in listing()], part_bytes) or [Part([])]

        def read(self, partition: Part) -> Iterator[tuple]:
            return rows(partition, get, attempts)

    class Changes(DataSourceStreamReader):
        def initialOffset(self) -> dict:  # noqa: N802  names that Spark calls
            return {"changed": 0.0, "key": ""}

        def latestOffset(self) -> dict:  # noqa: N802
            last = max(((float(x[2]), x[0]) for x in listing()), default=(0.0, ""))
            return {"changed": last[0], "key": last[1]}

        def partitions(self, start: dict, end: dict) -> list[InputPartition]:
            after, upto = (start["changed"], start["key"]), (end["changed"], end["key"])
            return planned([one for x in listing() if after < ((one := Object(*x)).changed, one.key) <= upto], part_bytes)

        def read(self, partition: Part) -> Iterator[tuple]:
            return rows(partition, get, attempts)

        def commit(self, end: dict) -> None:
            pass

    class Store(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Reader()

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
            return Changes()

    return Store


def folder(path: str) -> tuple[Callable[[], list[tuple]], Callable[[str], bytes]]:
    """Listing and reading of a folder that the driver and all executors mount."""

    def listing() -> list[tuple]:
        found = []
        for top, _, names in os.walk(path):
            for n in names:
                at = os.path.join(top, n)
                try:
                    s = os.lstat(at)
                except OSError:  # it went meanwhile
                    continue
                found.append((os.path.relpath(at, path), s.st_size, s.st_mtime))
        return found

    def get(key: str) -> bytes:
        with open(os.path.join(path, key), "rb") as f:
            return f.read()

    return listing, get


def registered(spark: SparkSession, source: type[DataSource]) -> str:
    spark.dataSource.register(source)
    return source.name()


def documents(objects: DataFrame, uri: str, source: str, extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """Documents (content, source, source_uri, filename, metadata) of objects that were read and have a known extension; ``uri`` comes before the key."""
    text = F.udf(decoded, "string")
    known = F.lower(F.regexp_extract("key", r"\.([^./]+)$", 1)).isin(list(extensions))
    name = F.element_at(F.split("key", "/"), -1)
    return objects.filter(F.col("error").isNull() & known).select(
        text("content", name).alias("content"), F.lit(source).alias("source"), F.concat(F.lit(uri), "key").alias("source_uri"), name.alias("filename"),
        F.create_map(F.lit("size"), F.col("size").cast("string"), F.lit("modified"), F.date_format("modified", "yyyy-MM-dd HH:mm:ss")).alias("metadata"))


def failures(objects: DataFrame) -> DataFrame:
    """(key, error) of objects that could not be read."""
    return objects.filter("error is not null").select("key", "error")
