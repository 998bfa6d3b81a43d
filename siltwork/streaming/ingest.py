"""Ingestion as micro-batches: exact dedup in stream state, or in two phases against the hash store or in state."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from siltwork.functions.text import content_hash
from siltwork.operators import dedup


def watched(spark: SparkSession, path: str, schema) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def first_sightings(stream: DataFrame, content: str, at: str, days: int = dedup.TTL_DAYS) -> DataFrame:
    """Documents whose hash was not seen within ``days`` before; a sighting counts at once. State expires by watermark."""
    return stream.filter(F.length(content) > 0).withColumn("content_hash", content_hash(F.col(content))).withWatermark(at, f"{days} days").dropDuplicatesWithinWatermark(["content_hash"])


def two_phase(stream: DataFrame, store: Callable[[], DataFrame], land: Callable[[DataFrame], DataFrame], confirm: Callable[[DataFrame], None], now, checkpoint: str, content: str = "content") -> StreamingQuery:
    """Each micro-batch: documents that ``store`` has not confirmed go to ``land``, and only what it returns as landed is confirmed.

    A batch that is replayed after a failure finds its confirmed hashes in the store and does not land them again.
    """

    def each(batch: DataFrame, _: int) -> None:
        confirmed = dedup.live(store(), now)
        landed = land(dedup.new_documents(dedup.hashed(batch, content), confirmed))
        confirm(dedup.confirm(store(), landed, now))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


EVENTS = "content_hash string, event string, at timestamp"


class TwoPhase(StatefulProcessor):
    """State of one hash: pending since it was handed out, or confirmed since it landed, each until a time.

    A document whose hash is neither is ``new`` and makes it pending; if nothing lands until then, the next one is new
    again. What landed is ``confirmed``, and the first confirmation stands until it expires. Only the rows' own times
    decide, so a batch that is replayed gives the same events; timers clear state that is of no more use.
    """

    def __init__(self, pending: int, confirmed: int):
        self.length = {"pending": pending, "confirmed": confirmed}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("phase", "phase string, until long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803  names that Spark calls
        held = tuple(self.state.get()) if self.state.exists() else ("", 0)
        before = held
        for at, landed in sorted((r.at, r.landed) for r in rows):
            now = int(at.replace(tzinfo=at.tzinfo or datetime.UTC).timestamp() * 1000)
            phase = held[0] if held[1] > now else ""
            if phase != "confirmed" and (landed or not phase):
                name = "confirmed" if landed else "pending"
                held = (name, now + self.length[name])
                yield Row(content_hash=key[0], event="confirmed" if landed else "new", at=at)
        if held != before:
            self.state.update(held)
            self.handle.registerTimer(held[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.state.exists() and self.state.get()[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def phases(stream: DataFrame, pending_seconds: int = 3600, days: int = dedup.TTL_DAYS, late_seconds: int = 0) -> DataFrame:
    """Events (content_hash, event, at) of a stream of sightings (content_hash, at, landed): ``new`` documents to hand out, and hashes that are ``confirmed`` as they landed.

    A row that comes more than ``late_seconds`` after the latest time of the batches before is dropped; state is kept so much longer.
    """
    keyed = stream.filter(F.length("content_hash") > 0).select("content_hash", "at", F.coalesce("landed", F.lit(False)).alias("landed")).withWatermark("at", f"{late_seconds} seconds").groupBy("content_hash")
    return keyed.transformWithState(TwoPhase(pending_seconds * 1000, days * 86_400_000), EVENTS, "Append", "EventTime")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Within it, queries that start keep their state in RocksDB, which ``phases`` needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)
