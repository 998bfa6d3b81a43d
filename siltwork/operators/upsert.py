"""Points written to an index in batches, of which some may fail; only documents all of whose chunks landed are confirmed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH = 100


def batched(points: DataFrame, size: int = BATCH) -> DataFrame:
    """Points with ``batch``: about ``size`` points share one, by a hash of the id, so a retry sends the same batches."""
    n = points.agg(F.count(F.lit(1)).alias("n")).first().n
    return points.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // size)))))


def sent(points: DataFrame, send: Callable[[pd.DataFrame], None]) -> DataFrame:
    """(content_hash, chunk_index, batch, ok): every batch handed to ``send`` once; where that raises, its points did not land and the rest go on."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            last = held["batch"] == held["batch"].iloc[-1] if len(held) else []
            yield from (tried(part) for _, part in held[~last].groupby("batch", sort=False)) if len(held) else ()
            held = held[last] if len(held) else None
        if held is not None and len(held):
            yield tried(held)

    def tried(part: pd.DataFrame) -> pd.DataFrame:
        try:
            send(part)
            ok = True
        except Exception:  # noqa: BLE001  a batch that fails is counted, not fatal
            ok = False
        return part[["content_hash", "chunk_index", "batch"]].assign(ok=ok)

    rows = points.repartition("batch").sortWithinPartitions("batch")
    return rows.mapInPandas(each, "content_hash string, chunk_index int, batch long, ok boolean")


def counters(result: DataFrame) -> DataFrame:
    """One row: points and batches that landed and failed, and whether anything landed."""
    return result.agg(
        F.count_if("ok").alias("points_upserted"), F.count_if(~F.col("ok")).alias("points_failed"),
        F.count_distinct(F.when(F.col("ok"), F.col("batch"))).alias("batches"), F.count_distinct(F.when(~F.col("ok"), F.col("batch"))).alias("batches_failed"),
    ).withColumn("success", F.col("points_upserted") > 0)
