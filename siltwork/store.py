"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
#: Tables that a block of ``passing`` has staged, in the thread that it runs in.
_passing: ContextVar[list | None] = ContextVar("passing", default=None)


def _removed(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _forget() -> None:
    for spark, path in _made:
        try:
            _removed(spark, path)
        except Exception:  # noqa: BLE001  the session has ended; the folder's own expiry removes the rest
            continue


def shared(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of our own is set in local mode; on a cluster that is an error."""
    if not (root := spark.conf.get("spark.checkpoint.dir", None)):
        there = spark.sparkContext._jsc.sc().getCheckpointDir()
        if there.isEmpty():
            master = spark.sparkContext.master or ""
            if not (master == "local" or master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="siltwork-"))
            there = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = there.get()
    return root.rstrip("/")


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written as Parquet (with these writer's options) to the shared folder and read again; removed when the process ends."""
    spark = df.sparkSession
    if not _made:
        atexit.register(_forget)
    path = f"{shared(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    if (those := _passing.get()) is not None:
        those.append((spark, path))
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing() -> Iterator[None]:
    """Tables that are staged within it, in this thread, are removed at its end: nothing that reads them may leave it."""
    those: list = []
    before = _passing.set(those)
    try:
        yield
    finally:
        _passing.reset(before)
        for one in those:
            _removed(*one)
            _made.remove(one)


#: Most bytes of an Arrow batch between Spark and Python, about, while a step writes its result itself.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, Arrow batches are bounded by bytes, so that what a task holds does not grow with texts or tables; afterwards the session's own bound holds again."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def tracked(function: Callable[..., DataFrame], *args) -> tuple[DataFrame, Callable[[DataFrame], None]]:
    """What the function returns, and a call that removes the tables staged meanwhile, unless the table passed to it still reads them."""
    start = len(_made)
    out = function(*args)
    made = _made[start:]

    def release(reader: DataFrame) -> None:
        files = reader.inputFiles()
        for one in list(made):
            if not any(one[1] in f for f in files):
                _removed(*one)
                made.remove(one)
                _made.remove(one)

    return out, release
