"""Places, predecessors and exact quantiles of long series, without a window over all rows.

Rows are dealt to tasks by ranges of their order, numbered there, and shifted by the sizes of the ranges before: a prefix
sum over one row a range. A range is split anywhere, also among equal rows, so no value is too frequent.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.store import stage


def _ranges(rows: DataFrame, by: tuple[str, ...]) -> tuple[DataFrame, list]:
    """The rows, written, with the number of their range and a tie-breaker; and the ranges in order (a row each)."""
    made = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by, "_tie")
    made = stage(made.withColumn("_range", F.spark_partition_id()), "ranges")
    ends = made.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.max_by(by[0], F.struct(*by, "_tie")).alias("last")).orderBy("_range").collect()  # as many as tasks
    return made, ends


def placed(rows: DataFrame, *by: str, place: str = "place", before: str | None = None) -> DataFrame:
    """Rows with their ``place`` from 0 in the order of ``by``, and in ``before`` the value of the first of these columns one place earlier (null at the first)."""
    made, ends = _ranges(rows, by)
    starts = list(accumulate((r.n for r in ends), initial=0))
    kind = made.schema[by[0]].dataType.simpleString()
    shift = rows.sparkSession.createDataFrame([(r["_range"], starts[i], ends[i - 1]["last"] if i else None) for i, r in enumerate(ends)], f"_range int, _start long, _last {kind}")
    own = Window.partitionBy("_range").orderBy(*by, "_tie")
    out = made.withColumn(place, F.row_number().over(own).cast("long") - 1)
    out = out if before is None else out.withColumn("_before", F.lag(by[0]).over(own))
    out = out.join(F.broadcast(shift), "_range").withColumn(place, F.col(place) + F.col("_start"))  # a row a task
    out = out if before is None else out.withColumn(before, F.when(F.col(place) == F.col("_start"), F.col("_last")).otherwise(F.col("_before")))
    return out.drop("_range", "_tie", "_start", "_last", "_before")


def quantiles(rows: DataFrame, column: str, shares: tuple[float, ...]) -> list[float | None]:
    """Exact quantiles of the values that are not null, interpolated between neighbours."""
    some = stage(placed(rows.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v")), "v"), "placed")
    n = some.count()
    if not n:
        return [None] * len(shares)
    at = [s * (n - 1) for s in shares]
    wanted = sorted({int(x) for x in at} | {min(n - 1, int(x) + 1) for x in at})
    found = {r.place: r.v for r in some.filter(F.col("place").isin(wanted)).collect()}  # two for each share
    return [found[int(x)] + (x - int(x)) * (found[min(n - 1, int(x) + 1)] - found[int(x)]) for x in at]
