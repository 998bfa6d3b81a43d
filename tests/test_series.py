"""Places and quantiles of series against plain sorting."""

import random

import pytest
from pyspark.sql import functions as F

from siltwork.operators import series


def test_places_with_ties_and_a_hot_value(spark):
    rng = random.Random(8)
    rows = [(rng.choice([5, 5, 5, rng.randrange(40)]), i) for i in range(2000)]
    made = spark.createDataFrame(rows, "x long, i long").repartition(7)
    got = {r.i: (r.place, r.before) for r in series.placed(made, "x", "i", before="before").collect()}
    order = sorted(rows)
    assert got == {i: (k, order[k - 1][0] if k else None) for k, (x, i) in enumerate(order)}
    only = [r.place for r in series.placed(made, "x").orderBy("place").collect()]
    assert only == list(range(2000))


@pytest.mark.parametrize("values", [[], [None], [3.0], [1.0, 2.0], [5.0, 1.0, None, 5.0, 5.0, 9.0]])
def test_quantiles(spark, values):
    made = spark.createDataFrame([(v,) for v in values], "v double")
    want = made.agg(*[F.percentile("v", F.lit(s)).alias(f"s{i}") for i, s in enumerate((0.0, 0.3, 0.5, 1.0))]).first()
    assert series.quantiles(made, "v", (0.0, 0.3, 0.5, 1.0)) == pytest.approx(list(want)) if any(v is not None for v in values) else series.quantiles(made, "v", (0.5,)) == [None]
    assert series.placed(made.limit(0), "v").count() == 0
