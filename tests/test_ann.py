"""The inverted file: exact with all lists, kept up by additions and removals, and calibrated."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwork.operators import ann, dense


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 4
    x = centres[rng.integers(0, 12, 900)] + rng.normal(size=(900, 8))
    x[5] = 0
    x[10:14] = x[10]
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(None, [0.0] * 8), (2000, None), (2001, [1.0, 2.0])], "id long, embedding array<double>")


def rows(df):
    return sorted((r.query_id, r.rank, r.id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("metric", ann.METRICS)
def test_all_lists_give_the_exact_result(spark, tmp_path, vectors, metric):
    queries = vectors.filter("id % 30 = 0").withColumnRenamed("id", "query_id")
    index = ann.Inverted(spark, str(tmp_path)).build(vectors, metric, 12)
    exact = dense.top_k(vectors.filter("size(embedding) = 8"), queries, 7, metric)
    assert rows(index.search(queries, 7, ann.MOST_LISTS)) == rows(exact) == rows(index.search(queries, 7, ann.MOST_LISTS, block=4))
    assert index.calibrate(7) < 12
    assert ann.recall(index.search(queries, 7), exact).agg(F.avg("recall")).first()[0] >= 0.9
    assert index.rows().count() == 900 and index.rows([0]).select("list").distinct().count() <= 1


def test_additions_replace_and_removals_hide(spark, tmp_path, vectors):
    index = ann.Inverted(spark, str(tmp_path)).build(vectors.filter("id < 600"), lists=6)
    moved = vectors.filter("id between 590 and 610").withColumn("embedding", F.transform("embedding", lambda v: -v))
    index.add(moved)
    index.remove(spark.createDataFrame([(3,), (595,), (5000,), (None,)], "id long"))
    index.add(vectors.filter("id = 3"))
    want = vectors.filter("id < 590").unionByName(moved).filter("id <> 595")
    queries = vectors.filter("id % 20 = 0").withColumnRenamed("id", "query_id")
    exact = rows(dense.top_k(want, queries, 5))
    assert rows(index.search(queries, 5, 99)) == exact
    before = index.rows().count()
    index.compact()
    assert rows(index.search(queries, 5, 99)) == exact and index.rows().count() == before == want.count()


def test_an_addition_that_was_not_noted_is_not_seen(spark, tmp_path, vectors):
    index = ann.Inverted(spark, str(tmp_path)).build(vectors.filter("id < 100"), lists=4)
    index._write(index._assigned(vectors.filter("id between 100 and 200"), 2), 0, "append")
    index._bury(vectors.filter("id < 10").select("id"), 2)
    assert index.rows().count() == 100


def test_one_list_and_wrong_input(spark, tmp_path):
    index = ann.Inverted(spark, str(tmp_path)).build(spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0])], "id long, embedding array<double>"))
    query = spark.createDataFrame([(9, [1.0, 0.0]), (8, [1.0]), (None, [1.0, 0.0])], "query_id long, embedding array<double>")
    assert [(r.query_id, r.id, r.score) for r in index.search(query, 1).collect()] == [(9, 1, 0.0)]
    with pytest.raises(ValueError):
        index.build(query.withColumnRenamed("query_id", "id"), "dot")
    with pytest.raises(ValueError):
        index.build(spark.createDataFrame([], "id long, embedding array<double>"))
