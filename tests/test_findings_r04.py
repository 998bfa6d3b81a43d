"""Near copies in another case, and failures that must not look like results."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from siltwork.operators import bm25, caches, learned
from siltwork.plans import refresh, search, stores


def test_a_passage_is_told_from_its_copy_in_another_case(spark, tmp_path):
    """A held-out passage stands in a long text, and in capitals in a short one, which all scores without case put first."""
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choices([f"w{i}" for i in range(400)], k=n))
    passages = [prose(20) for _ in range(16)]
    texts = [f"{prose(10)} {p} {prose(60)}" for p in passages] + [prose(80) for _ in range(40)]
    texts[5] = f"{prose(100)} {passages[5]} {prose(100)}"
    texts.append(f"{prose(12)} {passages[5].upper()} {prose(12)}")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert stores.learned_rerank(spark, str(tmp_path)).first().asDict() == {"n_held_out": 8, "better": True}


def test_candidates_found_by_words_alone_have_their_score_by_vectors(spark):
    docs = spark.createDataFrame([(1, "A b c"), (2, "x y z")], "id long, text string")
    vectors = spark.createDataFrame([(1, [3.0, 4.0]), (2, [1.0, 0.0])], "id long, embedding array<double>")
    queries, asked = spark.createDataFrame([(7, "a b c")], "query_id long, query string"), spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, embedding array<double>")
    got = {r.id: r for r in learned.candidates(queries, docs, vectors, asked, 1).collect()}
    assert {i: round(r.dense, 9) for i, r in got.items()} == {1: 0.6, 2: 1.0}
    assert (got[1].phrase, got[1].runs, round(got[1].words, 6)) == (1.0, 0.0, 0.666667)


def points_of(spark):
    return spark.createDataFrame([(i, [float(i), *[1.0] * 383], f"word{i} shared", f"f{i}") for i in range(20)], "id long, embedding array<double>, text string, filename string")


def saved(spark, points, path):
    bm25.save(bm25.index(points), path)
    return bm25.load(spark, path)


def failing(spark):
    return lambda *a, **b: spark.sql("select raise_error('the sparse side failed')").collect()


def test_a_failed_sparse_side_fails_the_evaluation_of_a_refresh(spark, tmp_path, monkeypatch):
    """Vectors alone would be measured as the fused search; a lost index is seen in what is found, and is an error to a refresh."""
    points, bench = points_of(spark), spark.createDataFrame([(1, "word3", ["f3"])], "query_id long, query string, expected_docs array<string>")
    asked = spark.createDataFrame([(1, "word3", [3.0, *[1.0] * 383])], "query_id long, query string, embedding array<double>")
    kept = saved(spark, points, f"{tmp_path}/an index")
    assert {r.sparse for r in search.retrieve(asked, points, search.Search(4), kept).collect()} == {True}
    shutil.rmtree(f"{tmp_path}/an index/terms")
    assert {r.sparse for r in search.retrieve(asked, points, search.Search(4), kept).collect()} == {False}
    with pytest.raises(FileNotFoundError):
        refresh.evaluation(points, bench, refresh.Settings(use_hybrid=True), kept)
    monkeypatch.setattr(bm25, "nearest", failing(spark))
    with pytest.raises(Exception, match="the sparse side failed"):
        refresh.evaluation(points, bench, refresh.Settings(use_hybrid=True))


def test_answers_of_vectors_alone_are_not_cached(spark, tmp_path, monkeypatch):
    points, at = points_of(spark), F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    asked = spark.createDataFrame([(1, "word3", [3.0, *[1.0] * 383])], "query_id long, query string, embedding array<double>")
    cache, kept = caches.AnswerCache(spark, str(tmp_path / "answers")), saved(spark, points, str(tmp_path / "ix"))
    ask = lambda index: search.search_and_answer(asked, points, cache, search.Search(4), at, lambda query, context: context, index)
    shutil.rmtree(tmp_path / "ix" / "postings")
    with pytest.raises(FileNotFoundError):
        ask(kept)
    with monkeypatch.context() as m, pytest.raises(Exception, match="the sparse side failed"):
        m.setattr(bm25, "nearest", failing(spark))
        ask(None)
    assert cache.entries(at).count() == 0
    assert [r.from_cache for r in ask(None).collect() + ask(None).collect()] == [False, True]
