"""Operators on small fixtures with known results."""

import datetime
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltwork.functions import text as T
from siltwork.functions import vectors as V
from siltwork.operators import answer_cache, bm25, chunking, cost, dedup, dense, embed, evaluate, hybrid, lifecycle, metrics, rewrite

NOW = datetime.datetime(2024, 2, 15)
FEW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lit(values):
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


@pytest.mark.parametrize("retrieved,expected,k,want", [
    (["d1", "d2", "d3", "d4", "d5"], ["d1", "d2"], 5, 1.0), (["d1", "d3", "d5", "d7", "d9"], ["d1", "d2", "d3"], 5, 2 / 3), (["d5", "d6", "d7", "d8", "d9"], ["d1", "d2", "d3"], 5, 0.0),
    (["d1", "d5", "d2", "d7", "d9"], ["d1", "d2"], 1, 0.5), (["d1", "d5", "d2", "d7", "d9"], ["d1", "d2"], 3, 1.0), (["d1"], [], 5, 0.0), ([], ["d1"], 5, 0.0), (["d1", "d1"], ["d1", "d1"], 5, 1.0)])
def test_recall(spark, retrieved, expected, k, want):
    assert one(spark, evaluate.recall_at(lit(retrieved), lit(expected), k)) == pytest.approx(want)


@pytest.mark.parametrize("retrieved,expected,want", [(["d1", "d2"], ["d1"], 1.0), (["d5", "d6", "d1"], ["d1", "d2"], 1 / 3), (["d5"], ["d1"], 0.0), (["d9", "d2", "d1"], ["d1", "d2"], 0.5), (["d1"], [], 0.0)])
def test_reciprocal_rank(spark, retrieved, expected, want):
    assert one(spark, evaluate.reciprocal_rank(lit(retrieved), lit(expected))) == pytest.approx(want)


def test_judged_agrees_with_arrays_and_counts_missing_queries(spark):
    ranked = spark.createDataFrame([(1, "d1", 1), (1, "d5", 2), (1, "d2", 3), (1, "d1", 4), (2, "x", 1)], "query_id long, name string, rank int")
    truth = spark.createDataFrame([(1, "d1"), (1, "d2"), (1, "d2"), (2, "d1"), (3, "d9")], "query_id long, name string")
    got = {r.query_id: (r.recall_1, r.recall_5, r.rr) for r in evaluate.judged(ranked, truth).collect()}
    assert got == {1: (0.5, 1.0, 1.0), 2: (0, 0, 0), 3: (0, 0, 0)}
    r = evaluate.summary(evaluate.judged(ranked, truth)).first()
    assert (r.total_queries, r.recall_at_1, r.recall_at_5, r.mrr) == (3, 0.1667, 0.3333, 0.3333)
    assert evaluate.summary(evaluate.judged(ranked, truth.limit(0))).first().mrr == 0.0


def test_gate(spark):
    assert [one(spark, evaluate.gate(F.lit(x).cast("double"))) for x in (0.75, 0.7499, None)] == ["promote", "rollback", "rollback"]


@pytest.mark.parametrize("text,want", [("Hello World", ["hello", "world"]), ("Hello, World!  How\tare\nyou?", ["hello,", "world!", "how", "are", "you?"]), ("", []), (" \n ", []), (None, [])])
def test_tokens(spark, text, want):
    assert one(spark, T.tokens(F.lit(text).cast("string"))) == want


def test_hash(spark):
    a, b, c = (one(spark, T.content_hash(F.lit(x))) for x in ("Document 1", "Document 1", "Document 2"))
    assert a == b != c and len(a) == 64


def docs(spark):
    return dedup.hashed(spark.createDataFrame([(1, "Document 1"), (2, "Document 2"), (3, "Document 1"), (4, ""), (5, None)], "doc_id long, content string"))


def test_dedup(spark):
    rows = docs(spark)
    store = rows.filter("doc_id = 2").select("content_hash", F.lit(NOW).cast("timestamp_ntz").alias("confirmed_at"))
    now = F.lit(NOW).cast("timestamp_ntz")
    assert sorted(r.doc_id for r in dedup.new_documents(rows, dedup.live(store, now)).collect()) == [1, 3]
    assert [r.doc_id for r in dedup.new_documents(rows, store, within_batch=True).collect()] == [1]
    later = F.lit(NOW + datetime.timedelta(days=30)).cast("timestamp_ntz")
    assert dedup.live(store, later).count() == 0
    fresh = dedup.confirm(store, rows, now)
    assert fresh.count() == 1 and dedup.confirm(store.unionByName(fresh), rows, now).count() == 0
    assert dedup.forget(store, rows).count() == 0
    assert tuple(dedup.stats(spark.range(5), rows, store).first()) == (5, 2, 1, 0.2)
    assert dedup.stats(spark.range(0), rows.limit(0), store).first().hit_rate == 0.0


def test_only_whole_documents_land(spark):
    chunks = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "content_hash string, chunk_index int")
    assert [r.content_hash for r in dedup.landed_hashes(chunks, chunks.filter("not (content_hash = 'a' and chunk_index = 1)")).collect()] == ["b"]


def windows(tokens, size, overlap):
    step = size if overlap >= size else size - overlap
    return [" ".join(tokens[i : i + size]) for i in range(0, len(tokens), step)]


@FEW
@given(st.lists(st.integers(0, 60), min_size=1, max_size=6), st.integers(1, 20), st.integers(0, 25))
def test_chunks(spark, lengths, size, overlap):
    rows = [(i, " ".join(f"w{j}" for j in range(n))) for i, n in enumerate(lengths)]
    got = chunking.chunked(spark.createDataFrame(rows, "i int, content string"), "content", size, overlap).collect()
    want = {(i, k): w for i, n in enumerate(lengths) for k, w in enumerate(windows([f"w{j}" for j in range(n)], size, overlap))}
    assert {(r.i, r.chunk_index): r.chunk_text for r in got} == want
    assert all(r.total_chunks == sum(1 for i, _ in want if i == r.i) and r.token_count == len(r.chunk_text.split()) for r in got)


def test_chunk_edges(spark):
    rows = spark.createDataFrame([(1, "Short text."), (2, ""), (3, None), (4, "  \n"), (5, "w " * 500)], "i int, content string")
    got = chunking.chunked(rows)
    assert sorted((r.i, r.chunk_index) for r in got.collect()) == [(1, 0), (5, 0), (5, 1)]
    assert got.filter("i = 1").first().chunk_text == "Short text."
    assert tuple(chunking.chunk_stats(rows, got).first()) == (5, 3, 0.6)
    with pytest.raises(ValueError):
        chunking.chunked(rows, size=0)


HR = [(1, "Employees get twenty vacation days per year"), (2, "The vacation policy allows carry over"), (3, "Remote work policy for all staff"), (4, "Health insurance covers the family"), (5, "Expense reports are due monthly")]


def okapi(corpus, query, k1=1.5, b=0.75, eps=0.25):
    toks = {i: t.lower().split() for i, t in corpus}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    df = Counter(w for t in toks.values() for w in set(t))
    idf = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: x if x >= 0 else eps * mean for w, x in idf.items()}
    return {i: sum(idf.get(w, 0) * t.count(w) * (k1 + 1) / (t.count(w) + k1 * (1 - b + b * len(t) / avg)) for w in query.lower().split()) for i, t in toks.items()}


@pytest.mark.parametrize("query", ["vacation policy", "vacation vacation the", "nothing known here", "Policy for staff"])
def test_bm25(spark, query):
    corpus = HR + [(6, "the the policy"), (7, "the policy of the house"), (8, "the end of policy the")]
    got = {r.id: r.score for r in bm25.scores(bm25.index(spark.createDataFrame(corpus, "id long, text string")), spark.createDataFrame([(1, query)], "query_id long, query string")).collect()}
    want = {i: x for i, x in okapi(corpus, query).items() if any(w in dict(corpus)[i].lower().split() for w in query.lower().split())}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)


def test_bm25_of_nothing(spark):
    ix = bm25.index(spark.createDataFrame([], "id long, text string"))
    assert bm25.scores(ix, spark.createDataFrame([(1, "a")], "query_id long, query string")).count() == 0


def test_bm25_ranks_and_normalises(spark):
    ix, q = bm25.index(spark.createDataFrame(HR, "id long, text string")), spark.createDataFrame([(1, "vacation policy")], "query_id long, query string")
    top = bm25.top(bm25.normalised(bm25.scores(ix, q)), 2).collect()
    assert [(r.id, r.rank) for r in top][0] == (2, 1) and top[0].norm == 1.0


def test_dense(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [-1.0, 0.0]), (5, [0.0, 0.0]), (6, None), (7, [1.0, 2.0, 3.0]), (8, [2.0, 0.0])], "id long, embedding array<float>").repartition(3)
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id long, embedding array<float>")
    assert [(r.id, round(r.score, 6)) for r in dense.top_k(v, q, 3).orderBy("rank").collect()] == [(1, 1.0), (8, 1.0), (3, 0.707107)]
    assert [r.id for r in dense.top_k(v, q, 9, least=0.0).orderBy("rank").collect()] == [1, 8, 3, 2, 5]
    assert [r.id for r in dense.top_k(v, q, 2, "dot").orderBy("rank").collect()] == [8, 1]
    assert [r.id for r in dense.top_k(v, q, 2, "euclid").orderBy("rank").collect()] == [1, 3]
    assert dense.top_k(v, q.limit(0), 3).count() == 0
    many = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(9)] + [(20, [1.0, 2.0, 3.0])], "query_id long, embedding array<float>")
    rows = lambda df: sorted((r.query_id, r.id, round(r.score, 9), r["rank"]) for r in df.collect())
    assert rows(dense.top_k(v, many, 2, block=4)) == rows(dense.top_k(v, many, 2)) and (20, 7, 1.0, 1) in rows(dense.top_k(v, many, 1, block=4))
    with pytest.raises(ValueError):
        dense.top_k(v, q, 3, "other")


def test_vectors(spark):
    a, b = F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(4.0), F.lit(3.0), F.lit(9.0))
    assert one(spark, V.dot(a, b)) == 24 and one(spark, V.norm(a)) == 5 and one(spark, V.cosine(a, F.array(F.lit(0.0), F.lit(0.0)))) == 0


@pytest.mark.parametrize("k,want", [(1, (1, 0)), (2, (1, 1)), (5, (3, 2)), (10, (5, 5))])
def test_fair_shares(k, want):
    assert hybrid.shares(k) == want


@pytest.mark.parametrize("weight", [0.0, 0.3, 0.5, 1.0])
def test_fusion(spark, weight):
    pairs = lambda rows, name: spark.createDataFrame([(1, i, x) for i, x in rows], f"query_id long, id long, {name} double")
    got = hybrid.fused(pairs([(1, 0.9), (2, 0.7), (3, 0.6)], "score"), pairs([(2, 4.0), (4, 2.0)], "score"), pairs([(2, 1.0), (4, 0.5), (3, 0.25)], "norm"), weight, 3).collect()
    want = {i: (1 - weight) * v + weight * s for i, v, s in [(1, 0.9, 0), (2, 0.7, 1), (3, 0.6, 0.25), (4, 0, 0.5)]}
    best = sorted(want, key=lambda i: (-round(want[i], 6), i))[:3]
    assert [(r.id, pytest.approx(r.combined_score)) for r in sorted(got, key=lambda r: r.rank)] == [(i, want[i]) for i in best]


def test_rerank(spark):
    rows = spark.createDataFrame([(1, 1, 1, 0.9, "vacation days", "a", None), (1, 2, 2, 0.8, "vacation days", "vacation text", None), (1, 3, 3, 0.7, "vacation days", "", "vacation days here")],
                                 "query_id long, id long, rank int, combined_score double, query string, payload_text string, text string")
    ranked = hybrid.reranked(rows, hybrid.lexical_score(F.col("query"), F.col("candidate_text")), 2)
    assert [(r.id, r.original_rank, r.reranker_score) for r in ranked.orderBy("rank").collect()] == [(3, 3, 1.0), (2, 2, 0.5)]
    assert hybrid.improvement(ranked, rows).first().improvement == pytest.approx(0.1)
    assert hybrid.context(ranked, 2).first().context == "vacation days here\n\n---\n\nvacation text"
    assert one(spark, hybrid.lexical_score(F.lit(""), F.lit("x"))) == 0


def test_histogram(spark):
    rows = spark.createDataFrame([(-2.0,), (-0.1,), (0.0,), (0.3,), (5.0,), (None,)], "v double")
    got = {r.le: r.n for r in metrics.histogram(rows, "v").collect()}
    assert got[-1.0] == 1 and got[0.0] == 3 and got[0.5] == 4 and got[1.0] == 4 and got[float("inf")] == 5


def test_metric_rows_and_messages(spark):
    got = metrics.rows(spark, "r", {"mrr": 0.5}, F.lit(NOW).cast("timestamp_ntz")).collect()
    assert [(r.step, r.name, r.kind, r.value) for r in got] == [("evaluate", "mrr", "gauge", 0.5)]
    with pytest.raises(ValueError):
        metrics.rows(spark, "r", {"unknown": 1}, F.lit(NOW).cast("timestamp_ntz"))
    assert one(spark, metrics.finished_message(F.lit("promote"), F.lit(847), F.lit(0.93), F.lit(0.82))) == "Run ended: promote. 847 documents read; the first five results hold 93.0 % of what is expected (mean reciprocal rank 0.820)."
    assert "75.0 % is asked for" in one(spark, metrics.held_back_message(F.lit(0.5), F.lit(0.75)))
    assert one(spark, metrics.failed_message(F.lit("chunk"), F.lit("boom"))) == "Step chunk failed: boom"
    heard = []
    assert metrics.notify("x", heard.append) and heard == ["x"] and not metrics.notify("x", None) and not metrics.notify("x", lambda m: 1 / 0)


@pytest.mark.parametrize("query,want", [
    ("What is the PTO policy?", ["What is the PTO policy?", "what is the paid time off policy?", "what is the pto OR paid time off policy?"]),
    ("What is the XYZ123 policy?", ["What is the XYZ123 policy?"]), ("", [""]), ("no acronyms", ["no acronyms"]), ("été hritage", ["été hritage"])])
def test_rewrite(spark, query, want):
    assert one(spark, rewrite.variations(F.lit(query))) == want


def test_rewrite_inside_words_and_two(spark):
    got = one(spark, rewrite.variations(F.lit("PTO and VPN setup")))
    assert len(got) == 5 and got[3] == "pto and virtual private network setup"
    assert "winformation technologyh information technology" in one(spark, rewrite.variations(F.lit("with it")))
    assert one(spark, rewrite.variations(F.lit("with it"), word_boundary=True))[1] == "with information technology"


DAYS = [1700000000.0 + 86400 * i for i in range(30)]


def samples(spark, costs, ts=DAYS):
    return spark.createDataFrame(list(zip(ts, map(float, costs), strict=False)), "ts double, cost double")


@pytest.mark.parametrize("costs,trend,confidence", [([1 + 0.1 * i for i in range(30)], "increasing", "high"), ([2.0] * 30, "stable", "high"), ([10 - 0.2 * i for i in range(30)], "decreasing", "high"), ([0.0] * 30, "stable", "high"), ([-1.0] * 30, "stable", "high")])
def test_forecast(spark, costs, trend, confidence):
    r = cost.forecast(samples(spark, costs), F.lit(DAYS[-1])).first()
    assert (r.trend, r.confidence, r.historical_points) == (trend, confidence, 30)
    assert r.monthly_estimate == pytest.approx(30 * (costs[-1] + 30 * (costs[-1] - costs[-2])), abs=0.02)


def test_forecast_needs_three_points(spark):
    r = cost.forecast(samples(spark, [1, 2]), F.lit(DAYS[-1])).first()
    assert r.confidence == "low" and "Insufficient" in r.forecast_note and r.predicted_cost == 0
    assert cost.forecast(samples(spark, []), F.lit(0.0)).first().historical_points == 0


@pytest.mark.parametrize("predicted,limit,severity", [(45, 50, "ok"), (42, 50, "warning"), (55, 50, "critical"), (40, 50, "ok"), (50, 50, "critical"), (48.5, 50, "ok")])
def test_budget(spark, predicted, limit, severity):
    p, b = F.lit(float(predicted)), F.lit(float(limit))
    assert one(spark, cost.severity(cost.utilization(p, b))) == severity
    assert f"{limit:.2f}" in one(spark, cost.budget_message(p, b))


def test_diagnostics(spark):
    r = cost.diagnostics(samples(spark, [2.0] * 28 + [100.0], [*DAYS[:28], DAYS[28] + 5 * 86400])).first()
    assert (r.data_points, r.outliers_count, r.time_gaps, r.zero_costs, r.negative_costs) == (29, 1, 1, 0, 0)
    assert r.median_cost == 2.0 and r.trend == "increasing" and r.coefficient_of_variation > 1
    assert cost.diagnostics(samples(spark, [-1.0, 0.0, -1.0])).first().coefficient_of_variation is None


def test_month_to_date_and_fit(spark):
    rows = spark.createDataFrame([(datetime.datetime(2024, 2, 1), 1.5), (datetime.datetime(2024, 1, 31), 9.0), (datetime.datetime(2024, 2, 3), 2.0)], "ts timestamp_ntz, cost double")
    now = F.lit(NOW).cast("timestamp_ntz")
    assert cost.month_to_date(rows, now, F.lit(7.0)).first()[0] == 3.5 and cost.month_to_date(rows.limit(0), now, F.lit(7.0)).first()[0] == 7.0
    assert [one(spark, cost.fit_quality(F.lit(x))) for x in (0.8, 0.72, 0.6, 0.1)] == ["good", "acceptable", "weak", "rejected"]


def test_settings_hash(spark):
    assert answer_cache.settings_hash(True, False, False, 5) == "80dd8f3d999e1194"
    assert one(spark, answer_cache.settings_hash_column(F.lit(True), F.lit(False), F.lit(False), F.lit(5))) == "80dd8f3d999e1194"


def test_answer_cache(spark):
    old = NOW - datetime.timedelta(seconds=301)
    entries = spark.createDataFrame([(1, "kb", "s", [1.0, 0.0], NOW), (2, "kb", "s", [1.0, 0.05], NOW), (3, "kb", "t", [1.0, 0.0], NOW), (4, "kb", "s", [0.0, 1.0], old), (5, "kb", "s", [1.0, 0.0], NOW)],
                                    "entry_id long, collection string, settings string, embedding array<double>, cached_at timestamp_ntz")
    probes = spark.createDataFrame([(1, "kb", "s", [1.0, 0.0]), (2, "kb", "s", [0.0, 1.0]), (3, "other", "s", [1.0, 0.0])], "query_id long, collection string, settings string, embedding array<double>")
    hits = answer_cache.lookup(probes, entries, F.lit(NOW).cast("timestamp_ntz"))
    assert [tuple(r) for r in hits.collect()] == [(1, 1, 1.0)]
    assert sorted(r.query_id for r in answer_cache.misses(probes, hits).collect()) == [2, 3]
    assert answer_cache.invalidated(entries, "kb").count() == 0


def test_health_and_latest(spark):
    at = lambda d: datetime.datetime(2024, 1, d)
    log = spark.createDataFrame([(1, "a", "success", at(3)), (2, "b", "failed", at(5)), (3, "c", "running", None)], "id long, run_id string, status string, completed_at timestamp_ntz")
    evals = spark.createDataFrame([(1, "b", 0.9, at(1)), (2, "b", 0.93, at(2)), (3, "a", 0.1, at(9))], "id long, run_id string, recall_at_5 double, created_at timestamp_ntz")
    assert tuple(lifecycle.health(log, evals, spark.range(3), spark.range(7)).first()) == (at(5), "failed", 0.93, 3, 7)
    assert lifecycle.health(log.filter("completed_at is null"), evals, spark.range(3), spark.range(7)).count() == 0
    assert lifecycle.latest(evals).first()[0] == 0.1


def test_expiry(spark):
    rows = spark.createDataFrame([(1, NOW), (2, NOW - datetime.timedelta(seconds=1)), (3, None)], "id long, expires_at timestamp_ntz")
    assert sorted(r.id for r in lifecycle.unexpired(rows, F.lit(NOW).cast("timestamp_ntz")).collect()) == [1, 3]
    assert one(spark, lifecycle.expires_at(F.lit(NOW).cast("timestamp_ntz"), 0)) is None
    assert one(spark, lifecycle.expires_at(F.lit(NOW).cast("timestamp_ntz"), 2)) == NOW + datetime.timedelta(days=2)


def test_versions(spark, tmp_path):
    store = lifecycle.Versions(spark, str(tmp_path / "kb"))
    assert store.current() is None and store.info() == {}
    store.stage("one", spark.range(3))
    store.promote("one")
    store.stage("two", spark.range(5))
    assert store.info() == {"version": "one", "points_count": 3} and not store.discard("one")
    store.promote("two")
    assert store.current() == "two" and store.read("one").count() == 3
    store.stage("three", spark.range(1))
    assert store.discard("three") and store.current() == "two"


def test_promotion_keeps_what_is_not_replaced(spark):
    old, new = spark.createDataFrame([("a", 1), ("b", 1)], "source_uri string, v int"), spark.createDataFrame([("b", 2), ("c", 2)], "source_uri string, v int")
    assert sorted(map(tuple, lifecycle.promoted(old, new).collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_embedding(spark):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def run(texts):
            calls.add(1)
            return [[float(len(t)), 0.0, 1.0] for t in texts]

        return run

    rows = spark.createDataFrame([(i, "x" * i) for i in range(4)], "i int, chunk_text string").coalesce(1)
    got = embed.embedded(rows, "m", load, batch_size=2).collect()
    assert [r.embedding[0] for r in got] == [0, 1, 2, 3] and got[0].embedding_dimension == 3 and got[0].embedding_model == "m" and calls.value == 2
    assert embed.embedded(rows.limit(0)).count() == 0
    unit = embed.hashed_features(16)(["same words here", "same words here", ""])
    assert (unit[0] == unit[1]).all() and abs((unit[0] ** 2).sum() - 1) < 1e-9 and not unit[2].any()


def test_embedding_fails_after_its_attempts(spark):
    def load():
        def run(texts):
            raise RuntimeError("no model")

        return run

    with pytest.raises(Exception, match="no model"):
        embed.embedded(spark.createDataFrame([("x",)], "chunk_text string"), load=load).collect()


def test_rewritten_with_a_provider(spark):
    queries = spark.createDataFrame([(1, "PTO"), (2, "boom"), (3, "x")], "query_id long, query string")

    def provider(query, most):
        if query == "boom":
            raise RuntimeError
        return [query, "one", "two", "three"]

    got = {r.query_id: r.variations for r in rewrite.rewritten(queries, provider).collect()}
    assert got == {1: ["PTO", "one", "two"], 2: ["boom"], 3: ["x", "one", "two"]}
    assert {r.query_id: r.n_added for r in rewrite.rewritten(queries).collect()} == {1: 2, 2: 0, 3: 0}


def test_saved_index_scores_alike(spark, tmp_path):
    corpus, q = spark.createDataFrame(HR, "id long, text string"), spark.createDataFrame([(1, "vacation policy")], "query_id long, query string")
    ix = bm25.index(corpus)
    bm25.save(ix, str(tmp_path / "ix"))
    rows = lambda i: sorted((r.id, round(r.score, 12)) for r in bm25.scores(i, q).collect())
    assert rows(bm25.load(spark, str(tmp_path / "ix"))) == rows(ix)


def test_cost_summary(spark):
    r = cost.summary(samples(spark, [1 + 0.1 * i for i in range(30)]), F.lit(DAYS[-1]), 0.5).first()
    assert len(r) == 14 and r.trend == "increasing" and r.budget_severity == "critical" and r.historical_points == 30
    assert cost.summary(samples(spark, [1.0]), F.lit(DAYS[0]), 0.5).first().monthly_forecast == 0


def test_steps():
    from siltwork.plans import refresh, steps
    from siltwork.plans.steps import Step

    run = refresh.Run.__new__(refresh.Run)
    own = run.steps()
    assert steps.problems(own, ("docs", "benchmark", "samples"), ("report",)) == []
    names = [s.name for s in steps.in_order(reversed(own))]
    assert names.index("dedup") < names.index("chunk") < names.index("embed") < names.index("write") < names.index("evaluate") < names.index("decide") < names.index("promote") < names.index("record")
    done = []
    made = [Step("b", lambda x: done.append(x) or "yes", ("x",), ("decision",)), Step("a", lambda: 3, (), ("x",)), Step("c", lambda: "c", (), ("y",), "yes"), Step("d", lambda: "d", (), ("y",), "no"), Step("e", lambda: 1 / 0, (), ("z",), given="nothing")]
    assert steps.run([made[1], made[0], *made[2:]], {})["y"] == "c" and done == [3]
    assert steps.problems([made[1], made[1]], (), ("z",)) == ["nothing makes z", "x is made by a and a, which can both run", "two steps are called a", "a makes only what nobody reads", "a makes only what nobody reads"]
    assert steps.problems([Step("p", id, ("q",), ("r",)), Step("s", id, ("r",), ("q",))], (), ()) == ["these steps read each other's values: p, s"]
    assert steps.problems([Step("p", id, ("q",))], (), ()) == ["p reads q, which nothing makes"]
    with pytest.raises(steps.StepFailed):
        steps.run([Step("f", lambda: 1 / 0)], {})


def test_search(spark):
    from siltwork.plans.search import Search, answered, retrieve

    run = embed.hashed_features(64)
    texts = [t for _, t in HR]
    points = spark.createDataFrame([(i, t, [float(x) for x in v]) for (i, t), v in zip(HR, run(texts), strict=True)], "id long, text string, embedding array<double>")
    asked = spark.createDataFrame([(1, "vacation policy", [float(x) for x in run(["vacation policy"])[0]])], "query_id long, query string, embedding array<double>")
    for search in (Search(top_k=3), Search(top_k=3, use_hybrid=False), Search(top_k=2, use_rerank=True)):
        found = retrieve(asked, points, search).orderBy("rank").collect()
        assert found[0].id == 2 and len(found) <= search.top_k and found[0].candidate_text == texts[1]
    scored = retrieve(asked, points, Search(top_k=2, use_rerank=True), score=hybrid.model_score(lambda: lambda pairs: [float(len(t)) for _, t in pairs])).orderBy("rank").collect()
    assert scored[0].reranker_score >= scored[-1].reranker_score
    search = Search()
    entries = spark.createDataFrame([(5, "kb", search.settings, [float(x) for x in run(["vacation policy"])[0]], NOW)], "entry_id long, collection string, settings string, embedding array<double>, cached_at timestamp_ntz")
    hits, misses = answered(asked, entries, search, F.lit(NOW).cast("timestamp_ntz"))
    assert hits.first().entry_id == 5 and misses.count() == 0


def test_audit_tables(spark, tmp_path):
    from siltwork.operators import audit

    at = F.lit(NOW).cast("timestamp_ntz")
    log = audit.Audit(spark, str(tmp_path))
    runs = spark.createDataFrame([("r1", "d"), ("r2", "d")], "run_id string, dag_id string").withColumn("execution_date", F.lit(None).cast("timestamp_ntz"))
    log.append("ingestion_log", audit.started(runs, at))
    ends = spark.createDataFrame([("r1", 5, None, None, None, 7, None, None), ("r9", 1, 1, 1, 1, 1, "failed", "x")], f"run_id string, {', '.join(f'{c} long' for c in audit.COUNTERS)}, status string, error_message string")
    log.append("ingestion_log", audit.completed(audit.started(runs, at), ends, at + F.expr("interval 1 minute")))
    now_ = {r.run_id: r for r in audit.runs_now(log.read("ingestion_log")).collect()}
    assert set(now_) == {"r1", "r2"} and now_["r1"].status == "success" and now_["r1"].documents_extracted == 5 and now_["r1"].chunks_created == 0 and now_["r1"].vectors_upserted == 7
    assert now_["r2"].status == "running" and now_["r2"].completed_at is None
    docs = spark.createDataFrame([("h1", "u2", "s", "f", "text"), ("h1", "u1", None, "f", "text"), ("", "u", "s", "f", "x"), (None, "u", "s", "f", "x")], "content_hash string, source_uri string, source string, filename string, content string")
    log.put_documents(audit.document_rows(docs, at))
    log.put_documents(audit.document_rows(docs, at + F.expr("interval 1 day")))
    (only,) = log.documents().collect()
    assert (only.source_uri, only.source_type, only.file_size_bytes) == ("u1", "unknown", 4) and (only.last_updated - only.created_at).days == 1
    chunks = spark.createDataFrame([("h1", 0, 1, "t", 3), ("h2", 0, 1, "t", 3)], "content_hash string, chunk_index int, total_chunks int, chunk_text string, token_count int")
    assert [r.document_id for r in audit.chunk_rows(chunks, log.documents(), at).collect()] == ["h1"]
    evals = spark.createDataFrame([("r1", "kb", 3, 0.5, 0.74995, 1.0, None, 12.345), ("r2", "kb", 0, 0.5, 1.0, 1.0, 1.0, 1.0)], "run_id string, collection_name string, total_queries long, recall_at_1 double, recall_at_5 double, recall_at_10 double, mrr double, avg_query_latency_ms double")
    (row,) = audit.eval_rows(evals, 0.75, at).collect()
    assert str(row.recall_at_5) == "0.7500" and row.passed_threshold is False


def test_upsert_goes_on_after_a_failure(spark):
    from siltwork.operators import upsert

    points = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("h"), F.floor(F.col("id") / 4)).alias("content_hash"), (F.col("id") % 4).cast("int").alias("chunk_index"))

    def send(frame):
        if frame["batch"].iloc[0] == 2:
            raise OSError("lost")

    batched = upsert.batched(points, 100)
    sent = upsert.sent(batched, send).cache()
    lost = batched.filter("batch = 2").count()
    r = upsert.counters(sent).first()
    assert (r.points_upserted, r.points_failed, r.batches_failed, r.success) == (1000 - lost, lost, 1, True) and 0 < lost < 1000
    whole = {x.content_hash for x in dedup.landed_hashes(batched, sent.filter("ok")).collect()}
    assert whole == {f"h{k}" for k in range(250)} - {x.content_hash for x in batched.filter("batch = 2").collect()}
    assert upsert.counters(upsert.sent(batched.limit(0), send)).first().success is False


def test_collections(spark, tmp_path):
    kept = lifecycle.Collections(spark, str(tmp_path))
    assert kept.ensure("kb", 2) and not kept.ensure("kb", 2)
    with pytest.raises(ValueError):
        kept.ensure("kb", 3)
    with pytest.raises(Exception, match="2 dimensions"):
        kept.upsert("kb", "v1", spark.createDataFrame([([1.0],)], "embedding array<double>"))
    assert kept.info().collect()[0].points_count == 0 and kept.delete("kb") and kept.info().count() == 0


def test_nearest_with_ties_and_parts(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(-2, 3, (4000, 3)).astype(float)
    vectors = spark.createDataFrame([(i, i % 3, x.tolist()) for i, x in enumerate(v)], "id long, part long, embedding array<double>")
    queries = vectors.filter("id % 50 = 0").withColumnRenamed("id", "query_id")
    got = dense.top_k(vectors.repartition(5), queries, 7)
    want = {}
    for i in range(0, 4000, 50):
        n = np.linalg.norm(v[i]) * np.linalg.norm(v, axis=1)
        s = np.round(np.divide(v @ v[i], n, out=np.zeros(4000), where=n > 0), 6)
        want[i] = sorted((j for j in range(4000) if j % 3 == i % 3), key=lambda j: (-s[j], j))[:7]
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.id)
    assert found == want


def test_texts_that_contain_queries(spark):
    from siltwork.plans.tables import containing

    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "xa b c d ex\ny"), (3, "b c"), (4, None), (5, ""), (6, "a b\nc d e f")], "id long, text string")
    queries = spark.createDataFrame([(1, "a b c d e"), (2, "b c"), (3, "c"), (4, "b\nc d e"), (5, "a b c d e f g"), (6, None), (7, "b c d")], "query_id long, query string")
    want = {(d.id, q.query_id) for d in docs.collect() for q in queries.collect() if d.text is not None and q.query is not None and q.query in d.text}
    assert {(r.id, r.query_id) for r in containing(docs, queries).collect()} == want


def test_search_without_its_sparse_index(spark, tmp_path):
    """An index whose files are gone: the vectors decide alone."""
    from siltwork.plans.search import Search, retrieve

    points = spark.createDataFrame([(i, [float(i), 1.0], f"word{i} shared") for i in range(20)], "id long, embedding array<double>, text string")
    asked = spark.createDataFrame([(1, "word3", [3.0, 1.0])], "query_id long, query string, embedding array<double>")
    bm25.save(bm25.index(points), str(tmp_path / "ix"))
    kept = bm25.load(spark, str(tmp_path / "ix"))
    whole = retrieve(asked, points, Search(4), kept).collect()
    import shutil

    shutil.rmtree(tmp_path / "ix")
    alone = retrieve(asked, points, Search(4), kept).collect()
    assert {r.id for r in alone} == {r.id for r in dense.top_k(points, asked, 4).collect()} and {r.id for r in whole} == {3, 4}
    assert [r.id for r in sorted(whole, key=lambda r: r.rank)][0] == 3


def test_answers_are_cached_and_dropped(spark, tmp_path):
    from siltwork.operators import caches

    cache, at = caches.AnswerCache(spark, str(tmp_path)), F.lit(NOW).cast("timestamp_ntz")
    probes = spark.createDataFrame([(7, "kb", "s", [1.0, 0.0]), (8, "kb", "t", [1.0, 0.0])], "query_id long, collection string, settings string, embedding array<double>")
    assert cache.get(probes, at).count() == 0
    cache.put(spark.createDataFrame([(1, "kb", "s", [1.0, 0.01], "yes", ["a"])], "entry_id long, collection string, settings string, embedding array<double>, answer string, results array<string>"), at)
    assert [(r.query_id, r.answer, r.results) for r in cache.get(probes, at).collect()] == [(7, "yes", ["a"])]
    assert cache.get(probes, at + F.expr("interval 301 seconds")).count() == 0
    assert cache.invalidate("kb") and cache.get(probes, at).count() == 0


def test_only_the_live_entry_of_the_own_collection_and_settings_answers(spark, tmp_path):
    from siltwork.operators import caches

    cache, at = caches.AnswerCache(spark, str(tmp_path)), F.lit(NOW).cast("timestamp_ntz")
    schema = "entry_id long, collection string, settings string, embedding array<double>, answer string, results array<string>"
    put = lambda answer, when, collection="kb", settings="s": cache.put(spark.createDataFrame([(1, collection, settings, [1.0, 0.0], answer, [answer])], schema), when)
    put("old", at - F.expr("interval 1 hour"))
    put("earlier", at - F.expr("interval 200 seconds"))
    put("new", at)
    put("other settings", at, settings="t")
    put("other collection", at, collection="kc")
    probe = spark.createDataFrame([(7, "kb", "s", [1.0, 0.0]), (8, "none", "s", [1.0, 0.0]), (9, None, "s", [1.0, 0.0])], "query_id long, collection string, settings string, embedding array<double>")
    assert [(r.query_id, r.answer, r.results) for r in cache.get(probe, at).collect()] == [(7, "new", ["new"])]
    assert [r.answer for r in cache.get(probe, at - F.expr("interval 3400 seconds")).filter("query_id = 7").collect()]  # then only the old one lived, or those put since
    assert cache.expire(at) == 1 and cache.expire(at) == 0
    assert [r.answer for r in cache.get(probe, at).collect()] == ["new"]
    assert cache.get(probe, at + F.expr("interval 301 seconds")).count() == 0


def test_asked_again_later_a_query_gets_its_own_answer(spark, tmp_path):
    from siltwork.operators import caches
    from siltwork.plans.search import Search, search_and_answer

    cache, at = caches.AnswerCache(spark, str(tmp_path)), F.lit(NOW).cast("timestamp_ntz")
    points = spark.createDataFrame([(1, "red apples", [1.0, 0.0]), (2, "green pears", [0.0, 1.0]), (3, "no vector apples", None)], "id long, text string, embedding array<double>")
    asked = spark.createDataFrame([(5, "apples", [1.0, 0.1])], "query_id long, query string, embedding array<double>")
    for minutes, search, mark in ((0, Search(2), "a"), (1, Search(2), "b"), (1, Search(3), "c"), (10, Search(2), "d"), (11, Search(2), "e"), (11, Search(2, collection="kc"), "f")):
        got = search_and_answer(asked, points, cache, search, at + F.expr(f"interval {minutes} minutes"), lambda q, c, mark=mark: F.concat(F.lit(mark), q)).collect()
        assert [(r.answer[0], r.from_cache) for r in got] == [{"a": ("a", False), "b": ("a", True), "c": ("c", False), "d": ("d", False), "e": ("d", True), "f": ("f", False)}[mark]]
