"""Queries over vectors, cached answers, cost series, audit rows and index versions; and the runs that only Spark can express."""

from __future__ import annotations

import dataclasses
import datetime
import uuid

from pyspark.sql import functions as F

from siltwork.functions.text import content_hash
from siltwork.operators import answer_cache, audit, bm25, caches, chunking, cost, dedup, dense, lifecycle, metrics, upsert
from siltwork.plans import corpus, refresh
from siltwork.plans.search import Search, search_and_answer
from siltwork.plans.tables import days_after, now, queries_of, read, truth
from siltwork.sources import documents as sources
from siltwork.store import shared, stage
from siltwork.streaming import ingest


def _vectors(spark, d):
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def _probes(spark, d):
    """The query set: every vector whose id is divisible by 50."""
    return read(spark, d, "embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def _top(spark, d, metric, least=None):
    return dense.top_k(_vectors(spark, d), _probes(spark, d), 10, metric, least).select("query_id", "id", F.round("score", 6).alias("score"), "rank")


def vector_topk(spark, d):
    return _top(spark, d, "cosine")


def vector_topk_threshold(spark, d):
    return _top(spark, d, "cosine", 0.3)


def vector_topk_dot(spark, d):
    return _top(spark, d, "dot")


def vector_topk_euclid(spark, d):
    return _top(spark, d, "euclid")


def label_recall(spark, d):
    """Share of a query's ten nearest that have its label, the query itself left out."""
    labels = read(spark, d, "embeddings").select("vec_id", "label")
    near = dense.top_k(_vectors(spark, d), _probes(spark, d), 11).filter("id <> query_id")
    near = near.join(labels.select(F.col("vec_id").alias("id"), "label"), "id").join(labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("own")), "query_id")
    return near.groupBy("query_id").agg(F.round(F.avg((F.col("label") == F.col("own")).cast("double")), 6).alias("label_share"))


def semantic_cache_lookup(spark, d):
    entries = read(spark, d, "embeddings").select(
        F.col("vec_id").alias("entry_id"), F.lit("kb").alias("collection"), F.concat(F.lit("s"), F.col("label")).alias("settings"), "embedding", F.expr("timestamp_ntz'2024-02-14 23:52:00' + make_dt_interval(0, 0, 0, vec_id % 480)").alias("cached_at"))
    probes = read(spark, d, "embeddings").filter("vec_id % 50 = 0").select(
        F.col("vec_id").alias("query_id"), F.lit("kb").alias("collection"), F.concat(F.lit("s"), F.col("label")).alias("settings"), F.transform("embedding", lambda x: x.cast("double") + 0.02).alias("embedding"))
    return answer_cache.lookup(probes, entries, now())


def settings_fingerprint(spark, d):
    flags = read(spark, d, "nation").select("n_nationkey", (F.col("n_nationkey") % 2 == 0).alias("a"), (F.col("n_nationkey") % 3 == 0).alias("b"), (F.col("n_nationkey") % 5 == 0).alias("c"))
    return flags.select("n_nationkey", answer_cache.settings_hash_column(F.col("a"), F.col("b"), F.col("c"), F.col("n_nationkey")).alias("settings_hash"))


def collection_info(spark, d):
    return _vectors(spark, d).agg(F.count(F.lit(1)).alias("points_count"), F.min(F.size("embedding")).cast("long").alias("dimension"), F.max(F.size("embedding")).cast("long").alias("most_dimension"))


def _daily(spark, d, kind=None):
    events = read(spark, d, "events")
    events = events.filter(F.col("event_type") == kind) if kind else events
    return events.groupBy(F.to_date("ts").alias("day")).agg(F.sum("value").alias("cost"))


def cost_daily(spark, d):
    return _daily(spark, d).select("day", F.round("cost", 4).alias("cost"))


def _samples(spark, d):
    return _daily(spark, d).select(F.unix_date("day").cast("double").alias("day"), "cost").select((F.col("day") * 86400).alias("ts"), "cost")


_NOW_S = "1707955200"


def cost_forecast(spark, d):
    return cost.forecast(_samples(spark, d), F.lit(float(_NOW_S))).select("historical_points", "predicted_cost", "daily_avg", "monthly_estimate", "trend", "confidence", "r2_score", "forecast_note", "days_predicted")


def budget_alert(spark, d):
    rows = read(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("predicted"), (F.lit(5000.0) + F.col("c_nationkey") * 100).alias("budget"))
    used = cost.utilization(F.col("predicted"), F.col("budget"))
    return rows.select("c_custkey", cost.rounded(used, 1).alias("utilization"), cost.severity(used).alias("severity"))


def cost_diagnostics(spark, d):
    samples = _daily(spark, d, "purchase").select((F.unix_date("day").cast("double") * 86400).alias("ts"), "cost")
    out = cost.diagnostics(samples)
    floats = ("min_cost", "max_cost", "mean_cost", "median_cost", "std_dev", "total_cost", "trend_slope", "coefficient_of_variation")
    return out.select(*[F.round(c, 4).alias(c) if c in floats else F.col(c) for c in out.columns])


def month_to_date(spark, d):
    events = read(spark, d, "events")
    last = events.agg(F.max("ts").alias("m"))
    rows = events.join(F.broadcast(last)).filter(F.col("ts") >= F.date_trunc("month", "m"))
    return rows.agg(F.round(F.coalesce(F.sum("value"), F.lit(0.0)), 4).alias("month_to_date"))


def metric_range(spark, d):
    metrics = read(spark, d, "events").select(F.col("event_type").alias("name"), "ts", "value")
    return sources.metric_range(metrics, "purchase", 7).select("ts", F.round("cost", 6).alias("cost"))


def metric_reply(spark, d):
    """Replies of a metrics server, one for each type of event with a day's sum a sample, read back into samples."""
    daily = read(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum("value").alias("cost"))
    sample = F.array((F.unix_date("day").cast("long") * 86400).cast("string"), F.round("cost", 4).cast("string"))
    replies = daily.groupBy("event_type").agg(F.array_sort(F.collect_list(sample)).alias("values"))
    replies = replies.select(F.to_json(F.struct(F.struct(F.array(F.struct("values")).alias("result")).alias("data"))).alias("value"))
    return sources.range_reply(replies).groupBy(F.col("ts").cast("long").alias("ts")).agg(F.round(F.sum("cost"), 2).alias("cost"), F.count(F.lit(1)).alias("n_series"))


def _points(spark, d):
    return read(spark, d, "documents").select("doc_id", days_after("2023-01-01", "doc_id % 500").alias("created_at")).withColumn("expires_at", lifecycle.expires_at(F.col("created_at"), 365))


def expire_documents(spark, d):
    return lifecycle.unexpired(_points(spark, d), now()).select("doc_id", "expires_at")


def documents_upsert(spark, d):
    rows = read(spark, d, "documents").select("doc_id", "lang", content_hash(F.col("text")).alias("content_hash"), days_after("2024-01-01", "doc_id % 90").alias("created_at")).withColumn("last_updated", F.col("created_at"))
    return lifecycle.upserted(rows.filter("lang = 'en'").drop("lang"), rows.filter("lang is distinct from 'en'").drop("lang"))


def promote_copy(spark, d):
    docs = read(spark, d, "documents").select("doc_id", F.concat("source", F.lit("://"), "doc_id").alias("source_uri"))
    staged = docs.join(read(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").withColumn("version", F.lit(2))
    return lifecycle.promoted(docs.withColumn("version", F.lit(1)), staged)


def _evals(spark, d):
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_discount").alias("recall_at_5"), F.col("l_shipdate").alias("created_at"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))


def latest_recall(spark, d):
    return lifecycle.latest(_evals(spark, d))


def _log(spark, d):
    done = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("status"), done.alias("completed_at"))


def pipeline_health(spark, d):
    return lifecycle.health(_log(spark, d), _evals(spark, d), read(spark, d, "documents"), read(spark, d, "lineitem"))


def ingestion_log_current(spark, d):
    events = read(spark, d, "events").select(F.col("user_id").alias("run_id"), F.col("ts").alias("event_at"), F.col("event_id").alias("id"), F.col("event_type").alias("status"))
    return lifecycle.current_runs(events)


def _chunks(spark, d):
    docs = dedup.hashed(sources.from_table(read(spark, d, "documents")))
    return docs, chunking.chunked(docs.drop("metadata"), "content")


def chunks_to_documents(spark, d):
    """Chunks with the id of their document, found by content hash."""
    docs, chunks = _chunks(spark, d)
    rows = audit.chunk_rows(chunks, audit.document_rows(docs, now()), now())
    return rows.select("document_id", *[F.col(c).cast("long").alias(c) for c in ("chunk_index", "total_chunks", "token_count")], "point_id")


def audit_documents(spark, d):
    """English documents recorded first, then all: what was known keeps its row and gets the later update."""
    docs = dedup.hashed(sources.from_table(read(spark, d, "documents")))
    early = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    first = audit.document_rows(docs.filter(F.col("metadata")["lang"] == "en"), early)
    rows = audit.merged_documents(first, audit.document_rows(docs, now()))
    return rows.select("id", "source_type", "source_uri", F.col("file_size_bytes").cast("long").alias("file_size_bytes"), "created_at", "last_updated")


def audit_runs(spark, d):
    """Orders as runs: all are started, and those that are not open end."""
    orders = read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), F.lit("refresh").alias("dag_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("execution_date"), "o_orderstatus", "o_custkey")
    log = audit.started(orders, F.col("execution_date"))
    ends = orders.filter("o_orderstatus <> 'O'").select("run_id", F.col("o_custkey").alias("documents_extracted"), *[F.lit(None).cast("long").alias(c) for c in audit.COUNTERS[1:]],
                                                       F.when(F.col("o_orderstatus") == "P", "failed").alias("status"), F.when(F.col("o_orderstatus") == "P", "stopped").alias("error_message"))
    runs = audit.runs_now(log.unionByName(audit.completed(log, ends, F.col("started_at") + F.expr("interval 1 hour"))))
    return runs.select("run_id", "status", "error_message", F.col("documents_extracted").cast("long").alias("documents_extracted"), F.col("chunks_created").cast("long").alias("chunks_created"), "started_at", "completed_at")


def audit_evals(spark, d):
    """Lines as evaluations, in the fixed decimals of the table."""
    evals = read(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("run_id"), F.lit("kb").alias("collection_name"), (F.col("l_linenumber") - 1).alias("total_queries"), F.col("l_discount").alias("recall_at_1"),
        (F.col("l_discount") * 7 + F.col("l_tax") / 3).alias("recall_at_5"), F.lit(1.0).alias("recall_at_10"), (F.col("l_tax") / 7).alias("mrr"), (F.col("l_extendedprice") / 7).alias("avg_query_latency_ms"))
    rows = audit.eval_rows(evals, 0.35, now())
    return rows.select("run_id", F.col("total_queries").cast("long").alias("total_queries"), *[F.col(c).cast("double").alias(c) for c in ("recall_at_1", "recall_at_5", "mrr", "avg_query_latency_ms", "threshold_value")], "passed_threshold")


def _sent(spark, d):
    """Chunks in 40 batches by document; every seventh batch fails, from the fourth on."""

    def send(frame):
        if frame["batch"].iloc[0] % 7 == 3:
            raise ConnectionError("this batch is lost")

    _, chunks = _chunks(spark, d)
    points = chunks.select("content_hash", "chunk_index", (F.col("doc_id") % 40).alias("batch"))
    return points, stage(upsert.sent(points, send), "sent")


def upsert_counters(spark, d):
    return upsert.counters(_sent(spark, d)[1])


def upsert_confirmed(spark, d):
    """Hashes of documents all of whose chunks landed."""
    points, sent = _sent(spark, d)
    return dedup.landed_hashes(points, sent.filter("ok").select("content_hash", "chunk_index").distinct())


def collection_catalog(spark, d):
    """Two collections made, one filled and one deleted again."""
    kept = lifecycle.Collections(spark, _scratch(spark))
    size = read(spark, d, "embeddings").agg(F.max(F.size("embedding"))).first()[0]
    created = [kept.ensure("kb", size), kept.ensure("kb", size), kept.ensure("old", 3, "dot")]
    kept.upsert("kb", "v1", _vectors(spark, d))
    kept.versions("kb").promote("v1")
    gone = kept.delete("old")
    return kept.info().withColumns({"created": F.lit(created == [True, False, True]), "deleted": F.lit(gone)})


def run_messages(spark, d):
    rows = read(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, "promote").otherwise("rollback").alias("decision"), (F.col("n_nationkey") / 30).alias("recall"), (F.col("n_nationkey") / 29).alias("mrr"))
    return rows.select("n_nationkey", metrics.finished_message(F.col("decision"), F.col("n_nationkey") * 100, F.col("recall"), F.col("mrr")).alias("finished"), metrics.held_back_message(F.col("recall"), F.lit(0.75)).alias("held_back"),
                       metrics.failed_message(F.lit("embed"), F.col("decision")).alias("failed"))


def run_metrics(spark, d):
    """Metric rows of two runs; counters add up, gauges are as last set."""
    n = read(spark, d, "documents").count()
    rows = [metrics.rows(spark, f"run_{i}", {"documents": n, "share_known": i / 4, "recall_at_5": 0.5 + i / 8}, now() + F.expr(f"interval {i} hours")) for i in (1, 2)]
    return metrics.totals(rows[0].unionByName(rows[1]))


def run_tracking(spark, d):
    """Parameters, measures and tags of a run, logged twice: the later rows count."""
    n = read(spark, d, "documents").count()
    rows = [metrics.tracked(spark, "run_1", {"chunk_size": 256 * i}, {"documents": n * i}, {"trend": "stable"}, now() + F.expr(f"interval {i} hours")) for i in (1, 2)]
    return metrics.latest_tracked(rows[0].unionByName(rows[1]))


def cost_task(spark, d):
    """The cost summary, stored and read back."""
    path = _scratch(spark)
    cost.task(_samples(spark, d), F.lit(float(_NOW_S)), 1.25, 50.0, path)
    return spark.read.parquet(path).select("last_run_cost", "month_to_date", "monthly_forecast", "daily_avg", "trend", "confidence", "budget_limit", "budget_severity", "updated_at", "historical_points")


def cost_without_history(spark, d):
    """Too few samples: the forecast is a stub, whose missing columns get their defaults."""
    few = _samples(spark, d).filter(F.lit(False))
    return cost.normalised(cost.forecast(few, F.lit(float(_NOW_S))).select("predicted_cost", "confidence", "forecast_note")).select(*cost.DEFAULTS)


def cost_report(spark, d):
    samples = _daily(spark, d, "purchase").select((F.unix_date("day").cast("double") * 86400).alias("ts"), "cost")
    return cost.report(samples, _scratch(spark)).select("data_points", "outliers_count", "time_gaps", "trend", F.round("total_cost", 4).alias("total_cost"))


def fit_bands(spark, d):
    rows = read(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 100 / 100).alias("r2"))
    return rows.select("c_custkey", cost.fit_quality(F.col("r2")).alias("band"))


def search_cache(spark, d):
    """A saved sparse index: found at its version while it is young, and not otherwise."""
    cache = caches.SearchCache(spark, _scratch(spark))
    corpus = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    cache.put("kb", "v1", bm25.index(corpus), 1000.0)
    asked = (("same", "kb", "v1", 1200.0), ("old", "kb", "v1", 1400.0), ("other version", "kb", "v2", 1200.0), ("other collection", "kc", "v1", 1200.0))
    found = [(case, got.terms.count() if (got := cache.get(*key)) else 0) for case, *key in asked]
    cache.invalidate("kb")
    return spark.createDataFrame([*found, ("invalidated", 0 if cache.get("kb", "v1", 1200.0) is None else 1)], "state string, n_terms long")


def search_answers(spark, d):
    """All benchmark queries asked twice: the second time the cache answers. An answer is a digest of its context."""
    vectors = read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    points = docs.join(vectors, "id", "left")
    asked = queries_of(spark, d).join(vectors.select(F.col("id").alias("query_id"), "embedding"), "query_id")
    cache, index = caches.AnswerCache(spark, _scratch(spark)), bm25.index(docs)  # of the points' texts, without joining vectors to them
    answer = lambda query, context: F.sha2(context, 256)
    for _ in range(2):
        found = search_and_answer(asked, points, cache, Search(), now(), answer, index)
    return found


def _scratch(spark) -> str:
    return f"{shared(spark)}/run-{uuid.uuid4().hex}"


def refresh_run(spark, d):
    """Three runs: English documents, of which a batch is lost; the same again, of which only what was lost is new; and all, which the gate holds back."""
    every = sources.from_table(read(spark, d, "documents"))
    docs, english = (x.select("doc_id", "content", "source", "source_uri", "filename") for x in (every, every.filter(F.col("metadata")["lang"] == "en")))
    expected = truth(spark, d).groupBy("query_id").agg(F.collect_set("name").alias("expected_docs"))
    bench, path = stage(queries_of(spark, d).join(expected, "query_id", "left").withColumn("expected_docs", F.coalesce("expected_docs", F.array().cast("array<string>"))), "bench"), _scratch(spark)
    at = [F.lit(str(datetime.datetime(2024, 2, 15 + i))).cast("timestamp_ntz") for i in range(3)]

    def send(frame):
        if frame["batch"].iloc[0] == 0:
            raise ConnectionError("this batch is lost")

    ranked = refresh.Settings(use_hybrid=True, use_rerank=True, threshold=0.0)
    reports = [
        refresh.run(spark, "run_1", english, bench, path, at[0], dataclasses.replace(ranked, use_rerank=False), send=send),
        refresh.run(spark, "run_2", english, bench, path, at[1], ranked), refresh.run(spark, "run_3", docs, bench, path, at[2], dataclasses.replace(ranked, threshold=1.01)),
    ]
    return spark.createDataFrame([tuple(vars(r).values()) for r in reports], "run_id string, decision string, n_documents long, n_new long, n_chunks long, n_lost long, recall_5 double, mrr double")


def streaming_dedup(spark, d):
    """First sightings of a stream of documents, run to its present end."""
    schema, path = read(spark, d, "documents").schema, _scratch(spark)
    # A pattern, as a stream's own path has to be a folder and the table can be one file.
    stream = spark.readStream.schema(schema).parquet(f"{d}/[d]ocuments.parquet").withColumn("at", now().cast("timestamp"))
    query = ingest.first_sightings(stream, "text", "at").select("content_hash").writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema("content_hash string").parquet(f"{path}/out")


NAMES = (
    "vector_topk vector_topk_threshold vector_topk_dot vector_topk_euclid label_recall semantic_cache_lookup settings_fingerprint collection_info cost_daily cost_forecast budget_alert cost_diagnostics month_to_date "
    "metric_range metric_reply expire_documents documents_upsert promote_copy latest_recall pipeline_health ingestion_log_current chunks_to_documents audit_documents audit_runs audit_evals upsert_counters "
    "upsert_confirmed collection_catalog run_messages run_metrics run_tracking cost_task cost_without_history cost_report fit_bands search_cache search_answers refresh_run streaming_dedup"
).split()
QUERIES = {n: globals()[n] for n in NAMES}


def _nearest(score: str, where: str = "true", k: int = 10) -> str:
    return f"""n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) AS rank FROM (
  SELECT a.vec_id AS query_id, b.vec_id AS id, {score} AS score FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 50 = 0) a, (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) b) WHERE {where}) WHERE rank <= {k})"""


_TOP = "SELECT query_id, id, round(score, 6) AS score, rank::INTEGER AS rank FROM n"
_DAILY = "dy AS (SELECT ts::DATE AS day, sum(value) AS cost FROM events {} GROUP BY 1)"
_JSON = """'{"top_k": ' || n_nationkey || ', "use_hybrid_search": ' || (n_nationkey % 2 = 0) || ', "use_query_rewriting": ' || (n_nationkey % 3 = 0) || ', "use_reranking": ' || (n_nationkey % 5 = 0) || '}'"""
_CHUNKS = r"""w AS (SELECT doc_id, sha256(text) AS h, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS t FROM documents),
c AS (SELECT doc_id, h, t, ceil(len(t) / 462.0)::BIGINT AS n, unnest(range(0, ceil(len(t) / 462.0)::BIGINT)) AS i FROM w WHERE len(t) > 0)"""
ORACLES = {
    "vector_topk": f"WITH {_nearest('list_cosine_similarity(a.e, b.e)')} {_TOP}",
    "vector_topk_threshold": f"WITH {_nearest('list_cosine_similarity(a.e, b.e)', 'score >= 0.3')} {_TOP}",
    "vector_topk_dot": f"WITH {_nearest('list_inner_product(a.e, b.e)')} {_TOP}",
    "label_recall": f"WITH {_nearest('list_cosine_similarity(a.e, b.e)', k=11)} SELECT n.query_id, round(avg(CASE WHEN x.label = y.label THEN 1.0 ELSE 0.0 END), 6) AS label_share FROM n JOIN embeddings x ON x.vec_id = n.id JOIN embeddings y ON y.vec_id = n.query_id WHERE n.id <> n.query_id GROUP BY n.query_id",
    "semantic_cache_lookup": """WITH p AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE + 0.02::DOUBLE) AS e FROM embeddings WHERE vec_id % 50 = 0),
        s AS (SELECT p.vec_id AS query_id, x.vec_id AS entry_id, round(list_cosine_similarity(p.e, x.embedding::DOUBLE[]), 6) AS similarity FROM p JOIN embeddings x ON x.label = p.label
          WHERE TIMESTAMP '2024-02-14 23:52:00' + (x.vec_id % 480)::INTEGER * INTERVAL 1 SECOND + INTERVAL 300 SECOND > TIMESTAMP '2024-02-15')
        SELECT query_id, entry_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, entry_id) AS r FROM s) WHERE r = 1 AND similarity >= 0.95""",
    "settings_fingerprint": f"SELECT n_nationkey, left(sha256({_JSON}), 16) AS settings_hash FROM nation",
    "collection_info": "SELECT count(*) AS points_count, min(len(embedding))::BIGINT AS dimension, max(len(embedding))::BIGINT AS most_dimension FROM embeddings",
    "cost_daily": f"WITH {_DAILY.format('')} SELECT day, round(cost, 4) AS cost FROM dy",
    "cost_forecast": f"""WITH {_DAILY.format('')}, s AS (SELECT epoch(day)::DOUBLE AS ts, cost FROM dy), f AS (SELECT count(*) AS n, regr_slope(cost, ts) AS sl, regr_intercept(cost, ts) AS ic, regr_r2(cost, ts) AS r2 FROM s),
        g AS (SELECT *, ic + sl * ({_NOW_S}::DOUBLE + 30 * 86400) AS daily FROM f)
        SELECT n AS historical_points, round(daily * 30, 2) AS predicted_cost, round(daily, 4) AS daily_avg, round(daily * 30, 2) AS monthly_estimate, CASE WHEN sl > 0 THEN 'increasing' WHEN sl < 0 THEN 'decreasing' ELSE 'stable' END AS trend,
          CASE WHEN round(r2, 6) > 0.8 THEN 'high' WHEN round(r2, 6) > 0.5 THEN 'medium' ELSE 'low' END AS confidence, round(r2, 3) AS r2_score, '' AS forecast_note, 30 AS days_predicted FROM g""",
    "budget_alert": """WITH u AS (SELECT c_custkey, c_acctbal / (5000.0::DOUBLE + c_nationkey * 100) * 100 AS u FROM customer)
        SELECT c_custkey, round(u, 1) AS utilization, CASE WHEN u >= 100 THEN 'critical' WHEN u > 80 AND u < 90 THEN 'warning' ELSE 'ok' END AS severity FROM u""",
    "cost_diagnostics": f"""WITH {_DAILY.format("WHERE event_type = 'purchase'")}, r AS (SELECT cost, row_number() OVER (ORDER BY day) - 1 AS i, epoch(day) - lag(epoch(day)) OVER (ORDER BY day) AS gap FROM dy),
        s AS (SELECT count(*) AS n, min(cost) AS a, max(cost) AS b, avg(cost) AS m, quantile_cont(cost, 0.5) AS md, stddev_pop(cost) AS sd, sum(cost) AS t, regr_slope(cost, i) AS sl, quantile_cont(gap, 0.5) AS g FROM r)
        SELECT n AS data_points, round(a, 4) AS min_cost, round(b, 4) AS max_cost, round(m, 4) AS mean_cost, round(md, 4) AS median_cost, round(sd, 4) AS std_dev, round(t, 4) AS total_cost,
          (SELECT count(*) FROM r WHERE cost > m + 3 * sd OR cost < m - 3 * sd) AS outliers_count, (SELECT count(*) FROM r WHERE gap > 2 * g) AS time_gaps,
          (SELECT count(*) FROM r WHERE cost = 0) AS zero_costs, (SELECT count(*) FROM r WHERE cost < 0) AS negative_costs, round(sl, 4) AS trend_slope,
          CASE WHEN n < 3 THEN NULL WHEN sl > 0.01 THEN 'increasing' WHEN sl < -0.01 THEN 'decreasing' ELSE 'stable' END AS trend, CASE WHEN m > 0 THEN round(sd / m, 4) END AS coefficient_of_variation FROM s""",
    "month_to_date": "SELECT round(coalesce(sum(value), 0), 4) AS month_to_date FROM events WHERE ts >= (SELECT date_trunc('month', max(ts)) FROM events)",
    "metric_range": "SELECT ts, round(value, 6) AS cost FROM events WHERE event_type = 'purchase' AND ts >= (SELECT max(ts) - INTERVAL 7 DAY FROM events WHERE event_type = 'purchase')",
    "metric_reply": "SELECT epoch(day)::BIGINT AS ts, round(sum(c), 2) AS cost, count(*) AS n_series FROM (SELECT event_type, ts::DATE AS day, round(sum(value), 4) AS c FROM events GROUP BY 1, 2) GROUP BY day",
    "expire_documents": "SELECT doc_id, e AS expires_at FROM (SELECT doc_id, TIMESTAMP '2023-01-01' + (doc_id % 500)::INTEGER * INTERVAL 1 DAY + INTERVAL 365 DAY AS e FROM documents) WHERE e >= TIMESTAMP '2024-02-15'",
    "documents_upsert": """WITH r AS (SELECT doc_id, sha256(text) AS content_hash, TIMESTAMP '2024-01-01' + (doc_id % 90)::INTEGER * INTERVAL 1 DAY AS c FROM documents),
        o AS (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY c, doc_id) AS n, max(c) OVER (PARTITION BY content_hash) AS u FROM r) SELECT content_hash, doc_id, c AS created_at, u AS last_updated FROM o WHERE n = 1""",
    "promote_copy": "SELECT d.doc_id, d.source || '://' || d.doc_id AS source_uri, CASE WHEN l.doc_id IS NULL THEN 1 ELSE 2 END AS version FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id",
    "latest_recall": "SELECT l_discount AS latest_recall_at_5 FROM lineitem ORDER BY l_shipdate DESC, l_orderkey * 10 + l_linenumber DESC LIMIT 1",
    "pipeline_health": """WITH r AS (SELECT * FROM orders WHERE o_orderstatus <> 'O' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)
        SELECT r.o_orderdate AS last_run_time, r.o_orderstatus AS last_status, (SELECT l_discount FROM lineitem WHERE l_orderkey = (SELECT o_orderkey FROM r) ORDER BY l_shipdate DESC, l_linenumber DESC LIMIT 1) AS last_recall,
          (SELECT count(*) FROM documents) AS total_documents, (SELECT count(*) FROM lineitem) AS total_chunks FROM r""",
    "ingestion_log_current": "SELECT run_id, event_at, id, status FROM (SELECT user_id AS run_id, ts AS event_at, event_id AS id, event_type AS status, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
    "chunks_to_documents": f"WITH {_CHUNKS} SELECT h AS document_id, i AS chunk_index, n AS total_chunks, len(t[i * 462 + 1:i * 462 + 512])::BIGINT AS token_count, sha256(h || ':' || i) AS point_id FROM c",
    "audit_documents": """WITH d AS (SELECT sha256(text) AS id, coalesce(source, 'unknown') AS source_type, coalesce(source, 'unknown') || '://' || doc_id AS source_uri, octet_length(encode(text))::BIGINT AS file_size_bytes, lang FROM documents WHERE length(text) > 0),
        e AS (SELECT id, min(source_uri) FILTER (WHERE lang = 'en') AS u, min(source_uri) AS v FROM d GROUP BY id)
        SELECT e.id, d.source_type, d.source_uri, d.file_size_bytes, CASE WHEN u IS NULL THEN TIMESTAMP '2024-02-15' ELSE TIMESTAMP '2024-01-01' END AS created_at, TIMESTAMP '2024-02-15' AS last_updated FROM e JOIN d ON d.id = e.id AND d.source_uri = coalesce(u, v)""",
    "audit_runs": """SELECT o_orderkey::VARCHAR AS run_id, CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'P' THEN 'failed' ELSE 'success' END AS status, CASE o_orderstatus WHEN 'P' THEN 'stopped' END AS error_message,
        CASE o_orderstatus WHEN 'O' THEN 0 ELSE o_custkey END::BIGINT AS documents_extracted, 0::BIGINT AS chunks_created, o_orderdate::TIMESTAMP AS started_at, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate::TIMESTAMP + INTERVAL 1 HOUR END AS completed_at FROM orders""",
    "audit_evals": """SELECT l_orderkey || '-' || l_linenumber AS run_id, (l_linenumber - 1)::BIGINT AS total_queries, l_discount::DECIMAL(5, 4)::DOUBLE AS recall_at_1, (l_discount * 7 + l_tax / 3)::DECIMAL(5, 4)::DOUBLE AS recall_at_5, (l_tax / 7)::DECIMAL(5, 4)::DOUBLE AS mrr,
        (l_extendedprice / 7)::DECIMAL(10, 2)::DOUBLE AS avg_query_latency_ms, 0.35::DOUBLE AS threshold_value, l_discount * 7 + l_tax / 3 >= 0.35::DOUBLE AS passed_threshold FROM lineitem WHERE l_linenumber > 1""",
    "upsert_counters": f"WITH {_CHUNKS}, b AS (SELECT *, doc_id % 40 % 7 = 3 AS lost FROM c) SELECT count(*) FILTER (WHERE NOT lost) AS points_upserted, count(*) FILTER (WHERE lost) AS points_failed, count(DISTINCT doc_id % 40) FILTER (WHERE NOT lost) AS batches, count(DISTINCT doc_id % 40) FILTER (WHERE lost) AS batches_failed, count(*) FILTER (WHERE NOT lost) > 0 AS success FROM b",
    "upsert_confirmed": f"WITH {_CHUNKS} SELECT DISTINCT h AS content_hash FROM c WHERE doc_id % 40 % 7 <> 3",
    "collection_catalog": "SELECT 'kb' AS name, 'cosine' AS metric, max(len(embedding))::BIGINT AS dimension, count(*) AS points_count, true AS created, true AS deleted FROM embeddings",
    "run_messages": """SELECT n_nationkey, 'Run ended: ' || CASE WHEN n_nationkey % 2 = 0 THEN 'promote' ELSE 'rollback' END || '. ' || n_nationkey * 100 || ' documents read; the first five results hold ' || printf('%.1f', n_nationkey / 30 * 100) || ' % of what is expected (mean reciprocal rank ' || printf('%.3f', n_nationkey / 29) || ').' AS finished,
        'New version held back: recall in five is ' || printf('%.1f', n_nationkey / 30 * 100) || ' %, and 75.0 % is asked for. Searches still use the version before.' AS held_back, 'Step embed failed: ' || CASE WHEN n_nationkey % 2 = 0 THEN 'promote' ELSE 'rollback' END AS failed FROM nation""",
    "run_metrics": "SELECT 'documents' AS name, 'counter' AS kind, 2.0::DOUBLE * count(*) AS value FROM documents UNION ALL SELECT 'share_known', 'gauge', 0.5 UNION ALL SELECT 'recall_at_5', 'gauge', 0.75",
    "run_tracking": "SELECT 'run_1' AS run_id, 'parameter' AS kind, 'chunk_size' AS key, '512' AS text, NULL::DOUBLE AS value UNION ALL SELECT 'run_1', 'measure', 'documents', NULL, 2.0::DOUBLE * (SELECT count(*) FROM documents) UNION ALL SELECT 'run_1', 'tag', 'trend', 'stable', NULL",
    "cost_task": f"""WITH {_DAILY.format('')}, s AS (SELECT epoch(day)::DOUBLE AS ts, cost, day FROM dy), f AS (SELECT count(*) AS n, regr_slope(cost, ts) AS sl, regr_intercept(cost, ts) AS ic, regr_r2(cost, ts) AS r2 FROM s),
        g AS (SELECT *, ic + sl * ({_NOW_S}::DOUBLE + 30 * 86400) AS daily, (SELECT sum(cost) FROM s WHERE day >= DATE '2024-02-01') AS m FROM f)
        SELECT 1.25::DOUBLE AS last_run_cost, round(coalesce(round(m, 4), 1.25), 4) AS month_to_date, round(daily * 30, 2) AS monthly_forecast, round(daily, 4) AS daily_avg, CASE WHEN sl > 0 THEN 'increasing' WHEN sl < 0 THEN 'decreasing' ELSE 'stable' END AS trend,
          CASE WHEN round(r2, 6) > 0.8 THEN 'high' WHEN round(r2, 6) > 0.5 THEN 'medium' ELSE 'low' END AS confidence, 50.0::DOUBLE AS budget_limit, CASE WHEN daily * 30 / 50 * 100 >= 100 THEN 'critical' WHEN daily * 30 / 50 * 100 > 80 AND daily * 30 / 50 * 100 < 90 THEN 'warning' ELSE 'ok' END AS budget_severity,
          '2024-02-15 00:00' AS updated_at, n AS historical_points FROM g""",
    "cost_without_history": "SELECT 0.0::DOUBLE AS monthly_estimate, 0.0::DOUBLE AS daily_avg, 'unknown' AS trend, 'low' AS confidence, 0.0::DOUBLE AS r2_score, 'Insufficient: a line takes three points' AS forecast_note",
    "fit_bands": "SELECT c_custkey, CASE WHEN r2 >= 0.75 THEN 'good' WHEN r2 >= 0.7 THEN 'acceptable' WHEN r2 >= 0.5 THEN 'weak' ELSE 'rejected' END AS band FROM (SELECT c_custkey, (c_custkey % 100) / 100 AS r2 FROM customer)",
    "search_cache": rf"""WITH t AS (SELECT count(DISTINCT term) AS n FROM (SELECT unnest(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '')) AS term FROM documents))
        SELECT 'same' AS state, n AS n_terms FROM t UNION ALL SELECT unnest(['old', 'other version', 'other collection', 'invalidated']), 0""",
    "vector_topk_euclid": f"WITH {_nearest('-list_distance(a.e, b.e)')} {_TOP}",
}
ORACLES["streaming_dedup"] = "SELECT DISTINCT sha256(text) AS content_hash FROM documents WHERE length(text) > 0"
ORACLES["cost_report"] = f"SELECT data_points, outliers_count, time_gaps, trend, total_cost FROM ({ORACLES['cost_diagnostics']})"
#: The fused search over all documents, of which some have a vector.
_POINTS = corpus._hybrid(10).replace("ON item_id = a.vec_id, embeddings b)", "ON item_id = a.vec_id, (SELECT vec_id, embedding FROM embeddings JOIN documents ON doc_id = vec_id) b)")
ORACLES["search_answers"] = f"""WITH {_POINTS}, t AS (SELECT hy.query_id, string_agg(x.text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS c FROM hy JOIN documents x ON x.doc_id = hy.id WHERE rank <= 5 GROUP BY hy.query_id)
    SELECT b.item_id AS query_id, sha256(coalesce(c, '')) AS answer, true AS from_cache FROM benchmark b JOIN embeddings e ON e.vec_id = b.item_id LEFT JOIN t ON t.query_id = b.item_id"""
