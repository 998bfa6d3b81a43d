"""A refresh run: sources to a staged index version, evaluation, and promotion or discard, with its audit, measures and messages."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.text import point_id
from siltwork.operators import audit, bm25, caches, chunking, cost, dedup, embed, evaluate, hash_store, lifecycle, manifest, metrics, segments, upsert
from siltwork.plans import steps
from siltwork.plans.search import Search, retrieve
from siltwork.plans.steps import Step
from siltwork.store import passing, stage


@dataclass
class Settings:
    chunk_size: int = 512
    chunk_overlap: int = 50
    top_k: int = 10
    use_hybrid: bool = False
    use_rerank: bool = False
    threshold: float = 0.75
    expiration_days: int = 365
    batch_size: int = 100
    budget: float = 50.0
    dollars_per_million: float = 0.0
    keep: int = 3


@dataclass
class Report:
    run_id: str
    decision: str
    n_documents: int = 0
    n_new: int = 0
    n_chunks: int = 0
    n_lost: int = 0
    recall_5: float = 0.0
    mrr: float = 0.0


@dataclass
class Run:
    """One run below ``path``, where versions of the index, confirmed hashes, caches, audit tables, measures and the cost summary are kept."""

    spark: SparkSession
    run_id: str
    path: str
    now: Column
    settings: Settings = field(default_factory=Settings)
    send: Callable | None = None
    tell: Callable[[str], None] | None = None

    def __post_init__(self):
        self.versions = manifest.Manifests(self.spark, f"{self.path}/index")
        self.sparse = segments.Segments(self.spark, f"{self.path}/sparse")
        self.hashes = hash_store.HashStore(self.spark, f"{self.path}/hashes")
        self.audit = audit.Audit(self.spark, f"{self.path}/audit")
        self.answers = caches.AnswerCache(self.spark, f"{self.path}/answers")

    # The steps, by what they make. Counts are observed while a table is written, not counted afterwards.

    def dedup(self, docs: DataFrame):
        seen, fresh = Observation(), Observation()
        hashed = dedup.hashed(docs.observe(seen, F.count(F.lit(1)).alias("n")))
        hashed = stage(hashed, "hashed")
        new = stage(self.hashes.new_documents(hashed, self.now).observe(fresh, F.count(F.lit(1)).alias("n")), "new")
        return new, seen.get["n"], fresh.get["n"]

    def chunk(self, new: DataFrame):
        s = self.settings
        rows = chunking.chunked(new, "content", s.chunk_size, s.chunk_overlap)
        rows = rows.withColumn("id", point_id(F.col("content_hash"), F.col("chunk_index"))).withColumn("expires_at", lifecycle.expires_at(self.now, s.expiration_days))
        return rows.drop("metadata", "doc_id", "content")  # a point holds its own chunk; the whole text beside each would be as many times the text

    def embed(self, chunks: DataFrame):
        seen = Observation()
        points = stage(embed.embedded(chunks).observe(seen, F.count(F.lit(1)).alias("n"), F.sum("token_count").alias("words")), "points")
        return points, seen.get["n"], (seen.get["words"] or 0) * cost.TOKENS_A_WORD / 1e6 * self.settings.dollars_per_million

    def write(self, points: DataFrame):
        """Sends batches to the outside store, if there is one, and stages what landed with what production keeps."""
        landed, whole, lost = points, points.select("content_hash").distinct(), 0
        if self.send is not None:
            seen = Observation()
            result = upsert.sent(upsert.batched(points, self.settings.batch_size), self.send)
            result = stage(result.observe(seen, F.count_if(~F.col("ok")).alias("lost")), "sent")
            if lost := seen.get["lost"]:
                sent = result.filter("ok").select("content_hash", "chunk_index")
                landed = points.join(sent.dropDuplicates(), ["content_hash", "chunk_index"], "left_semi")
                whole = dedup.landed_hashes(points, landed)
        staged = self.versions.stage(self.run_id, landed, dead=~lifecycle.lives(self.now))
        return staged, landed, whole, lost, self.versions.staged(self.run_id)["dropped"]

    def prepare(self, staged: DataFrame, landed: DataFrame):
        """The sparse index of the new version: a segment for what landed, beside the segments that production has."""
        state, removed = self.versions.notes().get("sparse", []), None
        if state:
            gone = self.versions.read().join(landed.select("source_uri").distinct(), "source_uri", "left_semi").unionByName(self.versions.read().filter(~lifecycle.lives(self.now)))
            removed = numbered(gone).select("id")
        self.versions.note(self.run_id, "sparse", state := self.sparse.added(state, numbered(landed), removed))
        return state

    def evaluate(self, staged: DataFrame, state: list[str], benchmark: DataFrame):
        return evaluation(numbered(staged), benchmark, self.settings, self.sparse.index(state, benchmark))

    def decide(self, quality: dict, n_new: int):
        if not n_new:
            return "no_change"
        return "promote" if quality["recall_at_5"] >= self.settings.threshold else "rollback"

    def forecast(self, samples: DataFrame | None, dollars: float):
        dollars = dollars or 0.0
        if samples is None:
            samples = self.spark.createDataFrame([], "ts double, cost double")
        return cost.task(samples, F.unix_timestamp(self.now.cast("timestamp")).cast("double"), dollars, self.settings.budget, f"{self.path}/cost")

    def promote(self, whole: DataFrame, decision: str):
        """One entry of the log makes points and sparse index those of production together."""
        self.versions.promote(self.run_id)
        self.hashes.confirm(whole, self.now)
        self.answers.invalidate("kb")
        self.sparse.drop(self.versions.outlived("sparse", self.settings.keep))
        self.versions.vacuum(self.settings.keep)
        return "promoted"

    def discard(self):
        """The staged version and its segment go; production keeps its own, and the documents were never confirmed, so the next run sees them again."""
        own = set(self.versions.notes(self.run_id).get("sparse", [])) - set(self.versions.notes().get("sparse", []))
        self.versions.discard(self.run_id)
        self.sparse.drop(sorted(own))
        self.answers.invalidate("kb")
        return "discarded"

    def steps(self) -> list[Step]:
        return [
            Step("dedup", self.dedup, ("docs",), ("new", "n_documents", "n_new")),
            Step("chunk", self.chunk, ("new",), ("chunks",), given="n_new"),
            Step("embed", self.embed, ("chunks",), ("points", "n_chunks", "dollars"), given="n_new"),
            Step("write", self.write, ("points",), ("staged", "landed", "whole", "n_lost", "n_expired"), given="n_new"),
            Step("prepare", self.prepare, ("staged", "landed"), ("state",), given="n_new"),
            Step("evaluate", self.evaluate, ("staged", "state", "benchmark"), ("quality",), given="n_new"),
            Step("decide", self.decide, ("quality", "n_new"), ("decision",)),
            Step("forecast", self.forecast, ("samples", "dollars"), ("costs",)),
            Step("promote", self.promote, ("whole", "decision"), ("outcome",), "promote"),
            Step("discard", lambda decision: self.discard(), ("decision",), ("outcome",), "rollback"),
            Step("leave", lambda decision: "left", ("decision",), ("outcome",), "no_change"),
            Step("record", self.record, ("new", "points", "quality", "costs", "outcome", "n_documents", "n_new", "n_chunks", "n_lost", "n_expired", "dollars", "decision"), ("report",)),
        ]

    def record(self, new, points, quality, costs, outcome, n_documents, n_new, n_chunks, n_lost, n_expired, dollars, decision):
        s, at = self.settings, self.now
        if decision == "no_change":  # nothing was chunked, written or measured
            n_chunks = n_lost = n_expired = 0
            dollars, quality = 0.0, dict.fromkeys(("total_queries", "recall_at_1", "recall_at_5", "recall_at_10", "mrr", "milliseconds"), 0.0) | {"total_queries": 0}
        report = Report(self.run_id, decision, n_documents, n_new, n_chunks, n_lost, quality["recall_at_5"], quality["mrr"])
        if decision == "promote":
            self.audit.put_documents(audit.document_rows(new, at))
            self.audit.append("chunks", audit.chunk_rows(points, self.audit.documents(), at))
        self.audit.append("eval_results", audit.eval_rows(self.spark.createDataFrame([(self.run_id, "kb", quality["total_queries"], quality["recall_at_1"], quality["recall_at_5"], quality["recall_at_10"], quality["mrr"], quality["milliseconds"])],
                          "run_id string, collection_name string, total_queries long, recall_at_1 double, recall_at_5 double, recall_at_10 double, mrr double, avg_query_latency_ms double"), s.threshold, at))
        self._end("rolled_back" if decision == "rollback" else "success", None, n_documents, n_new, n_chunks, n_chunks, n_chunks - n_lost)
        values = {
            "documents": n_documents, "documents_new": n_new, "share_known": 1 - n_new / n_documents if n_documents else 0.0, "chunks": n_chunks, "chunks_a_document": n_chunks / n_new if n_new else 0.0,
            "embedding_dollars": dollars, "points_written": n_chunks - n_lost, "points_lost": n_lost, "recall_at_5": quality["recall_at_5"], "mrr": quality["mrr"],
            "milliseconds_a_query": quality["milliseconds"], "points_expired": n_expired, "dollars_a_month": costs["monthly_forecast"],
        }
        metrics.rows(self.spark, self.run_id, values, at).write.mode("append").parquet(f"{self.path}/metrics")
        metrics.tracked(self.spark, self.run_id, asdict(s), values, {"decision": decision, "budget": costs["budget_severity"], "trend": costs["trend"]}, at).write.mode("append").parquet(f"{self.path}/tracking")
        said = [metrics.finished_message(F.lit(decision), F.lit(n_documents), F.lit(report.recall_5), F.lit(report.mrr))]
        if decision == "rollback":
            said.append(metrics.held_back_message(F.lit(report.recall_5), F.lit(s.threshold)))
        if costs["budget_severity"] != "ok":
            said.append(F.lit(costs["budget_message"]))
        for m in self.spark.range(1).select(*[c.alias(f"m{i}") for i, c in enumerate(said)]).first():
            metrics.notify(m, self.tell)
        return report

    def _start(self) -> None:
        row = self.spark.createDataFrame([(self.run_id, "refresh")], "run_id string, dag_id string").withColumn("execution_date", self.now)
        self.audit.append("ingestion_log", audit.started(row, self.now))

    def _end(self, status: str, error: str | None, *counts: int) -> None:
        begun = self.audit.read("ingestion_log").filter((F.col("run_id") == self.run_id) & (F.col("status") == "running")).limit(1)
        ends = self.spark.createDataFrame([(self.run_id, *(counts or (None,) * len(audit.COUNTERS)), status, error)], f"run_id string, {', '.join(f'{c} long' for c in audit.COUNTERS)}, status string, error_message string")
        self.audit.append("ingestion_log", stage(audit.completed(begun, ends, self.now + F.expr("interval 1 second")), "ended"))

    def go(self, docs: DataFrame, benchmark: DataFrame, samples: DataFrame | None = None) -> Report:
        self._start()
        try:
            return steps.run(self.steps(), {"docs": docs, "benchmark": benchmark, "samples": samples})["report"]
        except steps.StepFailed as e:
            self._end("failed", str(e.error)[:1000])
            metrics.notify(self.spark.range(1).select(metrics.failed_message(F.lit(e.step), F.lit(str(e.error)[:1000]))).first()[0], self.tell)
            raise


def numbered(points: DataFrame) -> DataFrame:
    """Points with a number for an id and their text, as searches take them."""
    return points.select(F.xxhash64("id").alias("id"), "embedding", F.col("chunk_text").alias("text"), "filename")


def evaluation(points: DataFrame, benchmark: DataFrame, settings: Settings, index: bm25.Bm25 | None = None) -> dict:
    """Quality over all queries (query_id, query, expected_docs) by the chosen kind of search: dense, fused or re-scored; and milliseconds a query."""
    asked = embed.embedded(benchmark.select("query_id", "query"), text="query").select("query_id", "query", "embedding")
    search = Search(settings.top_k, settings.use_hybrid, settings.use_rerank)
    began = time.perf_counter()
    found = stage(retrieve(asked, points, search, index, whole=True).select("query_id", "id", "rank"), "found")
    seconds, n = time.perf_counter() - began, benchmark.count()
    names = found.filter(F.col("rank") <= settings.top_k).join(points.select("id", F.col("filename").alias("name")).distinct(), "id").select("query_id", "name", "rank")
    truth = benchmark.select("query_id", F.explode("expected_docs").alias("name"))
    quality = evaluate.summary(evaluate.judged(names, truth, benchmark)).first().asDict()
    return quality | {"milliseconds": round(1000 * seconds / n, 2) if n else 0.0}


def run(spark: SparkSession, run_id: str, docs: DataFrame, benchmark: DataFrame, path: str, now: Column, settings: Settings | None = None, send: Callable | None = None, tell: Callable[[str], None] | None = None, samples: DataFrame | None = None) -> Report:
    """docs: content, source, source_uri, filename; benchmark: query_id, query, expected_docs; samples: ts, cost of earlier runs.

    The next version holds what production held, less what new documents replace; hashes are confirmed after promotion,
    and only for documents all of whose chunks landed. A run without new documents ends with the decision ``no_change``.
    """
    with passing():  # a report is values, and what is kept lies below the path
        return Run(spark, run_id, path.rstrip("/"), now, settings or Settings(), send, tell).go(docs, benchmark, samples)
