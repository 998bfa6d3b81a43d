"""Audit tables: append-only Parquet with fixed types; the state of a run is its last event."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.text import point_id
from siltwork.operators import lifecycle
from siltwork.operators.caches import Folder
from siltwork.schemas import CHUNKS, DOCUMENTS, EVAL_RESULTS, INGESTION_LOG, fields

TABLES = {"documents": DOCUMENTS, "chunks": CHUNKS, "eval_results": EVAL_RESULTS, "ingestion_log": f"{INGESTION_LOG}, event_at timestamp_ntz"}
COUNTERS = ("documents_extracted", "documents_deduplicated", "chunks_created", "chunks_embedded", "vectors_upserted")
#: How a run can end.
ENDINGS = ("success", "failed", "rolled_back")


def typed(rows: DataFrame, schema: str) -> DataFrame:
    """The columns of a schema, cast; decimals round half up, columns that are missing are null."""
    return rows.select(*[(F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name) for name, kind in fields(schema)])


def started(runs: DataFrame, at: Column) -> DataFrame:
    """Log rows of runs (run_id, dag_id, execution_date) that begin at ``at``: status running, counters 0, no end yet."""
    rows = runs.withColumns({"id": F.col("run_id"), "status": F.lit("running"), "started_at": at, "event_at": at, "execution_date": F.coalesce("execution_date", at), **dict.fromkeys(COUNTERS, F.lit(0))})
    return typed(rows, TABLES["ingestion_log"])


def completed(runs: DataFrame, ends: DataFrame, at: Column) -> DataFrame:
    """Log rows of runs that end: ``runs`` as started, ends: run_id, counters, status and error_message. Ends without a start change nothing; counters that are null are 0."""
    own = ends.select(F.col("run_id").alias("_run"), *[F.coalesce(c, F.lit(0)).alias(f"_{c}") for c in COUNTERS], F.coalesce("status", F.lit("success")).alias("_status"), F.col("error_message").alias("_error"))
    rows = runs.join(own, F.col("run_id") == F.col("_run"))
    rows = rows.withColumns({**{c: F.col(f"_{c}") for c in COUNTERS}, "status": F.col("_status"), "error_message": F.col("_error"), "completed_at": at, "event_at": at})
    return typed(rows, TABLES["ingestion_log"])


def runs_now(log: DataFrame) -> DataFrame:
    """The last event of each run."""
    return typed(lifecycle.current_runs(log), INGESTION_LOG)


def document_rows(docs: DataFrame, now: Column) -> DataFrame:
    """Rows of documents (content, content_hash, source, source_uri, filename), one for each hash; rows without a hash are skipped."""
    rows = docs.filter(F.length("content_hash") > 0).groupBy("content_hash").agg(
        F.min(F.struct("source_uri", "source", "filename", F.octet_length("content").alias("bytes"))).alias("d"))
    rows = rows.select(F.col("content_hash").alias("id"), F.coalesce("d.source", F.lit("unknown")).alias("source_type"), "d.source_uri", "d.filename", "content_hash", F.col("d.bytes").alias("file_size_bytes"), now.alias("created_at"), now.alias("last_updated"))
    return typed(rows, DOCUMENTS)


def merged_documents(table: DataFrame, new: DataFrame) -> DataFrame:
    """One row for each hash: what was known first, with the latest update."""
    rows = table.unionByName(new)
    kept = [c for c in table.columns if c not in ("content_hash", "last_updated")]
    first = F.min_by(F.struct(*kept), F.struct("created_at", "id"))
    return rows.groupBy("content_hash").agg(first.alias("f"), F.max("last_updated").alias("last_updated")).select(*[F.col(f"f.{c}").alias(c) if c in kept else F.col(c) for c in table.columns])


def chunk_rows(chunks: DataFrame, documents: DataFrame, now: Column) -> DataFrame:
    """Rows of chunks with the id of their document, found by content hash; chunks whose document is not in the table are left out."""
    ids = documents.select(F.col("id").alias("document_id"), F.col("content_hash").alias("_hash")).distinct()
    rows = chunks.join(ids, F.col("content_hash") == F.col("_hash")).withColumn("point_id", point_id(F.col("content_hash"), F.col("chunk_index")))
    return typed(rows.withColumns({"id": F.col("point_id"), "created_at": now}), CHUNKS)


def eval_rows(evals: DataFrame, threshold: float, now: Column) -> DataFrame:
    """Rows of evaluations (run_id, collection_name, total_queries, recalls, mrr, avg_query_latency_ms), with the verdict on what was measured, not on its rounding. Without queries there is no row."""
    rows = evals.filter("total_queries > 0").withColumns({
        "id": F.col("run_id"), "threshold_value": F.lit(threshold), "passed_threshold": F.coalesce("recall_at_5", F.lit(0.0)) >= threshold, "created_at": now})
    return typed(rows, EVAL_RESULTS)


class Audit:
    """The audit tables below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.folder = spark, path.rstrip("/"), Folder(spark, path)

    def append(self, table: str, rows: DataFrame) -> None:
        typed(rows, TABLES[table]).write.mode("append").parquet(f"{self.path}/{table}")

    def read(self, table: str) -> DataFrame:
        if table not in self.folder.names():
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.path}/{table}")

    def put_documents(self, new: DataFrame) -> None:
        """Merges documents into a new copy of the table, which the pointer file of the copy's name then replaces."""
        merged = merged_documents(self.documents(), new)
        version = uuid.uuid4().hex
        merged.write.parquet(f"{self.path}/documents_v/{version}")
        lifecycle.Pointer(self.spark, f"{self.path}/documents_now").put(version)

    def documents(self) -> DataFrame:
        version = lifecycle.Pointer(self.spark, f"{self.path}/documents_now").get()
        return self.spark.read.schema(DOCUMENTS).parquet(f"{self.path}/documents_v/{version}") if version else self.spark.createDataFrame([], DOCUMENTS)
