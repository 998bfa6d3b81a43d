"""Schemas of documents in flight, points and audit tables."""

from __future__ import annotations

DOCUMENT = "content string, source string, source_uri string, filename string, metadata map<string,string>"
CHUNK = f"{DOCUMENT}, content_hash string, chunk_index int, total_chunks int, token_count int"
BENCHMARK = "query string, expected_docs array<string>"
COST_SAMPLE = "ts double, cost double"
METRIC = "run_id string, step string, name string, kind string, value double, ts timestamp_ntz"
TRACKING = "run_id string, kind string, key string, text string, value double, ts timestamp_ntz"

DOCUMENTS = "id string, source_type string, source_uri string, filename string, content_hash string, file_size_bytes int, created_at timestamp_ntz, last_updated timestamp_ntz"
CHUNKS = "id string, document_id string, chunk_index int, total_chunks int, chunk_text string, token_count int, embedding_model string, point_id string, created_at timestamp_ntz"
EVAL_RESULTS = (
    "id string, run_id string, collection_name string, total_queries int, recall_at_1 decimal(5,4), recall_at_5 decimal(5,4), recall_at_10 decimal(5,4), "
    "mrr decimal(5,4), avg_query_latency_ms decimal(10,2), threshold_value decimal(5,4), passed_threshold boolean, created_at timestamp_ntz"
)
INGESTION_LOG = (
    "id string, run_id string, dag_id string, execution_date timestamp_ntz, documents_extracted int, documents_deduplicated int, chunks_created int, "
    "chunks_embedded int, vectors_upserted int, status string, error_message string, started_at timestamp_ntz, completed_at timestamp_ntz"
)


def fields(schema: str) -> list[tuple[str, str]]:
    """Names and types of a flat schema."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(f"{schema},"):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            name, kind = schema[start:i].strip().split(" ", 1)
            out.append((name, kind))
            start = i + 1
    return out
