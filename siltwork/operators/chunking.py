"""Overlapping token windows in closed form: no loop, no UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.functions import text as T


def step_of(size: int, overlap: int) -> int:
    if size < 1 or overlap < 0:
        raise ValueError("size is at least 1 and overlap at least 0")
    return size if overlap >= size else size - overlap


def chunked(docs: DataFrame, content: str = "content", size: int = 512, overlap: int = 50, tokens: Column | None = None) -> DataFrame:
    """A row for each window: the documents' columns, ``chunk_index`` from 0, ``total_chunks``, ``chunk_text``, ``token_count``.

    Windows start at every ``size - overlap`` tokens (every ``size`` if that is not positive). A text without tokens has none.
    """
    step = step_of(size, overlap)
    rows = docs.filter(T.has_text(F.col(content))).withColumn("_tokens", T.words(F.col(content)) if tokens is None else tokens)
    rows = rows.withColumn("total_chunks", F.ceil(F.size("_tokens") / F.lit(float(step))).cast("int")).filter("total_chunks > 0")
    rows = rows.withColumn("chunk_index", F.explode(F.sequence(F.lit(0), F.col("total_chunks") - 1)))
    window = F.slice("_tokens", F.col("chunk_index") * step + 1, F.lit(size))
    return rows.withColumn("chunk_text", F.array_join(window, " ")).withColumn("token_count", F.size(window)).drop("_tokens")


def chunk_stats(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: chunks, and chunks per document with documents of none counted."""
    a, b = docs.agg(F.count(F.lit(1)).alias("n_documents")), chunks.agg(F.count(F.lit(1)).alias("n_chunks"))
    return a.join(F.broadcast(b)).withColumn("chunks_per_document", F.coalesce(F.try_divide("n_chunks", "n_documents"), F.lit(0.0)))
