"""Weighted fusion of dense and sparse retrieval, and re-scoring of the result."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.functions.text import tokens


def shares(top_k: int) -> tuple[int, int]:
    """Dense and sparse candidates of a result of ``top_k``: half each, the odd one dense."""
    return math.ceil(top_k / 2), top_k // 2


def fused(dense: DataFrame, sparse: DataFrame, normalised: DataFrame, bm25_weight: float = 0.3, top_k: int = 10, digits: int = 6) -> DataFrame:
    """(query_id, id, vector_score, bm25_score, combined_score, rank).

    ``dense`` and ``sparse`` are candidates (query_id, id, score); ``normalised`` (query_id, id, norm) holds BM25 over
    the whole corpus, so candidates that only the dense side found get their score too. What is missing counts 0.
    """
    a = dense.select("query_id", "id", F.col("score").alias("vector_score"))
    both = a.join(sparse.select("query_id", "id"), ["query_id", "id"], "full_outer").join(normalised.select("query_id", "id", "norm"), ["query_id", "id"], "left")
    both = both.select("query_id", "id", F.coalesce("vector_score", F.lit(0.0)).alias("vector_score"), F.coalesce("norm", F.lit(0.0)).alias("bm25_score"))
    both = both.withColumn("combined_score", (1 - bm25_weight) * F.col("vector_score") + bm25_weight * F.col("bm25_score"))
    order = Window.partitionBy("query_id").orderBy(F.round("combined_score", digits).desc(), F.col("id").asc())
    return both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_k)


def lexical_score(query: Column, text: Column) -> Column:
    """Share of the query's distinct tokens that the text has: the stand-in for a cross-encoder, which is any column."""
    q = F.array_distinct(tokens(query))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(q, tokens(text))), F.size(q)), F.lit(0.0))


def model_score(load: Callable[[], Callable[[list[tuple[str, str]]], list[float]]]) -> Callable[[Column, Column], Column]:
    """A column function that scores (query, text) with a model, which is loaded once a task."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        predict = load()
        for queries, texts in batches:
            yield pd.Series(predict(list(zip(queries, texts, strict=True))), dtype="float64")

    return score


def reranked(results: DataFrame, score: Column, top_k: int = 10, digits: int = 6) -> DataFrame:
    """Results (query_id, id, rank, combined_score, query, payload_text, text) re-scored; ``original_rank`` keeps their place.

    The text that is scored is ``candidate_text``: the payload's, or else the result's own.
    """
    rows = results.withColumn("candidate_text", F.coalesce(F.nullif("payload_text", F.lit("")), "text", F.lit(""))).withColumnRenamed("rank", "original_rank")
    rows = rows.withColumn("reranker_score", score)
    order = Window.partitionBy("query_id").orderBy(F.round("reranker_score", digits).desc(), F.col("original_rank").asc())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_k)


def improvement(ranked: DataFrame, results: DataFrame) -> DataFrame:
    """(query_id, improvement): the best re-score less the score of the result that was first before."""
    best = ranked.groupBy("query_id").agg(F.max("reranker_score").alias("best"))
    first = results.filter("rank = 1").select("query_id", F.coalesce("combined_score", F.lit(0.0)).alias("first_score"))
    return best.join(first, "query_id").select("query_id", (F.col("best") - F.col("first_score")).alias("improvement"))


def context(results: DataFrame, k: int = 5, text: str = "candidate_text") -> DataFrame:
    """(query_id, context): the texts of the best ``k`` results, in order."""
    parts = F.array_sort(F.collect_list(F.struct("rank", F.col(text).alias("t"))))
    return results.filter(F.col("rank") <= k).groupBy("query_id").agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n---\n\n").alias("context"))
