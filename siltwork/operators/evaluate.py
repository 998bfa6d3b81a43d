"""Retrieval quality of ranked results, and the gate that it decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTOFFS = (1, 5, 10)


def recall_at(retrieved: Column, expected: Column, k: int) -> Column:
    """Share of the distinct expected names among the first ``k`` retrieved; 0 if none is expected."""
    found = F.size(F.array_intersect(F.slice(retrieved, 1, k), expected))
    return F.coalesce(F.try_divide(found, F.size(F.array_distinct(expected))), F.lit(0.0))


def reciprocal_rank(retrieved: Column, expected: Column) -> Column:
    """1 over the place of the first expected name; 0 if none is retrieved."""
    places = F.filter(F.transform(expected, lambda x: F.array_position(retrieved, x)), lambda p: p > 0)
    return F.coalesce(F.try_divide(F.lit(1.0), F.array_min(places)), F.lit(0.0))


def judged(ranked: DataFrame, truth: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """(query_id, recall_1, recall_5, recall_10, rr) for every query; ranked: query_id, name, rank; truth: query_id, name.

    ``queries`` (query_id) are all that were asked; without it, those of ``truth``. A query without results, or of which
    nothing is expected, scores 0. Counts only: no list of results is gathered.
    """
    expected = truth.select("query_id", "name").distinct()
    n = expected.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    hits = ranked.join(expected, ["query_id", "name"]).groupBy("query_id", "name").agg(F.min("rank").alias("rank")).groupBy("query_id").agg(
        *[F.count_if(F.col("rank") <= k).alias(f"h{k}") for k in CUTOFFS], F.min("rank").alias("first"))
    rows = (n if queries is None else queries.select("query_id").distinct().join(n, "query_id", "left")).join(hits, "query_id", "left")
    return rows.select("query_id", *[F.coalesce(F.col(f"h{k}") / F.col("n"), F.lit(0.0)).alias(f"recall_{k}") for k in CUTOFFS], F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("rr"))


def summary(per_query: DataFrame, total: Column | None = None) -> DataFrame:
    """One row: means rounded to 4 digits, 0 without queries."""
    mean = lambda c: F.round(F.coalesce(F.avg(c), F.lit(0.0)), 4)
    return per_query.agg((F.count(F.lit(1)) if total is None else total).alias("total_queries"), *[mean(f"recall_{k}").alias(f"recall_at_{k}") for k in CUTOFFS], mean("rr").alias("mrr"))


def gate(recall_5: Column, threshold: float = 0.75) -> Column:
    return F.when(F.coalesce(recall_5, F.lit(0.0)) >= threshold, "promote").otherwise("rollback")
