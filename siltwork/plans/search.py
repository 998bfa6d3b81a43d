"""Search for batches of queries: cached answers first, then retrieval, fusion and re-scoring for the rest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.operators import answer_cache, bm25, caches, dense, hybrid
from siltwork.store import stage


@dataclass
class Search:
    top_k: int = 10
    use_hybrid: bool = True
    use_rerank: bool = False
    bm25_weight: float = 0.3
    least: float = 0.0
    collection: str = "kb"

    @property
    def settings(self) -> str:
        return answer_cache.settings_hash(self.use_hybrid, False, self.use_rerank, self.top_k)


def retrieve(queries: DataFrame, points: DataFrame, search: Search, index: bm25.Bm25 | None = None, score: Callable[[Column, Column], Column] = hybrid.lexical_score, whole: bool = False) -> DataFrame:
    """(query_id, id, rank, combined_score, candidate_text, sparse, ...) for queries (query_id, query, embedding) over points (id, embedding, text).

    With re-scoring, twice the results are fetched first. ``sparse`` says whether words decided too: if a saved index is
    gone, the vectors decide alone, or with ``whole`` that is an error. Every other failure of the sparse side is one.
    """
    k = 2 * search.top_k if search.use_rerank else search.top_k
    vectors, fused = points.select("id", "embedding"), search.use_hybrid
    if fused and index is not None and (lost := bm25.lost(index)):
        if whole:
            raise FileNotFoundError(f"the sparse index lacks {lost[0]}")
        fused = False
    if fused:
        k_dense, k_sparse = hybrid.shares(k)
        near = stage(dense.top_k(vectors, queries, k_dense, least=search.least), "near")
        norm = bm25.nearest(index or bm25.index(points), queries, k_sparse, near)
        found = hybrid.fused(near, norm.filter(F.col("rank") <= k_sparse), norm, search.bm25_weight, k)
    else:
        found = dense.top_k(vectors, queries, k, least=search.least).withColumn("combined_score", F.col("score"))
    found = stage(found.withColumn("sparse", F.lit(fused)), "found")
    texts = points.select("id", "text").join(found.select("id").distinct(), "id", "left_semi")  # few, so that the others need no shuffle
    rows = found.join(texts, "id").join(queries.select("query_id", "query"), "query_id").withColumn("payload_text", F.col("text"))
    if search.use_rerank:
        return hybrid.reranked(rows, score(F.col("query"), F.coalesce("payload_text", "text")), search.top_k)
    return rows.withColumn("candidate_text", F.coalesce("payload_text", F.lit("")))


def answered(queries: DataFrame, entries: DataFrame, search: Search, now: Column, ttl: int = answer_cache.TTL_SECONDS) -> tuple[DataFrame, DataFrame]:
    """(hits, misses): queries with what a live entry answers, and those to search for."""
    probes = queries.withColumns({"collection": F.lit(search.collection), "settings": F.lit(search.settings)})
    hits = answer_cache.answered(probes, entries, now, ttl=ttl)
    return hits, answer_cache.misses(queries, hits)


def search_and_answer(queries: DataFrame, points: DataFrame, cache: caches.AnswerCache, search: Search, now: Column, answer: Callable[[Column, Column], Column], index: bm25.Bm25 | None = None) -> DataFrame:
    """(query_id, answer, from_cache): cached answers, and for the other queries new ones, which are cached.

    ``answer`` makes an answer of a query and its context, the texts of the best five results. A query without results
    has the context ''. An entry is named by the query's id, beside its collection and settings. If the sparse side fails
    or its index is gone, that is an error, and nothing is cached.
    """
    hits, left = answered(queries, cache.entries(now), search, now, cache.ttl)
    known = hits.select("query_id", "answer", F.lit(True).alias("from_cache"))
    known, left = stage(known, "known"), stage(left, "left")
    ranked = stage(retrieve(left, points, search, index, whole=True), "ranked")
    texts = hybrid.context(ranked, 5)
    names = ranked.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"].cast("string")).alias("results"))
    new = left.join(texts, "query_id", "left").join(names, "query_id", "left").withColumn("answer", answer(F.col("query"), F.coalesce("context", F.lit(""))))
    new = stage(new.select("query_id", "embedding", "answer", "results"), "answers")
    cache.put(new.select(F.col("query_id").alias("entry_id"), F.lit(search.collection).alias("collection"), F.lit(search.settings).alias("settings"), "embedding", "answer", "results"), now)
    return known.unionByName(new.select("query_id", "answer", F.lit(False).alias("from_cache")))
