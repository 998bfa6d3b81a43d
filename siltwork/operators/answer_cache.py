"""A semantic cache of answers: entries compete within a collection and a combination of settings."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.operators import dense

THRESHOLD, TTL_SECONDS = 0.95, 300
#: What names an entry.
KEY = ("collection", "settings", "entry_id")


def settings_hash(hybrid: bool, rewriting: bool, reranking: bool, top_k: int) -> str:
    """16 hex digits that name a combination of settings."""
    blob = json.dumps({"top_k": int(top_k), "use_hybrid_search": bool(hybrid), "use_query_rewriting": bool(rewriting), "use_reranking": bool(reranking)})
    return hashlib.sha256(blob.encode()).hexdigest()[:16]


def settings_hash_column(hybrid: Column, rewriting: Column, reranking: Column, top_k: Column) -> Column:
    blob = F.format_string('{"top_k": %d, "use_hybrid_search": %s, "use_query_rewriting": %s, "use_reranking": %s}', top_k, hybrid.cast("string"), rewriting.cast("string"), reranking.cast("string"))
    return F.left(F.sha2(blob, 256), F.lit(16))


def live(entries: DataFrame, now: Column, ttl: int = TTL_SECONDS) -> DataFrame:
    """Entries that have not outlived their time (seconds); one that was put again replaces the earlier one of its collection, settings and entry_id."""
    kept = [c for c in entries.columns if c not in KEY]
    fresh = entries.filter(F.col("cached_at") + F.make_dt_interval(secs=F.lit(ttl)) > now)
    last = fresh.groupBy(*KEY).agg(F.max_by(F.struct(*kept), F.struct("cached_at", F.xxhash64(*kept))).alias("_last"))
    return last.select(*KEY, *[F.col(f"_last.{c}").alias(c) for c in kept])


def _nearest(probes: DataFrame, entries: DataFrame, threshold: float, digits: int) -> DataFrame:
    part = F.xxhash64("collection", "settings").alias("part")
    asked = probes.filter("collection is not null and settings is not null").select("query_id", "embedding", part)
    best = dense.top_k(entries.select(F.col("entry_id").alias("id"), "embedding", part), asked, 1, digits=digits).withColumn("similarity", F.round("score", digits))
    return best.filter(F.col("similarity") >= threshold).select("query_id", F.col("id").alias("entry_id"), "similarity")


def lookup(probes: DataFrame, entries: DataFrame, now: Column, threshold: float = THRESHOLD, ttl: int = TTL_SECONDS, digits: int = 6) -> DataFrame:
    """(query_id, entry_id, similarity) of each probe's best live entry of its collection and settings, if it is similar enough.

    Ties go to the smaller entry_id. Entries: entry_id, collection, settings, embedding, cached_at; they live ``ttl``
    seconds. Probes are compared in blocks with the entries of all tasks, so a partition of the cache may be hot.
    """
    return _nearest(probes, live(entries, now, ttl), threshold, digits)


def answered(probes: DataFrame, entries: DataFrame, now: Column, threshold: float = THRESHOLD, ttl: int = TTL_SECONDS, digits: int = 6) -> DataFrame:
    """(query_id, entry_id, similarity, and answer and results if entries have them): what ``lookup`` finds with what that very entry holds.

    An entry is named by its collection, its settings and its entry_id: the one that a probe met is that of the probe's
    own collection and settings, and live.
    """
    held = live(entries, now, ttl)
    hits = _nearest(probes, held, threshold, digits).join(probes.select("query_id", "collection", "settings"), "query_id")
    more = [c for c in ("answer", "results") if c in held.columns]
    return hits.join(held.select(*KEY, *more), list(KEY)).select("query_id", "entry_id", "similarity", *more)


def misses(probes: DataFrame, hits: DataFrame) -> DataFrame:
    """Probes that need a search."""
    return probes.join(hits.select("query_id"), "query_id", "left_anti")


def invalidated(entries: DataFrame, collection: str) -> DataFrame:
    return entries.filter(F.col("collection") != collection)
