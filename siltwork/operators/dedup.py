"""Exact dedup against confirmed content hashes, and the store of these hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.functions.text import content_hash

TTL_DAYS = 30


def hashed(docs: DataFrame, content: str = "content") -> DataFrame:
    """Documents with content and their hash; null and empty content is dropped."""
    return docs.filter(F.length(content) > 0).withColumn("content_hash", content_hash(F.col(content)))


def live(store: DataFrame, now: Column, days: int = TTL_DAYS) -> DataFrame:
    """Confirmed hashes (content_hash, confirmed_at) that have not outlived their time."""
    return store.filter(F.col("confirmed_at") + F.make_dt_interval(F.lit(days)) > now)


def new_documents(docs: DataFrame, store: DataFrame, within_batch: bool = False) -> DataFrame:
    """Hashed documents whose hash is not confirmed. Copies within the batch stay unless ``within_batch``, which keeps the least ``doc_id``."""
    out = docs.join(store.select("content_hash"), "content_hash", "left_anti")
    if not within_batch:
        return out
    first = out.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"))
    return out.join(first, ["content_hash", "doc_id"], "left_semi")


def stats(docs: DataFrame, hashed_docs: DataFrame, store: DataFrame) -> DataFrame:
    """One row: documents in, new and skipped, and the hit rate over all documents, empty ones included."""
    known = store.select("content_hash").distinct().withColumn("known", F.lit(1))
    seen = hashed_docs.join(known, "content_hash", "left").agg(
        F.count_if(F.col("known").isNull()).alias("n_new"), F.count_if(F.col("known").isNotNull()).alias("n_skipped"))
    total = docs.agg(F.count(F.lit(1)).alias("n_documents"))
    return total.join(F.broadcast(seen)).select("n_documents", "n_new", "n_skipped", F.coalesce(F.try_divide("n_skipped", "n_documents"), F.lit(0.0)).alias("hit_rate"))


def confirm(store: DataFrame, landed: DataFrame, now: Column) -> DataFrame:
    """Rows to append: hashes that are not in the store yet; the first confirmation stands."""
    new = landed.filter(F.length("content_hash") > 0).select("content_hash").distinct()
    return new.join(store.select("content_hash"), "content_hash", "left_anti").withColumn("confirmed_at", now)


def forget(store: DataFrame, hashes: DataFrame) -> DataFrame:
    """The store without these hashes."""
    return store.join(hashes.select("content_hash"), "content_hash", "left_anti")


def landed_hashes(chunks: DataFrame, written: DataFrame) -> DataFrame:
    """Hashes of documents all of whose chunks (content_hash, chunk_index) were written."""
    done = written.select("content_hash", "chunk_index", F.lit(True).alias("done"))
    return chunks.join(done, ["content_hash", "chunk_index"], "left").groupBy("content_hash").agg(F.bool_and(F.coalesce("done", F.lit(False))).alias("all")).filter("all").select("content_hash")
