"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A ledger holds signed rows (doc_id, source, lang, tokenizer, docs, tokens) in buckets by a hash of doc_id. A batch of
changes names documents to insert, revise or delete: whatever the ledger holds for them under the same tokenizer version
is taken back by negative rows, and inserts and revisions add new rows; so inserting a known document revises it. Only
the buckets that a batch touches are read. The batch's rows are summed by key into a small delta, and totals are the sum
of the deltas of committed batches.

Every few batches the ledger is compacted: what it leaves of each document becomes a new base, the deltas one table of
totals, and older batches are not read again. So a commit reads the state of documents and a bounded number of batches,
not the history.

A batch is written under its own name and counts once its commit marker exists, which is written last; so does a base.
Committing a name again changes nothing; a batch that failed midway is overwritten when retried. One writer at a time is
assumed.

Defined results: a null text has 0 tokens and counts as a document; null sources and languages are keys of their own;
rows with a null doc_id count but cannot be revised or deleted; rows of one batch that share a doc_id all count; an
empty batch commits and changes nothing; deleting an unknown document changes nothing; extra columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm._graph import apart
from siltwork.llm._store import shared
from siltwork.llm._text import n_words_of, pieces

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pre-tokenisation pattern of the public byte-level BPE vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ("source", "lang", "tokenizer")
LEDGER = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"
MARK = "name string, seq long, covers long"
CHANGES = "op string, doc_id long, source string, lang string, tokenizer string, tokens long"


def bpe(path: str) -> Callable[[list[str]], list[int]]:
    """A counter of tokens from a file of ranks; the file is read on the driver and travels with the function."""
    with open(path, "rb") as f:
        ranks = f.read()

    def counter() -> Callable[[list[str]], list[int]]:
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}, special_tokens={})
        return lambda texts: [len(encoding.encode_ordinary(t)) if t else 0 for t in texts]

    return counter


def counted(docs: DataFrame, versions: dict[str, Callable | None], op: str = "insert") -> DataFrame:
    """Changes for every row of ``docs`` and tokenizer version; a version without a function counts words natively."""
    out, rows = None, docs.select("doc_id", "source", "lang", "text")
    for name, make in versions.items():
        if make is None:
            n = rows.select("doc_id", "source", "lang", n_words_of(F.col("text")).alias("tokens"))
        else:

            def count(batches: Iterator[pa.RecordBatch], make=make) -> Iterator[pa.RecordBatch]:
                tokens = make()
                for b in pieces(batches, "text"):
                    yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), b.column("lang"), pa.array(tokens(b.column("text").to_pylist()), pa.int64())], names=["doc_id", "source", "lang", "tokens"])

            n = rows.mapInArrow(count, "doc_id long, source string, lang string, tokens long")
        n = n.select(F.lit(op).alias("op"), "doc_id", "source", "lang", F.lit(name).alias("tokenizer"), "tokens")
        out = n if out is None else out.unionByName(n)
    return out


class Rollup:
    """Totals kept in the folder ``path``; compacted after every ``every`` batches."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, every: int = 8):
        self.spark, self.path, self.buckets, self.every = spark, path, buckets, every
        self._mark("start", 0, -1)

    def _mark(self, name: str, seq: int, covers: int) -> None:
        self.spark.createDataFrame([(name, seq, covers)], MARK).coalesce(1).write.mode("overwrite" if seq else "ignore").parquet(f"{self.path}/commits/{name}")

    def _marks(self) -> list:
        return sorted(self.spark.read.schema(MARK).parquet(f"{self.path}/commits/*").collect(), key=lambda r: r.seq)  # a row for each batch

    def committed(self) -> list[str]:
        return [r.name for r in self._marks() if r.seq and r.covers < 0]

    def _live(self) -> list[str]:
        """The last base, and the batches after it."""
        marks = self._marks()
        base = max((r for r in marks if r.covers >= 0), key=lambda r: r.covers, default=None)
        return [*([base.name] if base else []), *[r.name for r in marks if r.seq and r.covers < 0 and (base is None or r.seq > base.covers)]]

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/{b}" for b in self._live()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def net(self, buckets: list[int] | None = None) -> DataFrame:
        """What committed batches leave of every document with a doc_id: its signed rows summed by key."""
        rows = self._read("ledger", f"{LEDGER}, bucket int")
        rows = rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))
        return rows.groupBy("bucket", "doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")

    def _write(self, kind: str, name: str, rows: DataFrame) -> None:
        """Files hold whole buckets in order, so a filter on buckets skips row groups by their bounds."""
        rows.repartition("bucket").sortWithinPartitions("bucket", "doc_id").write.mode("overwrite").parquet(f"{self.path}/{kind}/{name}")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Commits the changes (see CHANGES); False if the batch was committed before. A delete without a tokenizer takes back all versions."""
        if not batch or set(batch) - set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-") or batch.startswith("base-") or batch == "start":
            raise ValueError("a batch's name has letters, digits, - and _, and is not start or base-")
        marks = self._marks()
        if any(r.name == batch for r in marks):
            return False
        bucket = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(self.buckets)), F.lit(0)).cast("int").alias("bucket")
        new = changes.filter("op <> 'delete'").select("doc_id", *KEYS, F.lit(1).cast("long").alias("docs"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
        new.write.mode("overwrite").parquet(added := f"{self.path}/added/{batch}")
        new = self.spark.read.schema(LEDGER).parquet(added)
        gone = changes.filter("op = 'delete'").select("doc_id", "tokenizer")
        touched = new.select("doc_id", "tokenizer").unionByName(gone).filter("doc_id is not null").distinct()
        hit = [r.bucket for r in touched.select(bucket).distinct().collect()]  # as many as buckets
        touched = touched.select(F.col("doc_id").alias("_id"), F.col("tokenizer").alias("_version"))
        signed = new.select("*", bucket)
        if hit and self._live():
            old = self.net(hit).join(touched, (F.col("doc_id") == F.col("_id")) & (F.col("_version").isNull() | (F.col("tokenizer") == F.col("_version"))), "left_semi")
            signed = signed.unionByName(old.select("doc_id", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"), "bucket"))
        self._write("ledger", batch, signed)
        rows = self.spark.read.schema(f"{LEDGER}, bucket int").parquet(f"{self.path}/ledger/{batch}")
        rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(f"{self.path}/deltas/{batch}")
        self._mark(batch, marks[-1].seq + 1, -1)
        if len(self._live()) > self.every:
            self.compact()
        return True

    def compact(self) -> None:
        """Makes what is committed a new base; readers take it from the moment its marker exists."""
        marks = self._marks()
        seq = marks[-1].seq + 1
        name = f"base-{seq}"
        self._write("ledger", name, self.net().filter("doc_id is not null").select("doc_id", *KEYS, "docs", "tokens", "bucket"))
        self.totals().write.mode("overwrite").parquet(f"{self.path}/deltas/{name}")
        self._mark(name, seq, marks[-1].seq)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) of all committed batches."""
        return self._read("deltas", DELTA).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")


def copies(docs: DataFrame) -> DataFrame:
    """doc_id of every document whose text a document of smaller doc_id has."""
    h = [F.xxhash64("text").alias("h0"), F.xxhash64(F.lit(7), "text").alias("h1")]
    rows = docs.filter("text is not null and doc_id is not null").select("doc_id", *h)
    least = rows.groupBy("h0", "h1").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select(apart(F.col("h0")).alias("_h0"), apart(F.col("h1")).alias("_h1"), "least")
    return rows.join(least, (F.col("h0") == F.col("_h0")) & (F.col("h1") == F.col("_h1"))).filter("doc_id > least").select("doc_id").distinct()


def op4_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: all documents inserted under two tokenizer versions and delivered twice; the words of German texts counted again without punctuation; then the copies of texts deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = Rollup(spark, f"{shared(spark)}/rollup-{uuid.uuid4().hex}")
    versions = {"byte_bpe_50k": bpe(f"{TOKENIZERS}/byte_bpe_50k.tiktoken"), "words_1": None}
    store.commit("load", counted(docs, versions))
    store.commit("load", counted(docs, versions))
    store.commit("german", counted(docs.filter("lang = 'de'").withColumn("text", F.translate("text", ".,;:!?", "")), {"words_1": None}, "revise"))
    none = F.lit(None).cast("string")
    store.commit("copies", copies(docs).select(F.lit("delete").alias("op"), "doc_id", none.alias("source"), none.alias("lang"), none.alias("tokenizer"), F.lit(0).cast("long").alias("tokens")))
    return store.totals()


QUERIES = {"op4_token_rollups": op4_token_rollups}
ORACLES: dict[str, str] = {}
