"""Words, hashes and batches shared by the Arrow operators of this subpackage.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which is what ``bytes.split()``
yields for UTF-8 text; a null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as a Java or RE2 class.
SPACES = r"[\x20\x09-\x0D]+"
#: The same characters, for trim.
SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    flat = np.empty(len(words), dtype=object)
    flat[:] = words
    return hash_array(flat, categorize=False) if words else np.empty(0, np.uint64)


def tokenised(texts: Iterable[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and each text's number of words."""
    words = [[] if t is None else (t.encode().lower() if lower else t.encode()).split() for t in texts]
    return hashes(list(chain.from_iterable(words))), np.fromiter(map(len, words), np.int64, len(words))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each position; len(h) - n + 1 values."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = mix(h[: len(h) - n + 1])
    for j in range(1, n):
        out = mix(out + h[j : len(h) - n + 1 + j])
    return out


#: Most bytes of an Arrow batch between Spark and Python, about, where an operator writes its result itself.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, Arrow batches are bounded by bytes, so that a task holds a few MB of text at a time, however long the texts are.

    The session's own bound holds again afterwards; plans that run later go by that one.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def pieces(batches: Iterable[pa.RecordBatch], text: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``most`` bytes of text each, one row at least, so that memory stays bounded."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if not len(column):
            continue
        ends = np.cumsum(np.nan_to_num(pa.compute.binary_length(column).to_numpy(zero_copy_only=False)) + 64)
        start = 0
        while start < len(column):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words_of(text: Column) -> Column:
    """The words of a text as an array of strings, natively; empty for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def n_words_of(text: Column) -> Column:
    """The number of words, natively."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")
