"""Vectors for texts. Models plug in as functions of a list of texts; the default hashes features and needs no model."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hashed_features(dimension: int = 384) -> Callable[[list[str]], np.ndarray]:
    """A stand-in for a model: tokens hashed with sign to ``dimension`` places, unit length."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension))
        for i, t in enumerate(texts):
            words = (t or "").lower().split()
            if words:
                flat = np.empty(len(words), object)
                flat[:] = words
                h = pd.util.hash_array(flat, categorize=False)
                np.add.at(out[i], (h % np.uint64(dimension)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0))
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return embed


def embedded(chunks: DataFrame, model: str = "hashed-features-384", load: Callable[[], Callable[[list[str]], np.ndarray]] = hashed_features, text: str = "chunk_text", batch_size: int = 50, attempts: int = 3, wait: float = 2.0, longest: float = 10.0) -> DataFrame:
    """Chunks with embedding, embedding_model and embedding_dimension. The model is loaded once a task.

    A batch that fails is tried again after ``wait`` seconds, each time twice as long up to ``longest``; one that fails ``attempts`` times fails the run.
    """

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = load()
        for texts in batches:
            out: list[np.ndarray] = []
            for i in range(0, len(texts), batch_size):
                for attempt in range(attempts):
                    try:
                        out += list(np.asarray(run(texts.iloc[i : i + batch_size].tolist()), np.float32))
                        break
                    except Exception:
                        if attempt == attempts - 1:
                            raise
                        time.sleep(min(longest, wait * 2**attempt))
            yield pd.Series(out, dtype=object)

    rows = chunks.withColumn("embedding", embed(F.col(text)))
    return rows.withColumns({"embedding_model": F.lit(model), "embedding_dimension": F.size("embedding")})
