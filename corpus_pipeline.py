"""A corpus in five stages: each function takes (spark, docs, sf_dir) and returns a DataFrame.

Each stage's result is written as Parquet and read again as the next one's documents. All but the last return the
columns of documents; the last adds each row's shard and slot. A result carries the number of its stage's call in its
first column's metadata, which Parquet keeps; so the next stage knows whose written result it reads, and removes the
tables that this call had staged, but no other call's. The tables that the last stage's result reads stay until the
process ends, so results of several runs can be read side by side.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm.decontam import decontamination_stage
from siltwork.llm.mixing import mixing_stage
from siltwork.llm.near_dedup import near_dedup_stage
from siltwork.llm.sharding import sharding_stage
from siltwork.llm.toxicity import toxicity_stage
from siltwork.store import stage, tracked

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: By the number of a stage's call: removes the tables that it staged.
_held: dict[str, Callable[[DataFrame], None]] = {}
_MARK = "staged_by"


def _tidy(function: Stage) -> Stage:
    @wraps(function)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if (release := _held.get(docs.schema.fields[0].metadata.get(_MARK), None)) is not None:
            release(docs)
        out, release = tracked(function, spark, docs, sf_dir)
        _held[call := uuid4().hex] = release
        first = out.schema.fields[0]
        return out.withMetadata(first.name, first.metadata | {_MARK: call})

    return tidied


STAGES = [
    ("toxicity", _tidy(toxicity_stage)),
    ("near_dedup", _tidy(near_dedup_stage)),
    ("decontamination", _tidy(decontamination_stage)),
    ("mixing", _tidy(mixing_stage)),
    ("sharding", _tidy(sharding_stage)),
]

#: SQL can express neither the trained score nor latent retrieval; tests hold every stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
