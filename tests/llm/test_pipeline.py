"""The corpus pipeline: each stage's decisions against brute force on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from siltwork.llm import decontam, near_dedup, toxicity
from siltwork.llm._store import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        found = stage(function(spark, docs, SF), name)
        out.append((name, docs, found))
        docs = found
    return out


def test_columns_and_order(steps):
    assert [n for n, *_ in steps] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    assert all(found.columns == docs.columns and found.dtypes == docs.dtypes for _, docs, found in steps[:-1])
    assert steps[-1][2].columns == [*steps[-1][1].columns, "shard", "slot"]


def test_toxic_documents_go(spark, steps):
    _, docs, found = steps[0]
    verdict = toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in found.collect()} == {r.doc_id for r in verdict.filter("predicted = 0").collect()}


def test_one_of_each_group_stays(steps):
    _, docs, found = steps[1]
    verdict = near_dedup.near_duplicates(docs)
    assert {r.doc_id for r in found.collect()} == {r.component_id for r in verdict.collect()}


def test_leaks_go(spark, steps):
    _, docs, found = steps[2]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in found.collect()}
    assert not {r.doc_id for r in docs.collect() if any(x in r.text for x in items)} & left
    hit = {r.doc_id for r in decontam.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert left == {r.doc_id for r in docs.collect()} - hit


def test_copies_follow_the_mix(steps):
    _, docs, found = steps[3]
    count, texts = Counter(r.doc_id for r in found.collect()), {r.doc_id: r.text for r in docs.collect()}
    assert max(count.values()) <= 2 and all(r.text == texts[r.doc_id] for r in found.collect())


def test_shards_are_even(steps):
    _, docs, found = steps[4]
    sizes = Counter(r.shard for r in found.collect())
    n = docs.count()
    assert sum(sizes.values()) == n and max(sizes.values()) - min(sizes.get(s, 0) for s in range(40)) <= 1
    assert Counter(r.doc_id for r in found.collect()) == Counter(r.doc_id for r in docs.collect())


def test_run_is_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == steps[-1][2].columns
    rows = lambda df: Counter((r.doc_id, r.text, r.shard) for r in df.collect())
    assert rows(got) == rows(steps[-1][2]) and corpus_pipeline.ORACLE_SQL is None


def test_stages_clear_up_and_spare_what_is_read(spark):
    from siltwork import store

    stages, docs = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{SF}/documents.parquet")
    lazy = stages["near_dedup"](spark, docs, SF)
    n = lazy.count()
    assert stages["mixing"](spark, lazy, SF).count() > n and lazy.count() == n  # what it reads is still there
    written = stage(lazy, "written")
    made = {p for _, p in store._made}
    stages["sharding"](spark, written, SF)
    assert len(made & {p for _, p in store._made}) < len(made) and written.count() == n


def test_runs_in_one_process_stand_side_by_side(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    one, lazy = corpus_pipeline.run(spark, SF), stages["near_dedup"](spark, docs, SF)
    other = corpus_pipeline.run(spark, SF)
    n = other.count()
    assert one.count() == n > 0 and lazy.count() > 0
    written = stage(lazy, "written")
    stages["decontamination"](spark, stage(stages["near_dedup"](spark, docs, SF), "own"), SF)  # another call's tables go, not these
    assert one.count() == n == other.count() and lazy.count() == written.count()
