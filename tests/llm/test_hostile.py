"""Every operator and stage on nulls, repeated rows, long texts, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltwork.llm import registry

CLASHES = ("row", "at", "size", "sig", "key", "rep", "n", "u", "v", "h0", "hub", "link", "copies", "taken", "component_id", "kept", "score", "predicted", "stratum", "tokens", "words", "label", "_at", "_id", "_gone", "piece")


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    made = spark.createDataFrame([*rows, *rows[:20], (None, "no id " * 20, "en", "a", 1), (None, "no id " * 20, "en", "a", 1), (777, "x" * 300_000, "en", "b", 1), (778, "\n".join(["same line of text"] * 4000), None, "b", 1), (779, "\x00 é \U0001f600 " * 50, "en", "b", None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    path = tmp_path_factory.mktemp("hostile")
    wide = made.withColumns({c: F.lit(i) if i % 2 else F.lit(None).cast("string") for i, c in enumerate(CLASHES)})
    for name, docs in (("full", wide), ("empty", wide.limit(0))):
        docs.write.parquet(f"{path}/{name}/documents.parquet")
        few = lambda df, name=name: df if name == "full" else df.limit(0)
        few(spark.createDataFrame([(i, i % 2, int(i % 7 == 0)) for i in range(0, 120, 2)] + [(None, 1, 1), (4, None, None), (9999, 1, 0)], "doc_id long, quality int, toxic int")).write.parquet(f"{path}/{name}/labels.parquet")
        few(spark.createDataFrame([(1, rows[6][1] or "a b c d e f g"), (2, None), (None, "x y z w v u"), (3, ""), (1, "q w e r t y u")], "item_id long, text string").withColumn("doc_id", F.lit(3))).write.parquet(f"{path}/{name}/benchmark.parquet")
        few(spark.createDataFrame([(1, "http://a.b.example.com/x", "h"), (1, "http://a.b.example.com/x", "h"), (None, "https://example.org", None), (3, None, None), (4, "", ""), (5, "http://" + "a." * 400 + "com/" + "p" * 5000, None)],
                                  "page_id long, url string, html string").withColumns({"key": F.lit(1), "host": F.lit("z"), "day_": F.lit(2)})).write.parquet(f"{path}/{name}/pages.parquet")
    return path


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, folder, name):
    full, none = (registry.queries()[name](spark, f"{folder}/{k}") for k in ("full", "empty"))
    table = "pages" if name.startswith("op8") else "documents"
    n = spark.read.parquet(f"{folder}/full/{table}.parquet").count()
    found = full.collect()
    if not name.startswith(("op4", "op7", "op13")):  # rows of their own, not one a document
        assert len(found) == n
    assert none.collect() == [] and none.dtypes == full.dtypes


@pytest.mark.parametrize("step", range(5))
def test_stage(spark, folder, step):
    function = corpus_pipeline.STAGES[step][1]
    for kind in ("full", "empty"):
        docs = spark.read.parquet(f"{folder}/{kind}/documents.parquet")
        out = function(spark, docs, f"{folder}/{kind}")
        rows = out.collect()
        assert out.columns == (docs.columns if step < 4 else [*docs.columns, "shard", "slot"])
        assert (len(rows) > 0) == (kind == "full") and (step != 4 or len(rows) == docs.count())


def test_stages_keep_rows_without_id(spark, folder):
    docs = spark.read.parquet(f"{folder}/full/documents.parquet")
    for step in (0, 1, 2):
        out = corpus_pipeline.STAGES[step][1](spark, docs, f"{folder}/full")
        # The two rows without an id are copies of each other: of a group one row stays, so near_dedup keeps one.
        assert out.filter("doc_id is null").count() == (1 if step == 1 else 2)
