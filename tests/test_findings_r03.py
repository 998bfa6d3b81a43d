"""Results that only larger tables, or tables of several files, show."""

import datetime
import random
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from siltwork import store
from siltwork.operators import bm25, fitted, segments
from siltwork.plans import corpus, index, refresh, stores, tables


def test_budget_alert_rounds_like_its_sql(spark, tmp_path):
    """22.5 of 5000 makes 0.44999999999999996, ten times which is 4.5."""
    rows = [(1, 22.5, 0), (2, 25.65, 7), (3, 92.5, 0), (4, 22.0, 0), (5, -92.5, 0)]
    spark.createDataFrame(rows, "c_custkey long, c_acctbal double, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    got = {r.c_custkey: r.utilization for r in index.budget_alert(spark, str(tmp_path)).collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 1.9, 4: 0.4, 5: -1.9}


def documents(spark, path, rows, files=3):
    spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(files).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_a_table_of_several_files_is_streamed(spark, tmp_path):
    d = documents(spark, tmp_path, [(1, "a"), (2, "b"), (3, "a"), (4, ""), (5, None)])
    assert index.streaming_dedup(spark, d).count() == 2


def test_phases_of_more_documents_than_half_a_day_has_seconds(spark, tmp_path):
    """Landings at noon come after documents of the afternoon, and copies stand more than six hours apart."""
    d = documents(spark, tmp_path, [(1, "a"), (50_000, "a"), (60_000, "b"), (90_000, "c"), (100_001, "d")])
    start = datetime.datetime(2024, 1, 1)
    got = sorted((r.content_hash, r.event, (r.at - start).total_seconds()) for r in stores.streaming_phases(spark, d).collect())
    hashes = {r.t: r.h for r in spark.createDataFrame([(t,) for t in "abcd"], "t string").select("t", F.sha2("t", 256).alias("h")).collect()}
    day, later = 86_400, 45 * 86_400
    want = [("a", "new", 1), ("a", "new", day + 1), ("a", "new", later + 1), ("d", "new", 100_001), ("d", "new", day + 100_001), ("d", "new", later + 100_001)]
    want += [(t, e, s) for t, at in (("b", 60_000), ("c", 90_000)) for e, s in (("new", at), ("confirmed", day // 2), ("new", later + at))]
    assert got == sorted((hashes[t], e, s) for t, e, s in want)


def test_points_hold_no_whole_text(spark, tmp_path):
    """A text of many chunks would stand beside each of them."""
    run = refresh.Run(spark, "r", str(tmp_path), F.lit("2024-02-15").cast("timestamp_ntz"), refresh.Settings(chunk_size=5, chunk_overlap=0))
    new = spark.createDataFrame([("w " * 50, "s", "s://1", "1", "h")], "content string, source string, source_uri string, filename string, content_hash string")
    chunks = run.chunk(new)
    assert chunks.count() == 10 and "content" not in chunks.columns


def test_tables_of_a_run_pass_with_it(spark):
    kept = store.stage(spark.range(3), "kept")
    with store.passing():
        gone = store.stage(spark.range(3), "gone")
        files = gone.inputFiles()
    assert kept.count() == 3 and not any(Path(f.removeprefix("file:").replace("///", "/")).exists() for f in files)


def test_documents_scored_where_they_are_read(spark, monkeypatch):
    """Few rows a slice and queries a block; terms that all documents have weigh below zero; ties go by id."""
    monkeypatch.setattr(bm25, "BLOCK", 3)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    docs = spark.createDataFrame([(i, "all " + " ".join(rng.choices(words, k=rng.choice([0, 3, 30])))) for i in range(90)] + [(90, None), (91, "all"), (92, "all")], "id long, text string").repartition(3)
    queries = spark.createDataFrame([(q, " ".join(rng.choices([*words, "all", "unknown"], k=6))) for q in range(8)] + [(8, "unknown"), (9, None), (10, "all")], "query_id long, query string")
    ix = bm25.index(docs)
    joined = bm25.Bm25(ix.postings, ix.terms, ix.stats)
    rows = lambda df: sorted((r.query_id, r.id, round(r.score, 9)) for r in df.collect())
    assert rows(bm25.scores(ix, queries)) == rows(bm25.scores(joined, queries))
    near = spark.createDataFrame([(0, i) for i in range(40)] + [(10, 91), (10, 90)], "query_id long, id long")
    full = lambda i: sorted((r.query_id, r.id, round(r.score, 9), round(r.norm, 9), r["rank"] or 0) for r in bm25.nearest(i, queries, 4, near).collect())
    have = full(ix)
    assert {x[:4] for x in have} == {x[:4] for x in full(joined)} and [x for x in have if x[4]] == [x for x in full(joined) if x[4]]
    assert len({x[:2] for x in have}) == len(have)


def test_passages_are_sought_in_blocks_where_texts_are_read(spark, monkeypatch):
    """Any kind of id, queries in several blocks, words that most queries share."""
    monkeypatch.setattr(tables, "BLOCK", 3)
    monkeypatch.setattr(tables, "SHORT", 2)
    monkeypatch.setattr(tables, "TEXTS", 4)
    rng = random.Random(5)
    text = lambda k: " ".join(rng.choices(["the", "of", "a", "é", "", "x\ny"], k=k))
    texts = [(f"d{i}", text(rng.choice([0, 2, 40]))) for i in range(40)] + [("d40", None)]
    asked = [(f"q{i}", text(rng.choice([1, 2, 3, 4, 5]))) for i in range(30)] + [("q30", None), ("q31", ""), ("q32", "he of t")]
    got = tables.containing(spark.createDataFrame(texts, "id string, text string").repartition(3), spark.createDataFrame(asked, "query_id string, query string"))
    want = {(i, q) for i, t in texts for q, x in asked if t is not None and x is not None and x in t}
    assert sorted((r.id, r.query_id) for r in got.collect()) == sorted(want) and want


def test_only_rare_terms_leave_the_task_that_reads_them(spark, monkeypatch):
    """Vectors are the same whichever terms go out to all tasks, and rows of one id come together."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    texts = [(i % 50, " ".join(rng.choices(words[: rng.choice([3, 40])], k=rng.choice([0, 1, 30])))) for i in range(60)] + [(None, "w1"), (60, None)]
    docs, queries = spark.createDataFrame(texts, "id long, text string").repartition(3), spark.createDataFrame([(1, "w1 w39 new"), (2, "")], "query_id long, query string")
    monkeypatch.setattr(fitted, "ROWS", 7)
    found = []
    for most in (0, 10, 1000):
        monkeypatch.setattr(fitted, "FREQUENT", most)
        own, asked = fitted.fitted(docs, queries)
        found.append([sorted((r[0], [round(x, 9) for x in r.embedding]) for r in df.collect()) for df in (own, asked)])
    assert found[0] == found[1] == found[2] and len({x[0] for x in found[0][0]}) == len(found[0][0])


def test_texts_of_results_alone_are_joined(spark):
    """An outer join from results to all texts would send every text through a shuffle."""
    found = spark.createDataFrame([(1, 2, 1), (1, 77_777_777, 2)], "query_id long, id long, rank int")
    asked = spark.createDataFrame([(1, "a")], "query_id long, query string")
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "doc_id long, text string")
    path = f"{store.shared(spark)}/texts-of-results"
    docs.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    rows = corpus._fetched(spark, path, found, asked)
    assert sorted((r.id, r.payload_text) for r in rows.collect()) == [(2, "t2"), (77_777_777, None)]
    assert not any("documents.parquet" in f for f in rows.inputFiles())


def test_segments_shuffle_no_postings_for_common_words(spark, tmp_path, monkeypatch):
    """Whether blocks or documents are read, and whether ids that are gone go out or are shuffled, the best are the same; documents are read for common words, and blocks are written where they are made."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, [1 / (j + 1) for j in range(60)], k=rng.choice([0, 3, 60])))) for i in range(300)], "id long, text string").repartition(3)
    queries = spark.createDataFrame([(q, " ".join(rng.choices(words, k=5))) for q in range(6)], "query_id long, query string")
    monkeypatch.setattr(type(docs), "repartitionByRange", None)
    found, real, none = [], segments.Segments._postings, lambda self, blocks, state: spark.createDataFrame([], "id long, dl long, term string, tf long")
    for ids, share, postings in ((10**6, 1.0, none), (10**6, float("inf"), real), (0, float("inf"), real)):
        monkeypatch.setattr(segments, "IDS", ids)
        monkeypatch.setattr(segments, "SHARE", share)
        kept = segments.Segments(spark, f"{tmp_path}/{len(found)}")
        state = kept.added([], docs.filter("id < 200").withColumn("text", F.when(F.col("id") < 50, "w1 w2").otherwise(F.col("text"))))
        state = kept.added(kept.added(state, docs.filter("id < 50")), docs.filter("id >= 200").unionByName(docs.filter("id = 7")), docs.filter("id = 9").select("id"))
        monkeypatch.setattr(segments.Segments, "_postings", postings)
        found.append(sorted((r.query_id, r["rank"], r.id, round(r.score, 6)) for r in kept.top(state, queries, 7).collect()))
        monkeypatch.setattr(segments.Segments, "_postings", real)
    whole = bm25.top(bm25.scores(bm25.index(docs.filter("id <> 9")), queries), 7)
    assert found[0] == found[1] == found[2] == sorted((r.query_id, r["rank"], r.id, round(r.score, 6)) for r in whole.collect())


def test_tokens_are_split_and_summed_without_python_objects(monkeypatch):
    """Sums are handed on at any number of terms, and all of them together are right."""
    rng = random.Random(8)
    texts = ["", " ", " a  b\n", "é\u00a0x \x0b y\x1cz", *(" ".join(rng.choices([f"w{i}" for i in range(90)], k=rng.choice([0, 5, 50]))) + " " for _ in range(60))]
    words, row, n = bm25.words_of(pa.array(texts))
    split = [[w.decode() for w in t.encode().split()] for t in texts]
    assert words.to_pylist() == [w for ws in split for w in ws] and n.tolist() == [len(ws) for ws in split] and row.tolist() == [i for i, ws in enumerate(split) for _ in ws]
    for most in (1, 40, 10**6):
        monkeypatch.setattr(bm25, "TERMS", most)
        monkeypatch.setattr(bm25, "ROWS", 7)
        rows = [r for b in bm25._sums(iter([pa.record_batch([pa.array(texts[:30])], ["t"]), pa.record_batch([pa.array(texts[30:])], ["t"]), pa.record_batch([pa.array([], pa.string())], ["t"])])) for r in b.to_pylist()]
        df = {}
        for r in rows:
            df[r["term"]] = df.get(r["term"], 0) + r["df"]
        assert df.pop(None) == 0 and df == {t: sum(t in ws for ws in split) for t in {w for ws in split for w in ws}}
        assert (sum(r["n"] for r in rows), sum(r["length"] for r in rows)) == (len(texts), sum(map(len, split)))
