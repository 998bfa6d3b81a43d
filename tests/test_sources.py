"""Sources, streams, refresh runs, and every registered query against its SQL."""

import datetime
import json
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from siltwork.operators import bm25, dedup, manifest, segments
from siltwork.plans import catalog, refresh, steps
from siltwork.sources import documents as S
from siltwork.streaming import ingest

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_files(spark, tmp_path):
    (tmp_path / "deep dir").mkdir()
    for name, data in {"a.txt": b"  caf\xc3\xa9 \xff text\n", "b.MD": b"# Title", "deep dir/c.html": b"<html><script>x</script><nav>menu</nav><p>Hello <b>there</b></p></html>", "d.json": b'{"k": [1]}', "e.csv": b"no", "f.txt": b"  ",
                       "g.json": b"{broken", "h.pdf": b"%PDF", "benchmark_queries.json": b"[]", "urls_to_scrape.txt": b"http://x"}.items():
        (tmp_path / name).write_bytes(data)
    got = {r.filename: r for r in S.from_files(spark, str(tmp_path), pdf=lambda data: ["page 1", "page 2"]).collect()}
    assert {k: r.content for k, r in got.items()} == {"a.txt": "café  text", "b.MD": "# Title", "c.html": "menu\nHello\nthere", "d.json": json.dumps({"k": [1]}, indent=2), "h.pdf": "page 1\npage 2"}
    assert got["a.txt"].metadata["size"] == "15" and got["a.txt"].source == "filesystem"
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        S.from_files(spark, str(tmp_path / "none")).collect()


def test_urls(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("# list\n\nhttp://a\n  http://b  \nhttp://bad\n")

    def get(url):
        if "bad" in url:
            raise OSError(url)
        return f"<html><head><title> Page {url[-1]} </title></head><body><header>top</header><p>Text &amp; more</p><!-- no --></body></html>" if url.endswith("a") else "<p>untitled</p>"

    got = {r.filename: r.content for r in S.from_pages(S.fetched(S.url_list(spark, str(tmp_path / "urls.txt")), get=get)).collect()}
    assert got == {"Page a": "Page a\nText & more", "http://b": "untitled"}


def test_union_and_benchmark(spark, sf, tmp_path):
    docs = S.from_table(spark.read.parquet(f"{sf}/documents.parquet"))
    assert S.union(docs, S.from_pages(spark.read.parquet(f"{sf}/pages.parquet"))).count() == 250
    with pytest.raises(ValueError):
        S.union(docs.limit(0))
    (tmp_path / "b.json").write_text('[{"query": "q", "expected_docs": ["a", "b"]}, {"query": "r", "expected_docs": []}]')
    assert [r.expected_docs for r in S.benchmark(spark, str(tmp_path / "b.json")).collect()] == [["a", "b"], []]


def test_range_reply(spark):
    reply = {"data": {"result": [{"values": [[1704067200, "0.03"], [1704153600, "0.035"], [1704240000, "x"]]}, {"values": [[1, "9"]]}]}}
    got = S.range_reply(spark.createDataFrame([(json.dumps(reply),), ('{"data": {"result": []}}',), ("broken",)], "value string")).collect()
    assert [tuple(r) for r in got] == [(1704067200.0, 0.03), (1704153600.0, 0.035)]


def test_stream_keeps_first_sightings(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("at", F.lit(datetime.datetime(2024, 2, 15)))
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = ingest.first_sightings(ingest.watched(spark, str(tmp_path / "in"), docs.schema), "text", "at")
    for _ in range(2):
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.select("text").distinct().count()


def test_two_phase_stream_confirms_what_landed(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").alias("content"))
    docs.write.parquet(str(tmp_path / "in"))
    path, schema, now = str(tmp_path / "store"), "content_hash string, confirmed_at timestamp_ntz", F.lit("2024-02-15").cast("timestamp_ntz")
    spark.createDataFrame([], schema).write.parquet(path)
    landed = []

    def land(new):
        landed.append(new.count())
        return new.filter("doc_id % 2 = 0")

    def run():
        ingest.two_phase(ingest.watched(spark, str(tmp_path / "in"), docs.schema), lambda: spark.read.schema(schema).parquet(path), land, lambda df: df.write.mode("append").parquet(path), now, str(tmp_path / f"c{len(landed)}")).awaitTermination()

    run()
    even = dedup.hashed(docs).filter("doc_id % 2 = 0").select("content_hash").distinct().count()
    assert spark.read.parquet(path).count() == even
    run()
    assert landed == [docs.count(), dedup.new_documents(dedup.hashed(docs), dedup.hashed(docs).filter("doc_id % 2 = 0")).count()]


def test_refresh_promotes_carries_over_and_rolls_back(spark, tmp_path):
    made = lambda rows: spark.createDataFrame([(t, "s", f"s://{n}", n) for n, t in rows], "content string, source string, source_uri string, filename string")
    now, path = F.lit("2024-02-15").cast("timestamp_ntz"), str(tmp_path / "kb")
    bench = spark.createDataFrame([(1, "vacation days", ["a.txt"])], "query_id long, query string, expected_docs array<string>")
    first = [("a.txt", "twenty vacation days a year"), ("b.txt", "remote work policy"), ("c.txt", "health insurance for the family")]
    assert refresh.run(spark, "r1", made(first), bench, path, now).decision == "promote"
    assert refresh.run(spark, "r2", made(first), bench, path, now).decision == "no_change"
    r = refresh.run(spark, "r3", made([*first, ("b.txt", "remote work policy changed")]), bench, path, now)
    assert (r.decision, r.n_new) == ("promote", 1)
    store = manifest.Manifests(spark, f"{path}/index")
    assert store.current() == "r3" and sorted((x.filename, x.chunk_text[-7:]) for x in store.read().collect()) == [("a.txt", " a year"), ("b.txt", "changed"), ("c.txt", " family")]
    hard = spark.createDataFrame([(1, "unrelated", ["z.txt"])], bench.schema)
    assert refresh.run(spark, "r4", made([("d.txt", "new words")]), hard, path, now).decision == "rollback"
    sparse = segments.Segments(spark, f"{path}/sparse")
    words = lambda: {r.term for r in sparse.terms(store.notes()["sparse"]).collect()}
    assert store.current() == "r3" and "words" not in words() and "changed" in words()  # production keeps its own index
    assert refresh.run(spark, "r5", made([("d.txt", "new words")]), bench, path, now).decision == "promote"
    assert "words" in words() and len(store.notes()["sparse"]) == 3
    whole = bm25.index(refresh.numbered(store.read()))
    asked = spark.createDataFrame([(1, "remote work changed days")], "query_id long, query string")
    rows = lambda ix: sorted((r.id, round(r.score, 9)) for r in bm25.scores(ix, asked).collect())
    assert rows(sparse.index(store.notes()["sparse"])) == rows(whole) != []
    # What expired goes with the next run, from points and sparse index alike.
    later = F.lit("2025-03-01").cast("timestamp_ntz")
    assert refresh.run(spark, "r6", made([("e.txt", "only this")]), bench, path, later, refresh.Settings(threshold=0.0)).decision == "promote"
    assert [r.filename for r in store.read().collect()] == ["e.txt"] and words() == {"only", "this"}


def test_a_run_that_meets_another_fails_and_confirms_nothing(spark, tmp_path):
    made = lambda rows: spark.createDataFrame([(t, "s", f"s://{n}", n) for n, t in rows], "content string, source string, source_uri string, filename string")
    now, path = F.lit("2024-02-15").cast("timestamp_ntz"), str(tmp_path / "kb")
    bench = spark.createDataFrame([(1, "x", ["a.txt"])], "query_id long, query string, expected_docs array<string>")
    free = refresh.Settings(threshold=0.0)
    refresh.run(spark, "r1", made([("a.txt", "x y")]), bench, path, now, free)
    run = refresh.Run(spark, "r2", path, now, free)
    real = run.versions.promote

    def slow(version):
        refresh.run(spark, "r3", made([("a.txt", "x other")]), bench, path, now, free)
        return real(version)

    run.versions.promote = slow
    with pytest.raises(steps.StepFailed):
        run.go(made([("a.txt", "x late")]), bench)
    assert run.versions.current() == "r3" and [r.chunk_text for r in run.versions.read().collect()] == ["x other"]
    assert refresh.run(spark, "r4", made([("a.txt", "x late")]), bench, path, now, free).n_new == 1


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_of_the_engine_has_a_name_of_its_own():
    assert set(catalog.oracle_sql()) <= set(catalog.queries()) and len(catalog.queries()) >= 50


def plain(v):
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return str(v)[:19].replace(" 00:00:00", "") if isinstance(v, (datetime.datetime, datetime.date)) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_against_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df, rel = catalog.queries()[name](spark, sf), con.sql(catalog.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    want = sorted(repr([plain(row[rel.columns.index(c)]) for c in columns]) for row in rel.fetchall())
    assert got == want


def test_the_rest_does_not_import_llm():
    root = Path(__spark_entry__.__file__).parent / "siltwork"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "siltwork.llm" in p.read_text()]


def test_phases_expire_and_survive_a_restart(spark, tmp_path):
    schema = "content_hash string, at timestamp, landed boolean"
    made = lambda *rows: spark.createDataFrame([(h, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s), x) for h, s, x in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(state, files=1):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in"))
        with ingest.rocksdb(spark):
            ingest.phases(stream, 100, 1).writeStream.format("parquet").option("path", str(tmp_path / f"out-{state}")).option("checkpointLocation", str(tmp_path / state)).trigger(availableNow=True).start().awaitTermination()
        out = spark.read.schema(ingest.EVENTS).parquet(str(tmp_path / f"out-{state}")).collect()
        return sorted((r.content_hash, r.event, (r.at - datetime.datetime(2024, 1, 1)).total_seconds()) for r in out)

    made(("a", 0, False), ("a", 10, False), ("b", 0, None), (None, 0, False), ("", 0, False), ("c", 5, True))
    first = run("kept")
    assert first == [("a", "new", 0), ("b", "new", 0), ("c", "confirmed", 5)]
    made(("a", 50, True), ("b", 60, False), ("c", 60, False), ("a", 70, True))
    made(("a", 200, False), ("b", 200, False), ("b", 210, True), ("c", 86_404, False))
    day = 86_400
    made(("a", day + 49, False), ("b", day + 300, False), ("a", day + 300, False), ("c", day + 301, False))
    want = sorted([*first, ("a", "confirmed", 50), ("b", "new", 200), ("b", "confirmed", 210), ("a", "new", day + 300), ("b", "new", day + 300), ("c", "new", day + 301)])
    assert run("kept") == want == run("kept")  # the second start finds nothing to do
    assert run("anew") == want
