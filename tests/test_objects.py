"""Objects as a data source: planned partitions, one bad object among many, and a stream of changes."""

import os

import pytest

from siltwork.sources import objects as O


def test_partitions_are_packed_by_bytes():
    made = [O.Object(f"k{i}", s, 0.0) for i, s in enumerate((10, 20, 80, 500, 0, 0, 99, 1))]
    assert [[x[0] for x in p.objects] for p in O.planned(made, 100)] == [["k0", "k1"], ["k2"], ["k3"], ["k4", "k5"], ["k6", "k7"]]
    assert O.planned([], 100) == []


def test_attempts_are_made_and_the_error_is_kept():
    tries = []

    def get(key):
        tries.append(key)
        if key == "bad" or len(tries) < 2:
            raise PermissionError(key)
        return b"x"

    got = list(O.rows(O.Part([("slow", 1, 0.0), ("bad", 1, 0.0)]), get))
    assert [(r[0], r[3], r[4]) for r in got] == [("slow", b"x", None), ("bad", None, "PermissionError: bad")] and tries.count("bad") == 3


@pytest.fixture
def place(tmp_path):
    for n, t in (("a.txt", "alpha"), ("sub/b.md", "beta"), ("c.bin", "gamma"), ("page.html", "<p>delta</p>")):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text(t)
    os.symlink(tmp_path / "nowhere", tmp_path / "gone.txt")  # listed, but not to be read
    return tmp_path


def test_a_listing_with_an_unreadable_object_is_read(spark, place):
    name = O.registered(spark, O.store("mounted", *O.folder(str(place)), part_bytes=8))
    found = spark.read.format(name).load()
    assert found.rdd.getNumPartitions() > 1
    assert [r.key for r in O.failures(found).collect()] == ["gone.txt"]
    docs = {r.filename: (r.content, r.source_uri, sorted(r.metadata)) for r in O.documents(found, "m://", "mount").collect()}
    assert docs == {"a.txt": ("alpha", "m://a.txt", ["modified", "size"]), "b.md": ("beta", "m://sub/b.md", ["modified", "size"]), "page.html": ("delta", "m://page.html", ["modified", "size"])}


def test_changes_come_as_a_stream(spark, place, tmp_path_factory):
    name, out = O.registered(spark, O.store("watched", *O.folder(str(place)))), tmp_path_factory.mktemp("out")

    def run():
        spark.readStream.format(name).load().writeStream.format("parquet").option("path", str(out / "rows")).option("checkpointLocation", str(out / "state")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.key, bytes(r.content or b"")) for r in spark.read.schema(O.SCHEMA).parquet(str(out / "rows")).collect())

    first = run()
    assert [k for k, _ in first] == ["a.txt", "c.bin", "gone.txt", "page.html", "sub/b.md"] and run() == first
    (place / "new.txt").write_text("new")
    (place / "a.txt").write_text("alpha 2")
    later = os.stat(place / "c.bin").st_mtime + 50
    os.utime(place / "new.txt", (later, later))
    os.utime(place / "a.txt", (later, later))
    assert run() == sorted([*first, ("a.txt", b"alpha 2"), ("new.txt", b"new")])


def test_an_empty_store(spark, tmp_path):
    name = O.registered(spark, O.store("empty", *O.folder(str(tmp_path))))
    assert spark.read.format(name).load().count() == 0
