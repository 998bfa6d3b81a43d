"""The bucketed hash store: only buckets that filters name are read, first confirmations stand, writers that meet see each other."""

import shutil
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from siltwork.operators import hash_store



def later(days):
    return F.lit("2024-02-15 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(days))


def hashes(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "doc_id long").withColumn("content_hash", F.sha2(F.col("doc_id").cast("string"), 256))


def test_only_hit_buckets_are_read(spark, tmp_path):
    store = hash_store.HashStore(spark, str(tmp_path), 32)
    assert store.known(hashes(spark, range(9)), later(0))[1] == []
    store.confirm(hashes(spark, range(300)), later(0))
    asked = hashes(spark, [5, 6, 1000, 1001])
    known, hit = store.known(asked, later(0))
    assert {r.content_hash for r in known.collect()} == {r.content_hash for r in asked.filter("doc_id < 7").collect()}
    own = {r[0] for r in asked.filter("doc_id < 7").select(store.bucket()).collect()}
    assert own <= set(hit) and len(hit) <= 4
    for name in hash_store.Folder(spark, f"{tmp_path}/data").names():  # other buckets can even be missing
        for b in range(32):
            if b not in hit:
                shutil.rmtree(tmp_path / "data" / name / f"bucket={b}", ignore_errors=True)
    assert {r.doc_id for r in store.new_documents(asked, later(0)).collect()} == {1000, 1001}


def test_first_confirmations_stand_and_expire(spark, tmp_path):
    store = hash_store.HashStore(spark, str(tmp_path), 4, every=2)
    docs = hashes(spark, [1, 1, 2]).unionByName(spark.createDataFrame([(7, None), (8, "")], "doc_id long, content_hash string"))
    first = store.confirm(docs, later(0))
    assert store.confirm(docs, later(3)) == first and store.live(later(3)).count() == 2
    assert store.confirm(docs, later(30)) > first and store.live(later(31)).select("confirmed_at").distinct().count() == 1
    for i in range(6):
        store.confirm(hashes(spark, [100 + i]), later(30))
    assert max(map(len, store._files().values())) <= 2 and 8 <= store.rows().count() <= 10
    assert store.live(later(31)).count() == 8
    store.compact(later(61))
    assert store.rows().count() == 0 and store.vacuum() > 0
    assert store.new_documents(docs, later(61)).count() == 3


def test_forgetting_writes_hit_buckets_only(spark, tmp_path):
    store = hash_store.HashStore(spark, str(tmp_path), 16)
    store.confirm(hashes(spark, range(200)), later(0))
    before = store._files()
    hit = store.forget(hashes(spark, [3, 4, 999]))
    after = store._files()
    assert 0 < len(hit) <= 3 and all(before[b] == after[b] for b in before if int(b) not in hit)
    assert store.live(later(0)).count() == 198 and {r.doc_id for r in store.new_documents(hashes(spark, [3, 4, 5]), later(0)).collect()} == {3, 4}
    assert store.forget(hashes(spark, [])) == []


def test_writers_that_meet(spark, tmp_path):
    store = hash_store.HashStore(spark, str(tmp_path), 4)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda i: hash_store.HashStore(spark, str(tmp_path), 4).confirm(hashes(spark, range(i, i + 20)), later(i)), (0, 10, 15)))
    assert store.live(later(16)).count() == 35 and store.rows().count() == 35
