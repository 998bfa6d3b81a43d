"""Token rollups and URL filters against plain Python."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltwork.llm import rollup, url_filter

DAY = datetime.date(2024, 1, 1)


def changed(spark, rows):
    return spark.createDataFrame(rows, rollup.CHANGES)


def totals(store):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in store.totals().collect()}


def test_batches_are_idempotent_and_signed(spark, tmp_path):
    store = rollup.Rollup(spark, str(tmp_path / "s"))
    assert totals(store) == {}
    first = [("insert", 1, "a", "en", "t1", 10), ("insert", 2, "a", None, "t1", 5), ("insert", 2, "a", None, "t2", 7), ("insert", None, None, "en", "t1", 3), ("insert", 9, "a", "en", "t1", None)]
    assert store.commit("b1", changed(spark, first)) and not store.commit("b1", changed(spark, first))
    assert totals(store) == {("a", "en", "t1"): (2, 10), ("a", None, "t1"): (1, 5), ("a", None, "t2"): (1, 7), (None, "en", "t1"): (1, 3)}
    store.commit("b2", changed(spark, [("revise", 1, "b", "en", "t1", 4), ("delete", 2, None, None, "t2", None), ("delete", 77, None, None, None, None)]))
    assert totals(store) == {("a", "en", "t1"): (1, 0), ("b", "en", "t1"): (1, 4), ("a", None, "t1"): (1, 5), (None, "en", "t1"): (1, 3)}
    store.commit("b3", changed(spark, [("delete", i, None, None, None, None) for i in (1, 2, 9)]))
    store.commit("b4", changed(spark, []))
    assert totals(rollup.Rollup(spark, str(tmp_path / "s"))) == {(None, "en", "t1"): (1, 3)}
    assert store.committed() == ["b1", "b2", "b3", "b4"]


def test_a_batch_without_its_marker_does_not_count(spark, tmp_path):
    store = rollup.Rollup(spark, str(tmp_path / "s"))
    changed(spark, [("insert", 1, "a", "en", "t", 5)]).write.parquet(f"{store.path}/ledger/half")
    assert totals(store) == {}
    assert store.commit("half", changed(spark, [("insert", 1, "a", "en", "t", 6)])) and totals(store) == {("a", "en", "t"): (1, 6)}
    with pytest.raises(ValueError):
        store.commit("a/b", changed(spark, []))


def test_random_histories(spark, tmp_path):
    rng, store, now = random.Random(3), rollup.Rollup(spark, str(tmp_path / "s"), buckets=5, every=2), {}
    for b in range(6):
        ids, rows = rng.sample(range(30), 12), []
        for i in ids:
            if rng.random() < 0.3:
                rows.append(("delete", i, None, None, None, None))
                now.pop(i, None)
            else:
                now[i] = (rng.choice("ab"), rng.choice(["en", None]), "t", rng.randrange(9))
                rows.append(("insert", i, *now[i]))
        store.commit(f"b{b}", changed(spark, rows))
    want = Counter(), Counter()
    for *key, n in now.values():
        want[0][tuple(key)] += 1
        want[1][tuple(key)] += n
    assert totals(store) == {k: (want[0][k], want[1][k]) for k in want[0]}
    assert store.committed() == [f"b{b}" for b in range(6)] and len(store._live()) <= 3 and store._live()[0].startswith("base-")
    assert {(r.doc_id, r.tokens) for r in store.net().collect()} == {(i, x[3]) for i, x in now.items()}


def test_rollup_query(docs, rows, spark, table):
    import base64

    import tiktoken

    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.op4_token_rollups(spark, table(docs.withColumn("tokens", F.lit(1)))).collect()}
    with open(f"{rollup.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("t", pat_str=rollup.PATTERN, mergeable_ranks=ranks, special_tokens={})
    seen, want = set(), {}
    for _, text, lang, source, _ in sorted(rows):
        if text is not None and text in seen:
            continue
        seen.add(text)
        for name, n in (("byte_bpe_50k", len(bpe.encode_ordinary(text or ""))), ("words_1", len((text or "").translate(dict.fromkeys(map(ord, ".,;:!?")) if lang == "de" else {}).encode().split()))):
            d, t = want.get((source, lang, name), (0, 0))
            want[source, lang, name] = d + 1, t + n
    assert got == want


def test_vocabulary_counts_what_the_library_says():
    import public_tokenizers

    assert rollup.bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))()(["Hello world, it's 42!", "", None]) == [7, 0, 0]


def active(entries, host, day):
    """Days from the last action at or before ``day`` of each key that covers the host."""
    found = []
    for key in {k.lower() for k, *_ in entries if k}:
        if host == key or host.endswith("." + key):
            acts = {}
            for k, a, d in entries:
                if k and k.lower() == key and a in ("add", "remove") and d is not None:
                    acts[d] = max(a, acts.get(d, ""))
            past = [d for d in sorted(acts) if d <= day]
            if past and acts[past[-1]] == "add":
                start = past[-1]
                for d in reversed(past):
                    if acts[d] != "add":
                        break
                    start = d
                found.append((len(key), key, start))
    return sorted(found)


def test_temporal_filter(spark):
    rng = random.Random(8)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "c.co.uk", "localhost"]
    entries = [(rng.choice(["a.com", "X.a.com", "b.org", "co.uk", "y.x.a.com"]), rng.choice(["add", "add", "remove"]), DAY + datetime.timedelta(rng.randrange(60))) for _ in range(40)]
    entries += [(None, "add", DAY), ("b.org", None, DAY), ("b.org", "add", None), ("b.org", "other", DAY)]
    pages = [(i, f"https://u:p@{rng.choice(hosts).upper()}:80/p?q=@a.com", DAY + datetime.timedelta(rng.randrange(-5, 70))) for i in range(300)]
    pages += [(900, None, DAY), (901, "not a url", DAY), (902, "http://a.com/", None), (903, "http://a.com./", DAY), (None, "http://b.org", DAY)] + [(904, "http://a.com/", DAY + datetime.timedelta(30))] * 3
    made = spark.createDataFrame(pages, "page_id long, url string, day date").withColumn("host", F.lit("clash"))
    got = url_filter.filtered(made, spark.createDataFrame(entries, "key string, action string, day date")).collect()
    assert len(got) == len(pages)
    for r in got:
        want = active(entries, r.host, r.day) if r.host and r.day else []
        assert (r.blocked, r.n_active) == (bool(want), len(want)), r
        if want:
            assert (r.entry, r.since) == want[-1][1:], r
    assert {r.host for r in got if r.page_id in (900, 901)} == {None}
    none = spark.createDataFrame([], "key string, action string, day date")
    assert url_filter.filtered(made, none).filter("blocked").count() == 0 and url_filter.filtered(made.limit(0), none).count() == 0
