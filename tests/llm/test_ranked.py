"""Ranked search over the tiered index against plain Python scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from siltwork.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    """item -> [(rank, doc_id, score)]."""
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = {}
    for item, text in items:
        scores = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out[item] = [(k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:20], 1)]
    return out


def found(spark, docs, items, **kw):
    tiers, shard, block = kw.get("tiers", ranked.TIERS), kw.get("shard", 4_000_000), kw.get("block", 1000)
    index = ranked.build(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), tiers, shard)
    out = {i: [] for i, _ in items}
    for r in ranked.search(index, spark.createDataFrame(items, "item_id long, text string"), block).collect():
        out[r.item_id].append((r.rank, r.doc_id, r.score))
    return {i: sorted(x) for i, x in out.items()}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["the", "Of", "é", "中文"]
    weights = [1 / (i + 1) for i in range(60)] + [8, 6, 2, 1]
    docs = [(i, rng.choice([" ", ", ", "\n", "__"]).join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 200])))) for i in range(400)]
    docs += [(i, docs[i % 7][1]) for i in range(400, 460)]  # copies: ties in score
    docs += [(460, None), (461, ""), (462, " .,;"), (None, docs[3][1]), (None, "w59 w58"), (463, "the " * 5000), (7, docs[3][1])]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 12, 30])))) for i in range(25)]
    return docs, [*items, (100, None), (101, ""), (102, "nowhere"), (103, "the the the"), (104, docs[3][1])]


@pytest.mark.parametrize("kw", [{}, {"shard": 3000}, {"shard": 3000, "tiers": (0.5, 0.2, 0.1, 0.05)}, {"tiers": (), "block": 7}, {"shard": 20_000, "tiers": (0.3,), "block": 4}])
def test_equals_brute_force(spark, corpus, kw):
    docs, items = corpus
    assert found(spark, docs, items, **kw) == brute(docs, items)


def test_shards_are_left_out_once_an_item_is_proved(spark):
    """One item whose term few documents hold, in one shard of many: lower tiers of the others are not read."""
    docs = [(i, " ".join([f"x{i % 50}"] * 3 + [f"y{i}"] + ["the"] * (i % 3) + ["rare rarer"] * (i < 100 and i % 4 == 0))) for i in range(600)]
    index = ranked.build(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).sortWithinPartitions("doc_id"), (0.1, 0.05), 2000)
    asked = ranked.Block.of(["rare rarer the"])
    size = index.agg({"docs": "sum", "terms": "sum"}).first()
    asked.rows, asked.total = size["sum(docs)"], size["sum(terms)"]
    asked.weights = [math.floor(1000 * math.log((2 * asked.rows + 2) / (2 * int(x) + 1))) for x in ranked._frequencies(index, asked)]
    asked.weights = ranked.np.array(asked.weights)
    first = ranked._pairs(index, asked, 0, 2, ranked.np.ones(1, int)).collect()
    floor = sorted((x.score for r in first for x in r.found), reverse=True)[19]
    shards = index.count()
    assert shards > 10 and sum(not r.whole and r.upper >= floor for r in first) < shards / 2
    assert found(spark, docs, [(1, "rare rarer the")], shard=2000, tiers=(0.1, 0.05)) == brute(docs, [(1, "rare rarer the")])


def test_extra_columns_and_equal_items(spark, table):
    docs = spark.createDataFrame([(1, "a b", 5), (2, "b", 6)], "doc_id long, text string, shard int")
    items = spark.createDataFrame([(1, "b", 0), (1, "b", 0), (1, "a", 0), (None, "b", 1)], "item_id long, text string, rank int")
    out = ranked.op13_tiered_search(spark, table(docs, benchmark=items))
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted(((r.item_id or 0, r.rank, r.doc_id) for r in out.collect()))
    assert got == [(0, 1, 2), (0, 2, 1), (1, 1, 1), (1, 1, 2), (1, 2, 1)]
