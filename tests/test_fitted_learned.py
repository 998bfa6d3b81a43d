"""Fitted vectors against plain TF-IDF sums, and the learned order."""

import math
import random
from collections import Counter
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from siltwork.operators import fitted, learned


def vector(counts, idf):
    out = np.zeros(256)
    for t, n in counts.items():
        out += n * idf(t) * np.array([1 - 2 * int(b) for b in "".join(f"{x:08b}" for x in sha256(t.encode()).digest())])
    return out


def test_vectors_are_weighted_sums_of_signs(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["é", "The"]
    texts = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 9, 60])))) for i in range(80)] + [(100, None), (101, " ")]
    queries = [(1, "w3 unknown the"), (2, ""), (3, texts[3][1] or "w1")]
    own, asked = fitted.fitted(spark.createDataFrame(texts, "id long, text string").repartition(3), spark.createDataFrame(queries, "query_id long, query string"))
    counts = {i: Counter((t or "").lower().split()) for i, t in texts}
    df = Counter(t for c in counts.values() for t in c)
    idf = lambda t: math.log((len(texts) + 1) / (df[t] + 1)) + 1
    got = {r.id: np.array(r.embedding) for r in own.collect()}
    assert set(got) == {i for i, c in counts.items() if c}
    assert all(np.allclose(v, vector(counts[i], idf)) for i, v in got.items())
    asks = {r.query_id: np.array(r.embedding) for r in asked.collect()}
    assert set(asks) == {q for q, t in queries if t.strip()} and all(np.allclose(asks[q], vector(Counter(t.lower().split()), idf)) for q, t in queries if t.strip())


def test_a_feature_that_decides_is_learned(spark):
    rng = random.Random(1)
    rows = [(q, i, rng.random(), rng.random(), rng.random(), float(i == 0) * 0.5 + rng.random() * 0.4, rng.random(), i == 0) for q in range(60) for i in range(8)]
    made = spark.createDataFrame(rows, "query_id long, id long, sparse double, dense double, lexical double, phrase double, length double, right boolean")
    weights = learned.fit(made.filter("query_id < 40"))
    assert max(range(5), key=lambda i: weights[i]) == 3
    best = learned.ranked(learned.scored(made.filter("query_id >= 40"), weights), "learned", 1)
    assert best.filter("id = 0").count() >= 18
    none = learned.fit(made.filter("not right"))
    assert none == [0.0] * 5
    same = learned.ranked(learned.scored(made.filter("query_id = 41"), none), "learned", 8).orderBy("rank")
    assert [r.id for r in same.collect()] == [r[1] for r in sorted((x for x in rows if x[0] == 41), key=lambda x: -round(x[2], 6))]


def test_runs_of_three(spark):
    row = spark.range(1).select(learned.phrase_score(F.lit("a b c d"), F.lit("x A b c b c d")).alias("x"), learned.phrase_score(F.lit("a b"), F.lit("a b c")).alias("y"), learned.phrase_score(F.lit(None).cast("string"), F.lit("a")).alias("z"), learned.phrase_score(F.lit("a a a a"), F.lit(None).cast("string")).alias("w")).first()
    assert tuple(row) == (1.0, 0.0, 0.0, 0.0)
