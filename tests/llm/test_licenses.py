"""License scans: phrases and the set-similarity join against all blocks and templates, one by one."""

import math
import random
import re

import pytest

from siltwork.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, templates, threshold):
    """(doc_id, label, start, width, shared, containment) of every block and template that meet."""
    out = []
    for doc_id, text in docs:
        w = words(text)
        for label, t in templates:
            own = set(words(t))
            if not own:
                continue
            width = 8
            while width < len(words(t)):
                width *= 2
            for start in range(0, len(w), width):
                shared = len(own & set(w[start : start + 2 * width]))
                if shared >= max(1, math.ceil(threshold * len(own) - 1e-9)):
                    out.append((doc_id, label, start, width, shared, shared / len(own)))
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    few = [f"t{i}" for i in range(40)] + ["the", "of", "é"]
    templates = [(f"l{i % 7}", " ".join(rng.choices(few, k=rng.choice([1, 3, 6, 9, 20, 70])))) for i in range(25)] + [("none", ""), ("none", " .,")]
    docs = []
    for i in range(150):
        text = rng.choices(few + ["other", "words", "The"], k=rng.choice([0, 1, 7, 8, 9, 50, 300]))
        if i % 3 == 0:
            t = words(rng.choice(templates)[1])
            rng.shuffle(t)
            at = rng.randrange(len(text) + 1)
            text[at:at] = t[: max(1, len(t) - rng.randrange(3))] if t else []
        docs.append((i, rng.choice([" ", ", ", "_", "\n"]).join(text)))
    return [*docs, (900, None), (901, ""), (902, " ;;; ")], templates


@pytest.mark.parametrize(("threshold", "part"), [(0.9, 200_000), (0.6, 200_000), (0.75, 60), (1.0, 1)])
def test_all_pairs_are_found(spark, corpus, threshold, part):
    docs, templates = corpus
    rows, met = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), templates, (), threshold, part)
    assert sorted((r.doc_id, r.label, r.start, r.width, r.shared, r.containment) for r in met.collect()) == brute(docs, templates, threshold)
    assert {r.doc_id: r.n_words for r in rows.collect()} == {i: len(words(t)) for i, t in docs}


def test_query(spark, table):
    texts = ["Released under the MIT License. x under THE mit-license", "Apache License, Version 2.0", "CC BY-NC 4.0, cc by nc", "Licensed under the GNU General Public License, version 3.", "under the mit\nlicence", "", None,
             "Licensed under the GNU GENERAL public license, version 2!", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "the mit license under", "licensed under the public license version 3 of nobody", "mit License under the"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, label string")
    got = {r.doc_id: (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.op12_license_scan(spark, table(docs)).collect()}
    assert got[0] == (2, 1, 6, "mit", "mit", 1.0) and got[1] == (1, 0, 0, "apache-2", "apache-2", 1.0) and got[2] == (2, 0, 5, "cc-by-nc", "cc-by-nc", 1.0)
    assert got[3] == (0, None, None, "", "gpl-3", 1.0) and got[7] == (0, None, None, "", "gpl-2", 1.0) and got[8] == (0, None, None, "", "cc-by-sa", 1.0)
    assert all(got[i] == (0, None, None, "", "", 0.0) for i in (4, 5, 6, 9, 10, 11))


def test_repeated_ids_are_scanned_each(spark):
    docs = spark.createDataFrame([(1, "cc by nc"), (1, "nothing"), (None, "under the mit license"), (None, "under the mit license")], "doc_id long, text string")
    rows, _ = licenses.scan(docs)
    assert sorted((r.doc_id or 0, [tuple(x) for x in r.base]) for r in rows.collect()) == [(0, [(0, "mit")]), (0, [(0, "mit")]), (1, []), (1, [(0, "cc-by-nc")])]
