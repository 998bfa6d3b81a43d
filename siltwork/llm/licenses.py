"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license templates.

A template is a set of words; its width is the least power of two (8 at least) that holds its text. Every text is cut
into overlapping blocks for each width w: 2 w words from every w-th word on, so that any w words on end lie in one block.
A block meets a template if it holds at least ``threshold`` of the template's set. All such pairs are found:

1. One pass over the texts keeps the places of words that some template has; other words cannot count for any overlap.
2. Words are ordered by their frequency over all texts, rarest first, and sets are written in that order. A pair that
   shares ``need`` words has its first shared word among the first size - need + 1 words of both sets.
3. So blocks with enough template words (length filter) are joined with templates of their width on the words of both
   prefixes; a pair whose places leave too few words behind them is dropped (positional filter), and the rest are
   verified on the whole sets, once, at their first shared word.

Of the templates of one width that a block meets, those of the highest containment, and among them of the most shared
words, give the block's labels. Templates are broadcast in parts of at most ``part`` words, each part with passes of its
own, so that a library of any size can be scanned. Words of A-Z are lower-cased; starts count words from 0.

Defined results: a null or empty text has no words and no labels; rows that share a doc_id are scanned each; templates
without words are skipped; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwork.llm._store import stage
from siltwork.llm._text import pieces, small_batches

#: Phrases whose words stand consecutively, and their labels.
PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
#: Public notices of licenses.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
)
THRESHOLD = 0.9
#: Bytes that separate words become spaces, and A-Z lower case.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
SCANNED = "row long, doc_id long, n_words long, base array<struct<start:long,label:string>>, at array<int>, word array<int>"
BLOCKS = "row long, doc_id long, width int, start long, least int, words array<int>"


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(FOLD).split()


def width_of(n: int) -> int:
    """The least power of two from 8 on that holds n words."""
    return max(8, 1 << (n - 1).bit_length())


def need_of(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def _lists(values: list[np.ndarray] | np.ndarray, many: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)), pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))


def _scan(docs: DataFrame, vocabulary: list[bytes], phrases: list[tuple[str, list[int]]]) -> DataFrame:
    """SCANNED: for each row a number, its words, the places of phrases, and the places of the vocabulary's words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, known = TaskContext.get().partitionId() << 33, pa.array(vocabulary, pa.binary())
        for b in pieces(batches, "text"):
            split = [words_of(t) for t in b.column("text").to_pylist()]
            n = np.array([len(w) for w in split], np.int64)
            coded = pa.array([x for w in split for x in w], pa.binary()).dictionary_encode()
            number = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy(zero_copy_only=False)
            word = number[coded.indices.to_numpy(zero_copy_only=False)] if n.any() else np.empty(0, np.int32)
            start = np.cumsum(n) - n
            doc = np.repeat(np.arange(len(n)), n)
            places, labels = [np.empty(0, np.int64)], []
            for label, phrase in phrases:
                at = np.flatnonzero(word[: len(word) - len(phrase) + 1] == phrase[0])
                for j, x in enumerate(phrase):
                    at = at[word[at + j] == x]
                at = at[doc[at] == doc[at + len(phrase) - 1]]
                places.append(at)
                labels += [label] * len(at)
            place = np.concatenate(places)
            order = np.argsort(place, kind="stable")
            place = place[order]
            base = pa.StructArray.from_arrays([pa.array(place - start[doc[place]]), pa.array(labels, pa.string()).take(pa.array(order))], ["start", "label"])
            hit = np.flatnonzero(word >= 0)
            many = np.bincount(doc[hit], minlength=len(n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen + np.arange(len(n))), b.column("doc_id").cast(pa.int64()), pa.array(n), _lists(base, np.bincount(doc[place], minlength=len(n)), None), _lists(hit - start[doc[hit]], many, pa.int32()), _lists(word[hit], many, pa.int32())],
                names=["row", "doc_id", "n_words", "base", "at", "word"])
            seen += len(n)

    with small_batches(docs.sparkSession):
        return stage(docs.select("doc_id", "text").mapInArrow(scan, SCANNED), "scanned")


def _order(scanned: DataFrame, size: int) -> np.ndarray:
    """The place of each word of the vocabulary in the order of frequency over all texts, rarest first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(b.column("word").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["word", "n"])

    found = scanned.select("word").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()  # the vocabulary at most
    n = np.zeros(size, np.int64)
    n[found["word"].to_numpy()] = found["n"].to_numpy()
    place = np.empty(size, np.int64)
    place[np.argsort(n, kind="stable")] = np.arange(size)
    return place


def _blocks(scanned: DataFrame, place: np.ndarray, least: dict[int, int], useful: dict[int, np.ndarray]) -> DataFrame:
    """BLOCKS: the sets of all blocks that hold as many useful words as some template of their width needs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            at = b.column("at").flatten().to_numpy().astype(np.int64)
            word = place[b.column("word").flatten().to_numpy()]
            many = np.diff(b.column("at").offsets.to_numpy())
            doc = np.repeat(np.arange(b.num_rows), many)
            for width, need in least.items():
                mine = np.flatnonzero(useful[width][word])
                span = int(at[mine].max(initial=0)) // width + 2
                # A word lies in the block that begins at or before it, and in the one before that.
                block = doc[mine] * span + at[mine] // width
                block, w = np.concatenate([block, block[at[mine] >= width] - 1]), np.concatenate([word[mine], word[mine][at[mine] >= width]])
                key = np.unique(block * len(place) + w)
                block, w = key // len(place), key % len(place)
                first = np.flatnonzero(np.diff(block, prepend=-1))
                size = np.diff(np.append(first, len(block)))
                full = size >= need
                if not full.any():
                    continue
                keep, own = np.repeat(full, size), block[first[full]]
                rows = pa.array(own // span)
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").take(rows), b.column("doc_id").take(rows), pa.array(np.full(len(own), width), pa.int32()), pa.array(own % span * width), pa.array(np.full(len(own), need), pa.int32()), _lists(w[keep], size[full], pa.int32())],
                    names=["row", "doc_id", "width", "start", "least", "words"])

    return scanned.select("row", "doc_id", "at", "word").mapInArrow(cut, BLOCKS)


def _met(scanned: DataFrame, templates: list[tuple[str, list[int]]], size: int, threshold: float) -> DataFrame:
    """(row, doc_id, label, start, width, shared, containment) of all pairs of a block and a template that meet the threshold."""
    spark = scanned.sparkSession
    place = _order(scanned, size)
    rows, least, useful = [], {}, {}
    for number, (label, words) in enumerate(templates):
        own, width = np.unique(place[words]), width_of(len(words))
        need = need_of(len(own), threshold)
        least[width] = min(need, least.get(width, need))
        useful.setdefault(width, np.zeros(size, bool))[own] = True
        rows.append((number, label, width, need, own.tolist()))
    prefixes = spark.createDataFrame(rows, "template int, label string, _width int, need int, own array<int>")
    prefixes = prefixes.select("*", F.posexplode(F.slice("own", 1, F.size("own") - F.col("need") + 1)).alias("i", "_word"))
    blocks = _blocks(scanned, place, least, useful)
    each = blocks.select("*", F.posexplode(F.slice("words", 1, F.size("words") - F.col("least") + 1)).alias("j", "first"))
    left = 1 + F.least(F.size("own") - F.col("i") - 1, F.size("words") - F.col("j") - 1)
    met = each.join(F.broadcast(prefixes), (F.col("width") == F.col("_width")) & (F.col("first") == F.col("_word")) & (left >= F.col("need")))  # a part of the templates
    met = met.withColumn("both", F.array_intersect("words", "own")).filter((F.size("both") >= F.col("need")) & (F.get("both", F.lit(0)) == F.col("first")))
    return met.select("row", "doc_id", "label", "start", "width", F.size("both").alias("shared"), (F.size("both") / F.size("own")).alias("containment"))


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, part: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """Two tables. Of each row of ``docs``: row (a number), doc_id, n_words and base, the places (start, label) of phrases; and of each block and template that meet: row, doc_id, label, start, width, shared, containment."""
    split = [(label, words_of(text)) for label, text in templates]
    parts, full = [[]], 0
    for label, words in split:
        if words:
            if full and full + len(words) > part:
                parts.append([])
                full = 0
            parts[-1].append((label, words))
            full += len(words)
    rows, found = None, []
    for mine in parts:
        sought = [] if rows is not None else [(label, words_of(text)) for label, text in phrases if words_of(text)]
        vocabulary = sorted({w for _, words in [*mine, *sought] for w in words})
        number = {w: i for i, w in enumerate(vocabulary)}
        numbered = lambda pairs: [(label, [number[w] for w in words]) for label, words in pairs]  # noqa: B023, E731
        scanned = _scan(docs, vocabulary, numbered(sought))
        if rows is None:
            rows = scanned.select("row", "doc_id", "n_words", "base")
        if mine:
            found.append(_met(scanned, numbered(mine), len(vocabulary), threshold))
    kinds = "row long, doc_id long, label string, start long, width int, shared int, containment double"
    return rows, reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], kinds)


def best(met: DataFrame) -> DataFrame:
    """Of the pairs of each block, those of the highest containment and among them of the most shared words."""
    of = Window.partitionBy("row", "width", "start")
    order = F.struct("containment", "shared")
    return met.withColumn("_most", F.max(order).over(of)).filter(order == F.col("_most")).drop("_most")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: all documents. score: the highest containment of a template, 1 where a phrase stands, 0 where nothing is found."""
    rows, met = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    of = best(met).groupBy(F.col("row").alias("_row")).agg(F.collect_set("label").alias("added"), F.max("containment").alias("most"))
    labels = F.array_distinct(F.transform("base", lambda x: x["label"]))
    text = lambda x: F.array_join(F.array_sort(x), ",")
    every = F.array_union(labels, F.coalesce("added", F.array().cast("array<string>")))
    return rows.join(of, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(F.transform("base", lambda x: x["start"])).alias("first_word"), F.array_max(F.transform("base", lambda x: x["start"])).alias("last_word"),
        text(labels).alias("base_labels"), text(every).alias("labels"), F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"))


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _sql() -> str:
    """Every block against every template that shares a word with it."""
    phrases = " UNION ALL ".join(f"SELECT doc_id, i, '{label}' AS label FROM d, unnest(range(0, len(w) - {len(p.split()) - 1})) AS r(i) WHERE w[i + 1] = '{p.split()[0]}' AND w[i + 1:i + {len(p.split())}] = {p.split()!r}" for label, p in PHRASES)
    rows = ", ".join(f"({i}, '{label}', '{text}', {width_of(len(words_of(text)))}, {need_of(len(set(words_of(text))), THRESHOLD)})" for i, (label, text) in enumerate(TEMPLATES))
    return f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS ({phrases}),
t AS (SELECT * FROM (VALUES {rows}) AS v(template, label, text, width, need)),
v AS (SELECT DISTINCT template, width, unnest(string_split(text, ' ')) AS x FROM t),
z AS (SELECT template, count(*) AS size FROM v GROUP BY 1),
h AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM d),
k AS (SELECT doc_id, x, i FROM h SEMI JOIN v USING (x)),
o AS (SELECT k.doc_id, v.template, v.width, k.i // v.width - s AS block, count(DISTINCT k.x) AS shared
      FROM k JOIN v USING (x), (VALUES (0), (1)) AS u(s) WHERE k.i // v.width >= s GROUP BY ALL),
m AS (SELECT o.*, t.label, shared / size AS containment, rank() OVER (PARTITION BY doc_id, o.width, block ORDER BY shared / size DESC, shared DESC) AS place
      FROM o JOIN t USING (template) JOIN z USING (template) WHERE shared >= need),
l AS (SELECT doc_id, max(containment) AS most FROM m GROUP BY 1),
a AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM m WHERE place = 1) GROUP BY 1),
f AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(f.n, 0)::BIGINT AS n_base, f.lo::BIGINT AS first_word, f.hi::BIGINT AS last_word, coalesce(f.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       CASE WHEN f.n > 0 THEN 1.0 ELSE coalesce(l.most, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN f USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN l USING (doc_id)
"""


QUERIES = {"op12_license_scan": op12_license_scan}
ORACLES = {"op12_license_scan": _sql()}
