"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

Fixed base rules reject first. Beyond them a rule may reject a document only at a cutoff that a labelled
holdout certifies: with k of n good documents of a stratum rejected, the exact binomial tail
P(Bin(n, risk) <= k) must be at most confidence / m, where m counts all (stratum, rule, cutoff) tests, so that
with probability 1 - confidence no certified cutoff rejects more than ``risk`` of any stratum's good documents
(Bonferroni). Of a rule's certified cutoffs the strictest is taken. A stratum without enough labels gets none.

Defined results: a null text counts as empty; a null stratum is one of its own; labels that are null, or of
documents not in the table, count for nothing; an empty table gives an empty result; repeated rows stay repeated
and are judged alike. Extra columns of ``docs`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm._store import stage
from siltwork.llm._text import SPACE_CHARS, words_of

SYMBOLS = "#*$%&|<>"
#: Rule: (expression over the features, cutoffs from mild to strict); a document fails at values above the cutoff.
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", (0.5, 0.35, 0.25, 0.18, 0.12, 0.08)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", (0.7, 0.55, 0.45, 0.35, 0.3)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.45, 0.4, 0.35, 0.3)),
    "long_words": ("word_chars / greatest(n_words, 1)", (40.0, 25.0, 18.0, 14.0, 12.0)),
    "short_words": ("-word_chars / greatest(n_words, 1)", (-1.2, -1.6, -2.0, -2.4)),
}
#: Tables of cutoffs up to this many rows are broadcast; larger ones join by shuffle.
MOST_BROADCAST = 10_000


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns ``keep``, and the counts that the rules judge; whole texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", *keep, text.alias("text")).select(
        "doc_id", *keep, "text", words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "").alias("lines"),
    )
    # Windows are sorted by hash with their places, so that equal ones meet: n log n in the words of a document.
    at = lambda i: F.get("words", i)
    windows = lines.select(
        "doc_id", *keep, "words",
        (F.length("text") - F.length(F.translate("text", SPACE_CHARS, ""))).alias("n_spaces"),
        F.length("text").alias("n_chars"),
        _removed(F.col("text"), SYMBOLS).alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size("words").alias("n_words"),
        F.when(F.size("words") > 3, F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.alias("at"))
        ))).alias("sorted"),
    )

    def equal(p: Column, q: Column) -> Column:
        """Equal hashes first, then the words themselves."""
        return (p["h"] == q["h"]) & (at(p["at"]) == at(q["at"])) & (at(p["at"] + 1) == at(q["at"] + 1)) & (at(p["at"] + 2) == at(q["at"] + 2))

    def met(x: Column, i: Column) -> Column:
        near = lambda j: F.coalesce(equal(x, F.get("sorted", j)), F.lit(False))
        return near(i + 1) | near(i - 1)

    places = windows.select(
        *[c for c in windows.columns if c not in ("words", "sorted")],
        F.sort_array(F.transform(F.filter("sorted", met), lambda t: t["at"])).alias("places"),
    )
    covered = F.aggregate(
        "places", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")),
        lambda s: s["n"],
    )
    long = lambda c: c.cast("long")
    return places.select(
        "doc_id", *keep, long(F.col("n_words")).alias("n_words"),
        long(F.col("n_chars") - F.col("n_spaces")).alias("word_chars"),
        long(F.col("n_symbols")).alias("n_symbols"), long(F.col("n_dup_lines")).alias("n_dup_lines"),
        long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"), long(F.col("n_lines")).alias("n_lines"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _tail(n: Column, k: Column, p: float) -> Column:
    """ln P(Bin(n, p) <= k), by summing the exact terms in logarithms."""
    first = n * F.log1p(F.lit(-p))

    def add(s: Column, i: Column) -> Column:
        term = s["term"] + F.log(n - i + 1) - F.log(i) + F.log(F.lit(p / (1 - p)))
        top = F.greatest(s["sum"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(F.least(s["sum"], term) - top))).alias("sum"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, F.struct(first.alias("term"), first.alias("sum")), add, lambda s: s["sum"])


def certified(judged: DataFrame, labels: DataFrame, stratum: str = "stratum", risk: float = 0.01, confidence: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff): the strictest certified cutoff of each rule in each stratum."""
    good = labels.filter(F.col("quality") == 1).select(F.col("doc_id").alias("_id")).distinct()
    held = judged.filter(~F.col("base_failed")).join(good, F.col("doc_id") == F.col("_id"), "left_semi")
    tests = [(r, i, F.expr(e) > c, c) for r, (e, cutoffs) in RULES.items() for i, c in enumerate(cutoffs)]
    counts = stage(held.groupBy(stratum).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.when(fails, 1).otherwise(0)).cast("long").alias(f"{r}_{i}") for r, i, fails, _ in tests]
    ), "counts")
    rows = counts.select(stratum, "n", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(float(c)).alias("cutoff"), F.lit(i).alias("strict"), F.col(f"{r}_{i}").alias("k")) for r, i, _, c in tests
    ])).alias("t")).select(stratum, "n", "t.*")
    m = max(1, counts.count() * len(tests))
    passed = rows.filter(_tail(F.col("n"), F.col("k"), risk) <= F.log(F.lit(confidence / m)))
    return passed.groupBy(stratum, "rule").agg(F.max_by("cutoff", "strict").alias("cutoff"))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.01, confidence: float = 0.05) -> DataFrame:
    """Per row of ``docs`` the counts, base_failed, the rules failed at certified cutoffs, and kept."""
    judged = stage(features(docs.withColumn("stratum", F.col(stratum).cast("string")), "stratum"), "quality")
    cutoffs = certified(judged, labels, "stratum", risk, confidence).groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES]
    )
    cutoffs = stage(cutoffs, "cutoffs").withColumnRenamed("stratum", "_stratum")
    small = F.broadcast(cutoffs) if cutoffs.count() <= MOST_BROADCAST else cutoffs
    failed = F.filter(F.array(*[F.when(F.expr(e) > F.col(f"cut_{r}"), F.lit(r)) for r, (e, _) in RULES.items()]), lambda x: x.isNotNull())
    joined = judged.join(small, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    return joined.withColumn("rules_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("rules_failed") == 0)).alias("kept"), F.array_join("rules_failed", ",").alias("rules_failed"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all documents, strata by language."""
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _sql(risk: float = 0.01, confidence: float = 0.05) -> str:
    """op5 in SQL: the same counts from rows of windows, and the binomial tails by the gamma function."""
    tests = [(r, i, e, c) for r, (e, cutoffs) in RULES.items() for i, c in enumerate(cutoffs)]
    counted = ", ".join(f"count(*) FILTER (WHERE {e} > {c}) AS {r}_{i}" for r, i, e, c in tests)
    unpivoted = " UNION ALL ".join(f"SELECT lang, n, '{r}' AS rule, {i} AS strict, {c}::DOUBLE AS cutoff, {r}_{i} AS k FROM ct" for r, i, _, c in tests)
    failed = " || ".join(f"CASE WHEN EXISTS (SELECT 1 FROM cut WHERE rule = '{r}' AND cut.lang IS NOT DISTINCT FROM f.lang AND {e} > cutoff) THEN '{r},' ELSE '' END" for r, (e, _) in RULES.items())
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
p AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 3)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM p) WHERE n > 1),
q AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, i + unnest(range(0, 3)) AS i FROM r) GROUP BY doc_id),
g AS (SELECT d.doc_id, lang, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines, coalesce(q.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN q ON q.doc_id = d.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM g),
ct AS (SELECT lang, count(*) AS n, {counted} FROM f WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) GROUP BY lang),
u AS ({unpivoted}),
v AS (SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}::DOUBLE) + (n - i) * ln(1 - {risk}::DOUBLE)))) AS tail FROM u),
cut AS (SELECT lang, rule, max_by(cutoff, strict) AS cutoff FROM v WHERE tail <= {confidence}::DOUBLE / (SELECT count(*) FROM u) GROUP BY lang, rule),
z AS (SELECT f.*, {failed} AS bad FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad = '' AS kept, rtrim(bad, ',') AS rules_failed FROM z
"""


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLES = {"op5_quality_rules": _sql()}
