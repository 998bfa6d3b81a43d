"""Secret scans by fixed patterns and by two character Markov models, in DataFrame operations only.

Base patterns find three kinds of spans. Beyond them, tokens of 16 or more characters are scored by the
log-likelihood ratio of two first-order character models, one of random strings and one of ordinary identifiers,
trained from labelled tokens; tokens above both thresholds that overlap no base span become spans of kind
``markov``. Where the caller labels enough long ordinary tokens, the threshold for each character is raised until at most one
in a hundred of them passes. Without labelled tokens of their own, callers get the base spans' values as the random strings and the
other tokens of sampled documents as the ordinary ones; both samples have documented bounds, and smoothing makes a
model without samples uniform.

Offsets count code points, ends are exclusive. Defined results: null and empty texts have no spans; an empty table
gives an empty result; repeated rows are scanned each; extra columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.llm._store import stage

#: Fixed patterns: kind, pattern, group whose length counts, its least length.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))
#: Tests that a text must pass before a pattern's places are sought; each holds wherever the pattern has a match that counts.
LIKELY = {"assign": r"(?i:passw|secret|token|api_?key)", "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
#: Maximal runs of 24 hexadecimal characters are the matches of the hex pattern that count.
SOUGHT = {"hex": r"[0-9a-f]{24,}"}

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
SPANS = "array<struct<start:int,end:int,value:string>>"
BLOCK = 256
#: Points in time among the ordinary samples.
TIMES = 2000
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
WORD = r"[A-Za-z0-9+/_=-]{4,}"


def _matches(text: Column, pattern: str, likely: str, group: int) -> Column:
    """Array of (piece, whole, value) of the pattern's matches, left to right without overlap: the text before each, the match, and its group."""
    whole, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.filter(F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), value.alias("value")), lambda x: x["whole"].isNotNull())
    return F.when(text.rlike(likely), zipped).otherwise(F.array().cast("array<struct<piece:string,whole:string,value:string>>"))


def _places(matches: Column) -> Column:
    """Array of (start, end, value) of matches. Growing an array copies it, so they are gathered in blocks and the blocks joined at the end."""
    empty = F.array().cast(SPANS)

    def add(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["piece"])
        end = start + F.length(x["whole"])
        return F.struct(end.alias("at"), F.concat(s["found"], F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("found"))

    def add_block(s: Column, block: Column) -> Column:
        begin = F.struct(F.element_at(s, -1)["at"].alias("at"), empty.alias("found"))
        return F.concat(s, F.array(F.aggregate(block, begin, add)))

    last = F.greatest(F.ceil(F.size(matches) / BLOCK).cast("int") - 1, F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(matches, b * BLOCK + 1, BLOCK))
    gathered = F.aggregate(blocks, F.array(F.struct(F.lit(0).alias("at"), empty.alias("found"))), add_block)
    return F.when(F.size(matches) == 0, empty).otherwise(F.flatten(F.transform(gathered, lambda s: s["found"])))


def _at_least(n: int):
    return lambda x: F.length(x["value"]) >= n


def _span(k: int):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("k"), x["end"].alias("end"), x["value"].alias("value"))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, one array of (start, end, value) for each kind, and ``tokens``, the candidates of the models."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sought = [*[(k, SOUGHT.get(k, p), LIKELY[k], g) for k, p, g, _ in KINDS], ("tokens", TOKEN, TOKEN, 0)]
    matched = text.select("doc_id", *[_matches(F.col("text"), p, likely, g).alias(k) for k, p, likely, g in sought])
    found = matched.select("doc_id", *[_places(F.col(k)).alias(k) for k, *_ in sought])
    return found.select("doc_id", *[F.filter(k, _at_least(n)).alias(k) for k, _, _, n in KINDS], "tokens")


def _pairs(token: Column) -> Column:
    """Array of (a, b): the places in ALPHABET of neighbouring characters; linear in the token's length."""
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.zip_with(F.slice(codes, F.lit(1), F.length(token) - 1), F.slice(codes, F.lit(2), F.length(token) - 1), lambda x, y: F.struct(x.alias("a"), y.alias("b")))


def bigrams(tokens: DataFrame) -> DataFrame:
    """(secret, a, b, n): counts of neighbouring characters of a table (token, secret); at most two alphabets squared of rows."""
    pairs = tokens.filter(F.length("token") > 1).select("secret", F.explode(_pairs(F.col("token"))).alias("p")).select("secret", "p.a", "p.b")
    return pairs.filter("a > 0 and b > 0").groupBy("secret", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def trained(tokens: DataFrame, smooth: float = 0.5, back: float = 4.0) -> list[float]:
    """ln P(b | a, random) - ln P(b | a, ordinary) at place (a - 1) * len(ALPHABET) + b - 1.

    A pair's probability backs off to its second character's own, with the weight of ``back`` observations.
    """
    size = len(ALPHABET)
    counts = {True: [[0] * size for _ in range(size)], False: [[0] * size for _ in range(size)]}
    for secret, a, b, n in bigrams(tokens).collect():
        counts[bool(secret)][a - 1][b - 1] += n

    def logs(rows: list[list[int]]) -> list[float]:
        every = sum(map(sum, rows)) + smooth * size
        single = [(sum(row[b] for row in rows) + smooth) / every for b in range(size)]
        return [math.log((row[b] + back * single[b]) / (sum(row) + back)) for row in rows for b in range(size)]

    return [x - y for x, y in zip(logs(counts[True]), logs(counts[False]), strict=True)]


def ratio(token: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of a token over ALPHABET."""
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    return F.aggregate(_pairs(token), F.lit(0.0), lambda s, p: s + F.get(table, (p["a"] - 1) * len(ALPHABET) + p["b"] - 1))


def cutoff(tokens: DataFrame, model: list[float], least: float, share: float = 0.99, enough: int = 100) -> float:
    """The ratio for each character that ``share`` of the ordinary tokens of a candidate's length stay below, ``least`` at least; with fewer than ``enough`` of them, ``least``."""
    each = tokens.filter(~F.col("secret") & F.col("token").rlike(f"^{TOKEN}$")).select((ratio(F.col("token"), model) / F.length("token")).alias("x"))
    r = each.agg(F.count("x").alias("n"), F.percentile("x", F.lit(share)).alias("p")).first()
    return max(least, r.p) if r.n >= enough else least


def samples(docs: DataFrame, found: DataFrame, most: int = 4000, ordinary: int = 1000) -> DataFrame:
    """Labelled tokens: base values of at most ``most`` documents, and other tokens of at most ``ordinary`` documents, both in the order of a hash of doc_id."""
    with_spans = found.filter(" or ".join(f"size({k}) > 0" for k, *_ in KINDS)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    secret = with_spans.select(F.explode(F.concat(*[F.transform(k, lambda x: x["value"]) for k, *_ in KINDS])).alias("token"), F.lit(True).alias("secret"))
    ids = found.select(F.col("doc_id").alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(ordinary)
    text = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("_id"), "left_semi").select(F.coalesce("text", F.lit("")).alias("t"))
    for k, p, _, _ in KINDS:
        text = text.select(F.regexp_replace("t", SOUGHT.get(k, p), " ").alias("t"))
    plain = text.select(F.explode(F.regexp_extract_all("t", F.lit(WORD), F.lit(0))).alias("token"), F.lit(False).alias("secret"))
    # Points in time, of which texts may have none, are ordinary too.
    times = docs.sparkSession.range(TIMES).select(F.date_format(F.timestamp_seconds(F.col("id") * 1_234_567 % 2_000_000_000), "yyyy-MM-dd'T'HH-mm-ss").alias("token"), F.lit(False).alias("secret"))
    return secret.unionByName(plain).unionByName(times)


def secrets(docs: DataFrame, labelled: DataFrame | None = None, least: float = 8.0, least_each: float = 0.5) -> DataFrame:
    """Per row of ``docs``: doc_id, counts by kind, and ``found``, all spans as (start, kind, end, value) in order."""
    docs = docs.select("doc_id", "text")
    found = stage(base_spans(docs), "secrets")
    model = trained(samples(docs, found) if labelled is None else labelled)
    # Tokens that no base pattern finds are taken for ordinary ones, random strings among them: they set no threshold.
    each = least_each if labelled is None else cutoff(labelled, model, least_each)
    base = F.concat(*[F.transform(k, _span(i)) for i, (k, *_) in enumerate(KINDS)])
    free = found.withColumn("base", F.array_sort(base)).withColumn(
        "tokens", F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    )
    score = lambda t: ratio(t["value"], model)
    scored = free.withColumn("scored", F.transform("tokens", lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("k"), t["end"].alias("end"), t["value"].alias("value"), score(t).alias("score"))))
    hits = F.filter("scored", lambda t: (t["score"] >= least) & (t["score"] >= each * (t["end"] - t["start"])))
    added = F.transform(hits, _span(len(KINDS)))
    return scored.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k, *_ in KINDS], F.size(hits).cast("long").alias("n_markov"), "base", F.array_sort(F.concat("base", added)).alias("found")
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k, *_ in KINDS], F.lit("markov"))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op3_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all documents."""
    return secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"), "n_markov"
    )


QUERIES = {"op3_markov_secrets": op3_markov_secrets}
ORACLES: dict[str, str] = {}
