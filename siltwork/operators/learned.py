"""Re-scoring by a model that is learned from queries whose right results are known.

Candidates have features (sparse and dense scores, shared words, shared runs of three words, length), and beside these,
which see no case, the words and runs that are shared as they are written: they alone tell a passage from its copies in
another case. A linear score is fitted so that a query's right results come before its others: each other result, less
the mean of the right ones, is an example of a wrong order, its negative one of a right order, so a query gives as many
examples as it has candidates. The fit is Spark's logistic regression without an intercept. Queries without a right or a
wrong candidate teach nothing; without any that does, all weights are 0 and the candidates keep their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.functions.text import tokens, words
from siltwork.functions.vectors import cosine
from siltwork.operators import bm25, dense, hybrid
from siltwork.store import stage

FEATURES = ("sparse", "dense", "lexical", "phrase", "length")
#: Those that see a text as it is written.
WRITTEN = ("words", "runs")


def runs_of(t: Column) -> Column:
    """The distinct runs of three of an array of tokens; the array is not evaluated again for each run."""
    many = F.greatest(F.size(t) - 2, F.lit(0))
    join = lambda x, y: F.concat_ws(" ", x, y)
    return F.array_distinct(F.zip_with(F.zip_with(F.slice(t, F.lit(1), many), F.slice(t, F.lit(2), many), join), F.slice(t, F.lit(3), many), join))


def _share(own: Column, other: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(own, other)), F.size(own)), F.lit(0.0))


def phrase_score(query: Column, text: Column) -> Column:
    """Share of the query's distinct runs of three tokens that the text has."""
    return _share(runs_of(tokens(query)), runs_of(tokens(text)))


def candidates(queries: DataFrame, docs: DataFrame, vectors: DataFrame, asked: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, id, FEATURES, WRITTEN) of the best ``k`` by words and the best ``k`` by vectors; queries (query_id, query), docs (id, text), vectors (id, embedding), asked (query_id, embedding)."""
    near = stage(dense.top_k(vectors, asked, k), "near")
    sparse = bm25.nearest(bm25.index(docs), queries, k, near)
    found = sparse.select("query_id", "id").unionByName(near.select("query_id", "id")).distinct()
    found = found.join(sparse.select("query_id", "id", F.col("norm").alias("sparse")), ["query_id", "id"], "left").join(near.select("query_id", "id", F.col("score").alias("dense")), ["query_id", "id"], "left")
    found = stage(found, "found")
    texts = docs.join(found.select("id").distinct(), "id", "left_semi")  # few, so that the others need no shuffle
    rest = found.filter("dense is null").select("query_id", "id")  # found by words alone: their score by vectors is not 0 for that
    own = vectors.join(rest.select("id").distinct(), "id", "left_semi").select("id", "embedding")
    rest = rest.join(own, "id").join(asked.select("query_id", F.col("embedding").alias("_asked")), "query_id").select("query_id", "id", cosine(F.col("embedding"), F.col("_asked")).alias("_dense"))
    found = found.join(rest, ["query_id", "id"], "left").withColumn("dense", F.coalesce("dense", "_dense")).drop("_dense")
    rows = found.join(queries, "query_id").join(texts, "id")
    made = {"lexical": hybrid.lexical_score(F.col("query"), F.col("text")), "phrase": phrase_score(F.col("query"), F.col("text")), "length": F.log1p(F.size(tokens(F.col("text"))).cast("double"))}
    written = {"words": _share(F.array_distinct(words(F.col("query"))), words(F.col("text"))), "runs": _share(runs_of(words(F.col("query"))), runs_of(words(F.col("text"))))}
    return rows.withColumns(made | written).select("query_id", "id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in FEATURES + WRITTEN])


def examples(rows: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """(query_id, features, label): differences between the mean right candidate of a query and each wrong one, both ways; rows: query_id, features, right."""
    mean = rows.filter("right").groupBy(F.col("query_id").alias("_q")).agg(*[F.avg(c).alias(f"_{c}") for c in features])
    wrong = rows.filter(~F.col("right")).join(mean, F.col("query_id") == F.col("_q"))
    sides = [wrong.select("query_id", *[(sign * (F.col(f"_{c}") - F.col(c))).alias(c) for c in features], F.lit(float(sign > 0)).alias("label")) for sign in (1, -1)]
    return sides[0].unionByName(sides[1])


def fit(rows: DataFrame, ridge: float = 0.01, features: tuple[str, ...] = FEATURES) -> list[float]:
    """A weight for each feature."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    made = stage(examples(rows, features), "examples")
    if not made.limit(1).count():
        return [0.0] * len(features)
    model = LogisticRegression(fitIntercept=False, regParam=ridge, maxIter=100).fit(VectorAssembler(inputCols=list(features), outputCol="features").transform(made))
    return [float(x) for x in model.coefficients]


def scored(rows: DataFrame, weights: list[float], features: tuple[str, ...] = FEATURES) -> DataFrame:
    total = F.lit(0.0)
    for w, c in zip(weights, features, strict=True):
        total = total + F.lit(w) * F.col(c)
    return rows.withColumn("learned", total)


def ranked(rows: DataFrame, by: str, k: int = 10, digits: int = 6) -> DataFrame:
    """(query_id, id, rank) of the best by a column; ties go to the higher sparse score, then by id."""
    order = Window.partitionBy("query_id").orderBy(F.round(by, digits).desc(), F.round("sparse", digits).desc(), F.col("id").asc())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "id", "rank")
