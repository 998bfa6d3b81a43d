"""What a run measures, and the messages it sends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.schemas import METRIC, TRACKING

#: Bucket edges of the change of the top score by reranking.
EDGES = (-1.0, -0.5, -0.25, -0.1, -0.05, 0.0, 0.05, 0.1, 0.25, 0.5, 1.0)
#: The metrics that refresh runs write: step, name and kind.
MEASURED = (
    ("read", "documents", "counter"),
    ("dedup", "documents_new", "counter"),
    ("dedup", "share_known", "gauge"),
    ("chunk", "chunks", "counter"),
    ("chunk", "chunks_a_document", "gauge"),
    ("embed", "embedding_dollars", "counter"),
    ("write", "points_written", "counter"),
    ("write", "points_lost", "counter"),
    ("evaluate", "recall_at_5", "gauge"),
    ("evaluate", "mrr", "gauge"),
    ("evaluate", "milliseconds_a_query", "gauge"),
    ("evaluate", "points_expired", "gauge"),
    ("forecast", "dollars_a_month", "gauge"),
)
KINDS = {name: (step, kind) for step, name, kind in MEASURED}


def rows(spark: SparkSession, run_id: str, values: dict[str, float], now) -> DataFrame:
    """Metric rows to append; names that no step measures raise."""
    if unknown := sorted(set(values) - set(KINDS)):
        raise ValueError(f"no step measures {', '.join(unknown)}")
    return spark.createDataFrame([(run_id, KINDS[k][0], k, KINDS[k][1], float(v)) for k, v in values.items()], METRIC.rsplit(",", 1)[0]).withColumn("ts", now)


def totals(metrics: DataFrame) -> DataFrame:
    """(name, kind, value): counters summed over runs, gauges as last set."""
    return metrics.groupBy("name", "kind").agg(F.when(F.first("kind") == "counter", F.sum("value")).otherwise(F.max_by("value", F.struct("ts", "run_id"))).alias("value"))


def histogram(values: DataFrame, value: str, edges: tuple[float, ...] = EDGES) -> DataFrame:
    """(le, n): cumulative counts at each edge and at infinity, in one aggregation."""
    counts = values.agg(*[F.count_if(F.col(value) <= e).alias(f"b{i}") for i, e in enumerate(edges)], F.count(value).alias("all"))
    pairs = [F.struct(F.lit(e).alias("le"), F.col(f"b{i}").alias("n")) for i, e in enumerate(edges)] + [F.struct(F.lit(float("inf")).alias("le"), F.col("all").alias("n"))]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.le", "p.n")


def tracked(spark: SparkSession, run_id: str, parameters: dict, values: dict[str, float], tags: dict[str, str], now) -> DataFrame:
    """Rows (run_id, kind, key, text, value, ts) that keep a run's parameters, measures and tags."""
    found = [(run_id, "parameter", k, str(v), None) for k, v in parameters.items()] + [(run_id, "measure", k, None, float(v)) for k, v in values.items()] + [(run_id, "tag", k, str(v), None) for k, v in tags.items()]
    return spark.createDataFrame(found, TRACKING.rsplit(",", 1)[0]).withColumn("ts", now)


def latest_tracked(tracking: DataFrame) -> DataFrame:
    """The last row of each run, kind and key."""
    last = F.max_by(F.struct("text", "value"), "ts")
    return tracking.groupBy("run_id", "kind", "key").agg(last.alias("l")).select("run_id", "kind", "key", "l.text", "l.value")


def _percent(x: Column) -> Column:
    return F.concat(F.format_string("%.1f", (100 * x).cast("double")), F.lit(" %"))


def finished_message(decision: Column, n_documents: Column, recall_5: Column, mrr: Column) -> Column:
    """One line for a run that ended."""
    return F.concat(F.lit("Run ended: "), decision, F.lit(". "), n_documents.cast("string"), F.lit(" documents read; the first five results hold "), _percent(recall_5), F.lit(" of what is expected (mean reciprocal rank "), F.format_string("%.3f", mrr.cast("double")), F.lit(")."))


def held_back_message(recall_5: Column, threshold: Column) -> Column:
    """One line for a version that the gate held back."""
    return F.concat(F.lit("New version held back: recall in five is "), _percent(recall_5), F.lit(", and "), _percent(threshold), F.lit(" is asked for. Searches still use the version before."))


def failed_message(step: Column, error: Column) -> Column:
    return F.concat(F.lit("Step "), step, F.lit(" failed: "), error)


def notify(message: str, send: Callable[[str], None] | None) -> bool:
    """Hands the message to ``send``; without one, or if sending fails, the run goes on and False says so."""
    try:
        if send is not None:
            send(message)
        return send is not None
    except Exception:  # noqa: BLE001  a message that is lost stops no run
        return False
