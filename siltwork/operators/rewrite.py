"""Query expansion by rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Acronyms and their expansions, in the order of their variations.
ACRONYMS = (
    ("pto", "paid time off"),
    ("ppo", "preferred provider organization"),
    ("hmo", "health maintenance organization"),
    ("faq", "frequently asked questions"),
    ("rsu", "restricted stock unit"),
    ("okr", "objectives and key results"),
    ("api", "application programming interface"),
    ("vpn", "virtual private network"),
    ("hr", "human resources"),
    ("it", "information technology"),
)
WORD_CHARS = r"[\p{L}\p{N}_]+"


def variations(query: Column, word_boundary: bool = False) -> Column:
    """The query and, for each acronym among its words, the expanded and the alternative form; each once, in order.

    Every occurrence in the lower-cased query is replaced, inside words too, unless ``word_boundary``.
    """
    lower = F.lower(query)
    found = F.regexp_extract_all(lower, F.lit(WORD_CHARS), F.lit(0))

    def put(acronym: str, by: str) -> Column:
        if word_boundary:
            return F.regexp_replace(lower, rf"(?<![\p{{L}}\p{{N}}_]){acronym}(?![\p{{L}}\p{{N}}_])", by)
        return F.replace(lower, F.lit(acronym), F.lit(by))

    more = [F.when(F.array_contains(found, a), F.array(put(a, e), put(a, f"{a} OR {e}"))).otherwise(F.array().cast("array<string>")) for a, e in ACRONYMS]
    return F.array_distinct(F.concat(F.array(query), *more))


def rewritten(queries: DataFrame, provider: Callable[[str, int], list[str]] | None = None, most: int = 3) -> DataFrame:
    """Queries (query_id, query) with ``variations``, each once and the query first, and ``n_added``.

    A provider, such as a language model, gives at most ``most`` for a query; where it fails the query stands alone.
    Without one the rules apply.
    """
    if provider is None:
        rows = queries.select("query_id", "query", variations(F.col("query")).alias("variations"))
    else:

        def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                found = []
                for query in frame["query"]:
                    try:
                        found.append([str(v) for v in provider(query, most)][:most])
                    except Exception:  # noqa: BLE001  a provider that fails adds nothing
                        found.append([])
                yield frame.assign(given=found)

        rows = queries.select("query_id", "query").mapInPandas(ask, "query_id long, query string, given array<string>")
        rows = rows.select("query_id", "query", F.array_distinct(F.concat(F.array("query"), "given")).alias("variations"))
    return rows.withColumn("n_added", F.size("variations") - 1)
