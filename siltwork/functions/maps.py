"""Map expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def merged(*maps: Column) -> Column:
    """One map of several; of a key that more than one has, the last value counts. A null map has no keys."""
    empty = F.create_map().cast("map<string,string>")
    return reduce(lambda a, b: F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b), [F.coalesce(m, empty) for m in maps])


def shown(entries: Column) -> Column:
    """The entries as key=value in order of key, joined by commas; null values are empty."""
    return F.array_join(F.transform(F.array_sort(F.map_keys(entries)), lambda k: F.concat(k, F.lit("="), F.coalesce(F.element_at(entries, k), F.lit("")))), ",")
