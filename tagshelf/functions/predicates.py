"""Filters on map and array columns, as Columns that are never NULL for a non-null input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_has_key(m: Column, key: str) -> Column:
    """The map holds `key`, whatever its value."""
    return F.map_contains_key(m, key)


def json_contains_object(m: Column, pairs: dict) -> Column:
    """The map holds every given key with exactly the given value."""
    same = [F.coalesce(F.try_element_at(m, F.lit(k)) == F.lit(v), F.lit(False)) for k, v in pairs.items()]
    return reduce(lambda a, b: a & b, same, F.lit(True))


def json_contains_array(items: Column, wanted: list) -> Column:
    """The array holds every wanted item."""
    found = [F.coalesce(F.array_contains(items, w), F.lit(False)) for w in wanted]
    return reduce(lambda a, b: a & b, found, F.lit(True))
