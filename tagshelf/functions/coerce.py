"""Lenient coercion of loosely typed JSON values. Everything is a Column expression, nothing raises."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a number in text form; Spark's own cast would also take a suffix such as "1d".
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"
_INTEGER = r"^\s*[+-]?\d+\s*$"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with `value` computed once however often it is used, in lambdas too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def coerce_double(text: Column) -> Column:
    """Number in text form to double; anything else, NaN included, to NULL."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def coerce_long(text: Column) -> Column:
    """Number in text form to bigint, decimals cut towards zero; not a number or out of range to NULL.

    The patterns come first, as a cast that fails is slow.
    """
    return F.coalesce(
        F.when(text.rlike(_INTEGER), text.try_cast("bigint")), coerce_double(text).try_cast("bigint")
    )


def coerce_long0(text: Column) -> Column:
    """As `coerce_long`, with 0 for everything that is not a number."""
    return F.coalesce(coerce_long(text), F.lit(0).cast("bigint"))


def json_text(value: Column) -> Column:
    """Text of a VARIANT scalar, NULL for a JSON null."""
    return F.try_variant_get(value, "$", "string")


def json_double(value: Column) -> Column:
    """A VARIANT to double: numbers, booleans as 1 and 0, numbers in text form; else NULL."""
    is_text = F.to_json(value).startswith('"')
    number = F.try_variant_get(value, "$", "double")
    return F.when(is_text, coerce_double(json_text(value))).otherwise(F.when(~F.isnan(number), number))


def json_long0(value: Column) -> Column:
    """A VARIANT to bigint as `coerce_long0`; booleans count as 1 and 0. Integers take the first branch."""
    return F.coalesce(F.try_variant_get(value, "$", "bigint"), coerce_long0(json_text(value)))


def coerce_key(df: DataFrame, key: str, text: Column | None = None) -> DataFrame:
    """Make `key` a bigint and drop the rows where that is not possible."""
    source = F.col(key).cast("string") if text is None else text
    return df.withColumn(key, coerce_long(source)).filter(F.col(key).isNotNull())


def coerce_array(text: Column) -> Column:
    """JSON text of a list to array<string>; any other JSON value to an empty array."""
    return or_empty_array(F.from_json(text, "ARRAY<STRING>"))


def coerce_map(text: Column) -> Column:
    """JSON text of an object to map<string,string>; any other JSON value to an empty map.

    Order and repeated keys are kept as written; `dict_entries` settles the repeats.
    """
    return or_empty_map(F.from_json(text, "MAP<STRING,STRING>"))


def or_empty_array(col: Column) -> Column:
    return F.coalesce(col, F.array().cast("array<string>"))


def or_empty_map(col: Column) -> Column:
    return F.coalesce(col, F.create_map().cast("map<string,string>"))


def coerce_flag(value: Column, absent: bool = True) -> Column:
    """Truth value of a VARIANT: empty and zero values are false, a JSON null is false.

    A key that is not there at all yields `absent`.
    """
    raw = F.to_json(value)
    return (
        F.when(value.isNull(), F.lit(absent))
        .when(raw.isin("true", "false"), raw == "true")
        .when(raw.isin("null", '""', "[]", "{}"), F.lit(False))
        .when(F.substring(raw, 1, 1).isin('"', "[", "{"), F.lit(True))
        .otherwise(raw.try_cast("double") != 0)
    )


def dict_entries(m: Column) -> Column:
    """Entries of a map as an array of (key, value): a repeated key keeps its first place and last value."""
    # Sorted by key and place, a key's entries are a run: its head has the first place, its tail the last value.
    ordered = F.sort_array(F.transform(F.map_entries(m), lambda e, i: F.struct(e["key"].alias("k"), i.alias("i"), e["value"].alias("v"))))
    settled = let(
        ordered,
        lambda es: F.zip_with(
            F.filter(es, lambda e, i: (i == 0) | (e["k"] != F.get(es, i - 1)["k"])),
            F.filter(es, lambda e, i: (i == F.size(es) - 1) | (e["k"] != F.get(es, i + 1)["k"])),
            lambda head, tail: F.struct(head["i"].alias("i"), F.struct(head["k"].alias("key"), tail["v"].alias("value")).alias("e")),
        ),
    )
    keys = F.map_keys(m)
    in_place = F.transform(F.sort_array(settled), lambda x: x["e"])
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_entries(m)).otherwise(in_place)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (`trim` knows only the blank)."""
    # Few texts have any, and a look at both ends costs less than a replacement.
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    return F.when(ends.rlike(r"(?U)\s"), F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")).otherwise(text)


def first_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """The first item of each key, in order of appearance. Sorted by key and place, the first of a key is the head of a
    run; the work grows as that of sorting, however long the list. A list without repeats is left as it is."""

    def settled(xs: Column) -> Column:
        placed = F.transform(xs, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x")))
        heads = let(
            F.sort_array(placed), lambda ps: F.filter(ps, lambda x, i: (i == 0) | (x["k"] != F.get(ps, i - 1)["k"]))
        )
        in_place = F.sort_array(F.transform(heads, lambda x: F.struct(x["i"].alias("i"), x["x"].alias("x"))))
        return F.transform(in_place, lambda x: x["x"])

    return let(items, lambda xs: F.when(F.size(F.array_distinct(F.transform(xs, key))) == F.size(xs), xs).otherwise(settled(xs)))


def merge_genres_and_tags(categories: Column, tag_names: Column) -> Column:
    """Both lists in one: stripped, no empties, no repeats whatever the case; first spelling and order stay."""
    items = F.filter(
        F.transform(F.concat(categories, tag_names), strip), lambda x: x.isNotNull() & (x != "")
    )
    return first_by(items, F.lower)
