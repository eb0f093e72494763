"""Layouts that serve several access paths: rows clustered by several columns at once, and lists of rows by value.

A table has one order, but it is asked by date, by price and by playtime. Each column is ranked by a few range bounds;
the bits of the ranks are interleaved into one number, and rows are written in its order. Rows of a file are then near
each other in all of the columns, so that the minimum and maximum of a file or row group exclude most of them, whichever
column a filter is about. Lists of values (genres, tags) are turned round: one row for each value and game, by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

# A column is ranked into 2 ** BITS ranges.
BITS = 5
CLUSTERED_BY = ["release_date_parsed", "price_usd", "average_playtime_forever"]
LISTED = "genres_and_tags"


def _number(df: DataFrame, column: str) -> Column:
    days = isinstance(df.schema[column].dataType, DateType)
    return (F.unix_date(column) if days else F.col(column)).cast("double")


def range_bounds(df: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list[float]]:
    """For each column of numbers or dates up to 2 ** bits - 1 bounds between ranges of about as many rows.

    One pass with a sketch of bounded size for each partition. The least value always has a range of its own. Equal
    bounds are one; a column without values has none.
    """
    numbers = df.select(*[_number(df, c).alias(c) for c in columns])
    ranges = 1 << bits
    found = numbers.approxQuantile(columns, [i / ranges for i in range(ranges)], 0.25 / ranges)
    return {c: sorted(set(bounds))[: ranges - 1] for c, bounds in zip(columns, found, strict=True)}


def cluster_key(df: DataFrame, bounds: dict[str, list[float]]) -> Column:
    """The interleaved bits of the columns' ranks, the first column's highest; a missing value ranks lowest."""
    bits = max(1, max((len(b).bit_length() for b in bounds.values()), default=1))
    ranks = [
        sum([F.coalesce(_number(df, c) > F.lit(b), F.lit(False)).cast("bigint") for b in own], F.lit(0).cast("bigint"))
        for c, own in bounds.items()
    ]
    parts = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint")), bit * len(ranks) + len(ranks) - 1 - i)
        for i, rank in enumerate(ranks) for bit in range(bits)
    ]
    return sum(parts[1:], parts[0])


def clustered(
    df: DataFrame, columns: list[str], last: str, apart: list[Column] = (), bits: int = BITS, partitions: int | None = None
) -> DataFrame:
    """`df` in ranges of the cluster key, sorted by it. Rows of which a condition in `apart` holds lie apart from the
    others: for conditions that almost every query has. `last`, a key of the rows, divides values that are very frequent
    among several ranges. `partitions`: ranges, by default as many as adaptive execution makes of the size."""
    key = "_cluster"
    flags = [F.coalesce(c, F.lit(False)).cast("string") for c in apart]
    number = cluster_key(df, range_bounds(df, columns, bits))
    keyed = df.withColumn(key, F.struct(F.concat_ws(",", *flags).alias("apart"), number.alias("number")))
    ranges = [partitions] if partitions else []
    return keyed.repartitionByRange(*ranges, key, last).sortWithinPartitions(key, last).drop(key)


def postings(df: DataFrame, column: str, key: str, partitions: int | None = None) -> DataFrame:
    """value and `key`: a row for each different value in a row's list, in order of value and key. NULL and empty lists
    have none. A value that most rows have spans several ranges."""
    values = df.select(F.explode(F.array_distinct(column)).alias("value"), key).filter("value IS NOT NULL")
    ranges = [partitions] if partitions else []
    return values.repartitionByRange(*ranges, "value", key).sortWithinPartitions("value", key)


def having_all(df: DataFrame, lists: DataFrame, values: list[str], key: str) -> DataFrame:
    """Rows of `df` whose list has all of `values`, found through its postings: of these only the values' ranges are read."""
    wanted = sorted(set(values))
    keys = lists.filter(F.col("value").isin(wanted)).groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") == len(wanted))
    return df.join(keys.select(key), key, "left_semi").select(df.columns)
