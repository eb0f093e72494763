"""From raw records to the games table, the tag dimension and the bridge between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagshelf.fixed_values import COUNTS, FLAGS, TEST_NAME
from tagshelf.functions.coerce import (
    coerce_flag, coerce_key, coerce_long0, dict_entries, first_by, json_double, json_long0,
    merge_genres_and_tags, or_empty_array, or_empty_map, strip,
)
from tagshelf.sources.shared import write_through

RENAMED = {"price": "price_usd", "positive": "positive_reviews", "negative": "negative_reviews"}


def coerce_records(raw: DataFrame, absent_flag: bool = True) -> DataFrame:
    """Typed columns out of loosely typed records; rows without a usable appid are dropped."""
    entries = dict_entries(or_empty_map(F.col("tags")))
    votes = F.transform(
        entries, lambda e: F.struct(e["key"].alias("key"), votes_of(e["value"]).alias("value"))
    )
    typed = raw.withColumns(
        {
            "price": json_double(F.col("price")),
            **{c: json_long0(F.col(c)) for c in COUNTS},
            **{c: coerce_flag(F.col(c), absent_flag) for c in FLAGS},
            **{c: or_empty_array(F.col(c)) for c in ("developers", "publishers", "categories")},
            "tags": F.map_from_entries(votes),
        }
    )
    return coerce_key(typed, "appid")


def votes_of(text: Column) -> Column:
    """Votes from the raw text of a JSON value, 0 if it is not a number."""
    return coerce_long0(F.when(text == "true", "1").when(text == "false", "0").otherwise(text))


def is_test_name(name: Column) -> Column:
    return F.coalesce(name.rlike(TEST_NAME), F.lit(False))


def is_zero_signal(ccu="peak_ccu", positive="positive", negative="negative") -> Column:
    return (F.col(ccu) == 0) & (F.col(positive) == 0) & (F.col(negative) == 0)


def drop_junk(games: DataFrame, positive="positive", negative="negative") -> DataFrame:
    """Keep named entries that are no test entries and show at least one sign of life."""
    return games.filter(
        F.col("name").isNotNull()
        & ~is_test_name(F.col("name"))
        & ~is_zero_signal(positive=positive, negative=negative)
    )


def shape_games(typed: DataFrame) -> DataFrame:
    """Merge categories and tag names into one list and settle the column names."""
    merged = merge_genres_and_tags(F.col("categories"), F.map_keys("tags"))
    return typed.withColumn("genres_and_tags", merged).drop("categories").withColumnsRenamed(RENAMED)


def build_bridge(games: DataFrame) -> DataFrame:
    """One row per (appid, tag_name) with votes: names stripped, empty ones dropped, the first one stays.

    Repeats inside a record go before the shuffle. Repeats across records of one appid are settled by
    `record_ord`, the order of the records, in an aggregate that combines on the map side; without that column, as in
    tables that have each appid once, by the smallest votes.
    """
    ordered = "record_ord" in games.columns
    if not ordered:
        games = games.withColumn("record_ord", F.lit(0))
    stripped = F.transform(
        F.map_entries("tags"), lambda e: F.struct(strip(e["key"]).alias("name"), e["value"].alias("votes"))
    )
    named = F.filter(stripped, lambda t: t["name"] != "")
    return (
        games.select("appid", "record_ord", named.alias("t"))
        .select("appid", "record_ord", F.explode(first_by(F.col("t"), lambda t: t["name"])).alias("t"))
        .groupBy("appid", F.col("t.name").alias("tag_name"))
        .agg((F.min_by("t.votes", "record_ord") if ordered else F.min("t.votes")).alias("votes"))
    )


def require_non_empty(bridge: DataFrame, sample: DataFrame) -> DataFrame:
    """Fail with five rows of `sample` if nothing came through."""
    if bridge.isEmpty():
        shown = [row.asDict() for row in sample.limit(5).collect()]
        raise ValueError(f"no tags parsed, sample of the input: {shown}")
    return bridge


def number_names(names: DataFrame, name: str, key: str) -> DataFrame:
    """Add dense ids from 1 in the order of `name` (unique, codepoint order) without a global sort task.

    Rows are split into ranges of names and written once, so that the range of each row is fixed data.
    An id is then the place within the range plus the sizes of the ranges before it. The only
    broadcast is one row per range.
    """
    ranges = write_through(
        names.repartitionByRange(name).withColumn("_range", F.spark_partition_id()), "names"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(name))
    return (
        ranges.join(F.broadcast(offsets), "_range")
        .withColumn(key, (F.col("_offset") + place).cast("bigint"))
        .drop("_range", "_offset")
    )


def build_tags(bridge: DataFrame) -> DataFrame:
    """The tag dimension: ids in name order and the number of games per tag.

    The bridge holds each (appid, tag_name) once, so counting rows counts distinct games.
    """
    counted = bridge.groupBy("tag_name").agg(F.count("*").alias("game_count"))
    return number_names(counted, "tag_name", "tag_id").select("tag_id", "tag_name", "game_count")


def lookup_tag_ids(bridge: DataFrame, tags: DataFrame) -> DataFrame:
    """Replace tag names by tag ids; a small written dimension is broadcast by the planner."""
    return bridge.join(tags.select("tag_name", "tag_id"), "tag_name").select("appid", "tag_id", "votes")
