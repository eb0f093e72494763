"""Read-only profile of the loaded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagshelf import fixed_values as fv
from tagshelf.operators.clean import date_of, non_game_appids, zero_engagement


def audit_summary(games: DataFrame) -> DataFrame:
    """One row of data quality counts, from one pass over the games."""
    no_reviews = (F.col("positive_reviews") == 0) & (F.col("negative_reviews") == 0)
    return games.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("name").isNull()).alias("null_names"),
        F.count_if(F.col("price_usd").isNull()).alias("null_prices"),
        F.count_if(F.col("peak_ccu") == 0).alias("zero_peak_ccu"),
        F.count_if(F.col("average_playtime_forever") == 0).alias("zero_playtime"),
        F.count_if(no_reviews).alias("no_reviews"),
    )


def audit_price_range(games: DataFrame, low=fv.PRICE_MIN, high=fv.PRICE_MAX) -> DataFrame:
    """Number of prices below and above the plausible range."""
    return games.agg(
        F.count_if(F.col("price_usd") < low).alias("negative_prices"),
        F.count_if(F.col("price_usd") > high).alias(f"prices_above_{high}"),
    )


def top_values(df: DataFrame, column: str, k: int = 40, only_unparsed: bool = False) -> DataFrame:
    """The k most frequent values of a text column, ties by value; optionally only those that no date
    rule accepts."""
    known = df.filter(F.col(column).isNotNull())
    if only_unparsed:
        known = known.filter(date_of(F.col(column)).isNull())
    counted = known.groupBy(column).agg(F.count("*").alias("occurrences"))
    return counted.orderBy(F.col("occurrences").desc(), column).limit(k)


def zero_engagement_count(games: DataFrame) -> DataFrame:
    return zero_engagement(games).agg(F.count("*").alias("zero_engagement_rows_to_delete"))


def zero_engagement_sample(games: DataFrame, k: int = 20) -> DataFrame:
    """k rows that the cleaning will remove, by appid."""
    return zero_engagement(games).select("appid", "name", "release_date", "price_usd").orderBy("appid").limit(k)


def non_game_count(candidates: DataFrame) -> DataFrame:
    return candidates.agg(F.count("*").alias("non_game_rows_to_remove"))


def non_game_review(
    games: DataFrame, game_tags: DataFrame, tags: DataFrame, candidates: DataFrame | None = None, **rules
) -> DataFrame:
    """Every tag row of each candidate, most votes first, for a person to look over."""
    if candidates is None:
        candidates = non_game_appids(games, game_tags, tags, **rules)
    rows = game_tags.join(candidates.select("appid"), "appid", "left_semi")
    return (
        rows.join(games.select("appid", "name", "genres_and_tags"), "appid")
        .join(tags.select("tag_id", "tag_name"), "tag_id")
        .select(
            "appid", "name", "genres_and_tags",
            F.col("tag_name").alias("non_game_tag"), F.col("votes").alias("non_game_tag_votes"),
        )
        .orderBy(F.col("non_game_tag_votes").desc_nulls_first(), "name", "appid", "non_game_tag")
    )


def tag_votes_over(
    games: DataFrame, game_tags: DataFrame, tags: DataFrame, tag_name: str, votes: int
) -> DataFrame:
    """Games that carry the tag with more than the given votes."""
    tag = tags.filter(F.col("tag_name") == tag_name).select("tag_id")
    fitting = game_tags.filter(F.col("votes") > votes).join(tag, "tag_id", "left_semi")
    return games.join(fitting.select("appid"), "appid", "left_semi")
