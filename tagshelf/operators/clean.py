"""Cleaning: implausible prices, dates, dead entries, non-games, orphans. Pure DataFrame functions.

Plain Parquet tables know no UPDATE or DELETE, so every rule returns a new DataFrame and the result is
published once, as a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf import fixed_values as fv
from tagshelf.sources.shared import dealt


def null_out_of_range(df: DataFrame, column: str, low=fv.PRICE_MIN, high=fv.PRICE_MAX) -> DataFrame:
    """Values outside [low, high] become NULL."""
    return df.withColumn(column, F.when(F.col(column).between(low, high), F.col(column)))


def date_of(text: Column, rules=fv.DATE_RULES) -> Column:
    """First rule whose pattern matches and whose format gives a real date; else NULL."""
    return F.coalesce(*[F.when(text.rlike(p), F.try_to_date(text, f)) for p, f in rules])


def parse_dates(games: DataFrame, rules=fv.DATE_RULES) -> DataFrame:
    """Add `release_date_parsed`."""
    return games.withColumn("release_date_parsed", date_of(F.col("release_date"), rules))


def date_rejects(games: DataFrame, rules=fv.DATE_RULES) -> DataFrame:
    """Texts that look like a date but are none, with their number of rows."""
    text = F.col("release_date")
    looks = F.lit(False)
    for pattern, _ in rules:
        looks = looks | text.rlike(pattern)
    return games.filter(looks & date_of(text, rules).isNull()).groupBy("release_date").agg(
        F.count("*").alias("occurrences")
    )


def is_zero_engagement() -> Column:
    """No playtime on either measure and no reviews on either side."""
    unplayed = (F.col("average_playtime_forever") == 0) & (F.col("median_playtime_forever") == 0)
    return unplayed & (F.col("positive_reviews") == 0) & (F.col("negative_reviews") == 0)


def zero_engagement(games: DataFrame) -> DataFrame:
    return games.filter(is_zero_engagement())


def drop_zero_engagement(games: DataFrame) -> DataFrame:
    return games.filter(~F.coalesce(is_zero_engagement(), F.lit(False)))


def non_game_appids(
    games: DataFrame,
    game_tags: DataFrame,
    tags: DataFrame,
    non_game_tags=fv.NON_GAME_TAGS,
    game_indicator_tags=fv.GAME_INDICATOR_TAGS,
    min_votes: int = fv.MIN_NON_GAME_VOTES,
) -> DataFrame:
    """Appids with a non-game tag of at least `min_votes` votes and no game-indicator tag at all.

    Both conditions come out of one aggregate per appid over the bridge rows that carry a listed tag,
    instead of a join for the first and an anti join for the second.
    """
    name = F.col("tag_name")
    listed = tags.filter(name.isin([*non_game_tags, *game_indicator_tags])).select(
        "tag_id", name.isin(list(non_game_tags)).alias("non_game"),
        name.isin(list(game_indicator_tags)).alias("indicator"),
    )
    verdicts = game_tags.join(listed, "tag_id").groupBy("appid").agg(
        F.bool_or(F.col("non_game") & (F.col("votes") >= min_votes)).alias("suspect"),
        F.bool_or("indicator").alias("cleared"),
    )
    suspects = verdicts.filter(F.col("suspect") & ~F.col("cleared")).select("appid")
    return suspects.join(games.select("appid"), "appid", "left_semi")


def guard_max_rows(df: DataFrame, max_rows: int | None = fv.MAX_NON_GAME_ROWS) -> int:
    """Number of rows of `df`, or an error if there are more than `max_rows`; None is no limit.

    A plain distributed count: a limit would move up to `max_rows` rows into one task.
    """
    n = df.count()
    if max_rows is not None and n > max_rows:
        raise ValueError(
            f"{n} rows would be removed, more than {max_rows}; review the candidates, then change the "
            "tag lists, the votes threshold or the limit"
        )
    return n


def anti(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of `df` whose `column` is not among `keys`."""
    return df.join(keys.select(column), column, "left_anti").select(df.columns)


def semi(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of `df` whose `column` is among `keys`."""
    return df.join(keys.select(column), column, "left_semi").select(df.columns)


def prune_orphan_bridge(game_tags: DataFrame, games: DataFrame) -> DataFrame:
    """Bridge rows whose game is still there."""
    return semi(game_tags, games, "appid")


def prune_orphan_tags(tags: DataFrame, game_tags: DataFrame) -> DataFrame:
    """Tags still in use. The bridge is reduced to its distinct tags before it is shuffled."""
    return semi(tags, game_tags.select("tag_id").distinct(), "tag_id")


def games_per_tag(game_tags: DataFrame, assume_unique: bool = False) -> DataFrame:
    """Distinct games per tag. Unless the keys are checked, pairs are dealt and made distinct first."""
    if assume_unique:
        return game_tags.groupBy("tag_id").agg(F.count("*").alias("game_count"))
    pairs = dealt(game_tags.select("appid", "tag_id"), "appid", "tag_id").distinct()
    return pairs.groupBy("tag_id").agg(F.count("appid").alias("game_count"))


def recount_tags(tags: DataFrame, game_tags: DataFrame, assume_unique: bool = False) -> DataFrame:
    """Set `game_count` to the number of distinct games in the bridge, 0 for an unused tag."""
    return (
        tags.drop("game_count")
        .join(games_per_tag(game_tags, assume_unique), "tag_id", "left")
        .withColumn("game_count", F.coalesce("game_count", F.lit(0).cast("bigint")))
    )


def refresh_tags(tags: DataFrame, game_tags: DataFrame, assume_unique: bool = False) -> DataFrame:
    """Prune and recount in one: the inner join with the counts leaves out the unused tags."""
    return tags.drop("game_count").join(games_per_tag(game_tags, assume_unique), "tag_id")
