"""The three relations every operator works on, and their column contracts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Tables(NamedTuple):
    """One row per game, one row per tag, one row per (game, tag) pair."""

    games: DataFrame
    tags: DataFrame
    game_tags: DataFrame


# The columns of the games table as it is published, in their order.
GAME_COLUMNS = [
    "appid", "name", "release_date", "price_usd", "dlc_count", "windows", "mac", "linux",
    "metacritic_score", "achievements", "recommendations", "developers", "publishers",
    "positive_reviews", "negative_reviews", "average_playtime_forever", "median_playtime_forever",
    "peak_ccu", "tags", "genres_and_tags",
]

PRIMARY_KEYS = {"games": ["appid"], "tags": ["tag_id"], "game_tags": ["appid", "tag_id"]}
