"""Adapter: order tables in the shape of a game catalogue.

An order stands for a game, its priority and status for genres, the brand and the type of a part for
tags, and a line item ties them together; the votes of a tag are the quantity ordered under it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagshelf.operators.shaping import build_tags, lookup_tag_ids
from tagshelf.sources.shared import write_through
from tagshelf.tables import Tables

# Which part types and brands stand for non-game and game-indicator tags.
STAR_NON_GAME_TAGS = ["PROMO", "ECONOMY"]
STAR_GAME_INDICATOR_TAGS = [f"Brand#{i}" for i in range(1, 13)]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("appid") % n == 0


def star_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One game per order; measures are sums over its lines, 0 without any."""
    quantity = F.col("l_quantity")
    lines = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("appid")).agg(
        F.sum(quantity).cast("bigint").alias("q"),
        F.count("*").alias("n"),
        F.sum(F.when(F.col("l_linestatus") == "F", quantity)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col("l_returnflag") == "R", quantity)).cast("bigint").alias("neg"),
    )
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("appid"), "o_totalprice", F.col("o_orderdate").cast("date").alias("day"),
        F.array("o_orderpriority", "o_orderstatus").alias("genres_and_tags"),
    )
    sums = orders.join(lines, "appid", "left").na.fill(0, ["q", "n", "pos", "neg"])
    price = (
        F.when(_every(101), -1.0).when(_every(103), 1500.0).when(_every(13), F.lit(None).cast("double"))
        .when(_every(7), 0.0).otherwise(F.round((F.col("o_totalprice") / 5000).cast("decimal(18,8)"), 2))
    )
    text = (
        F.when(_every(11), "Coming soon").when(_every(17), "Feb 30, 2000")
        .when(_every(10), F.date_format("day", "yyyy-MM-dd"))
        .otherwise(F.date_format("day", "MMM d, yyyy"))
    )
    prefix = F.when(_every(50), "Order Test ").otherwise("Order ")
    return sums.select(
        "appid",
        F.concat(prefix, F.col("appid").cast("string")).alias("name"),
        text.alias("release_date"),
        price.cast("double").alias("price_usd"),
        (F.col("n") * 7).alias("achievements"),
        F.col("pos").alias("positive_reviews"),
        F.col("neg").alias("negative_reviews"),
        (F.col("q") * 10).alias("average_playtime_forever"),
        (F.col("q") * 8).alias("median_playtime_forever"),
        F.col("n").alias("peak_ccu"),
        "genres_and_tags",
    )


def star_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity per order and tag name."""
    parts = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.array("p_brand", "p_type").alias("names")
    )
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (
        lines.join(parts, "l_partkey")
        .select(F.col("l_orderkey").alias("appid"), F.explode("names").alias("tag_name"), "l_quantity")
        .groupBy("appid", "tag_name")
        .agg(F.sum("l_quantity").cast("bigint").alias("votes"))
    )


def star_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The three tables. The bridge is computed once, since the tag dimension is made from it."""
    named = write_through(star_bridge(spark, sf_dir), "bridge")
    tags = write_through(build_tags(named), "tags")
    return Tables(star_games(spark, sf_dir), tags, lookup_tag_ids(named, tags))
