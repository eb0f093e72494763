"""Integrity checks as queries for violations, and table statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagshelf.operators.clean import semi
from tagshelf.tables import Tables

HISTOGRAMS = "spark.sql.statistics.histogram.enabled"
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def check_pk(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that are repeated or incomplete, with their number of rows, from one aggregate.

    A hot key is combined on the map side before it is shuffled.
    """
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    counted = df.groupBy(*columns).agg(F.count("*").alias("n_rows"))
    return counted.filter((F.col("n_rows") > 1) | incomplete)


def check_fk(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Values of the child without a parent, with their number of rows; NULL needs no parent.

    The child is reduced to its distinct values first, so a value shared by a third of its rows costs
    one row per task in the join.
    """
    keys = parent.select(F.col(parent_column or column).alias(column))
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return values.join(keys, column, "left_anti")


def cascade(parent: DataFrame, child: DataFrame, column: str) -> DataFrame:
    """Rows of the child that remain once rows of the parent are gone."""
    return semi(child, parent, column)


def analyze(spark: SparkSession, table: str) -> None:
    """Refresh the statistics of a catalog table that the cost-based planner uses, with histograms of its columns."""
    before = spark.conf.get(HISTOGRAMS)
    spark.conf.set(HISTOGRAMS, "true")
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    finally:
        spark.conf.set(HISTOGRAMS, before)


def exact_distinct(tables: Tables) -> DataFrame:
    """table_name, column_name and n_distinct of each column but lists and maps: an aggregate for each column."""
    found = []
    for name, df in tables._asdict().items():
        for f in df.schema.fields:
            if not f.dataType.simpleString().startswith(("array", "map", "struct")):
                counted = df.agg(F.count_distinct(f.name).alias("n_distinct"))
                found.append(counted.select(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"), "n_distinct"))
    return reduce(DataFrame.unionByName, found)


def statistics(tables: Tables) -> DataFrame:
    """For each column of each table: n_rows, n_null, n_distinct (about), min_value and max_value as text, and for numbers
    and dates (in days) the bounds of ten ranges of about as many rows. Columns of lists and maps have the first two only.

    An aggregate for each column, whose buffers are of bounded size: who reads some of these figures pays for no other.
    """
    found = []
    for name, df in tables._asdict().items():
        for f in df.schema.fields:
            kind, value = f.dataType.simpleString(), F.col(f.name)
            plain = not kind.startswith(("array", "map", "struct"))
            number = F.unix_date(value) if kind == "date" else value if kind in NUMBERS else None
            deciles = F.percentile_approx(number.cast("double"), [i / 10 for i in range(1, 10)], 1000) if number is not None else F.lit(None)
            text = lambda v: v.cast("string") if plain else F.lit(None).cast("string")  # noqa: B023, E731
            own = df.agg(
                F.count("*").alias("n_rows"), F.count_if(value.isNull()).alias("n_null"),
                (F.approx_count_distinct(value, 0.01) if plain else F.lit(None)).cast("bigint").alias("n_distinct"),
                text(F.min(value) if plain else value).alias("min_value"), text(F.max(value) if plain else value).alias("max_value"),
                deciles.cast("array<double>").alias("deciles"),
            )
            found.append(own.select(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"), "*"))
    return reduce(DataFrame.unionByName, found)


def first_violations(checks: dict[str, tuple[DataFrame, list[str]]], most: int = 5) -> DataFrame:
    """what and the first `most` violations as JSON texts, in their order, of every check that does not hold, in one plan.

    A check is a DataFrame of violations and the columns they are ordered by. Each partition keeps `most` of them, so
    that however many there are, few are moved.
    """
    parts = []
    for what, (df, order) in checks.items():
        text = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
        top = df.select(F.lit(what).alias("what"), F.struct(*order, text.alias("text")).alias("row")).orderBy("row").limit(most)
        parts.append(top.select("what", F.col("row.text").alias("text")))
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy("what").agg(F.sort_array(F.collect_list("text")).alias("violations"))


def is_played() -> Column:
    return F.col("average_playtime_forever") > 0


def is_active() -> Column:
    """Games with playtime and at least one review."""
    return is_played() & (F.col("positive_reviews") + F.col("negative_reviews") > 0)
