"""The files of an input, numbered in the order of their paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def file_paths(spark: SparkSession, path) -> DataFrame:
    """path and file, its number from 0, of the files that a reader of `path` reads. Nothing is read of their contents."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"))
    return listed.select("path", (F.row_number().over(Window.orderBy("path")) - 1).cast("bigint").alias("file"))


def with_files(spark: SparkSession, rows: DataFrame, path) -> DataFrame:
    """`rows` of the files of `path`, with the number of the file in `path` as `file`.

    The numbers are broadcast: a row for each file, of which the driver already holds the listing.
    """
    return rows.join(F.broadcast(file_paths(spark, path)), "path")


def place_of(file: Column, block: Column, row: Column) -> Column:
    """One number for a place in the input: the file, the first byte of the split, the row within it. In order it is the
    order of the input, whichever way that is split. Decimals of fixed size are compared without sorting."""
    number = lambda c, digits: c.cast("decimal(38,0)") * F.lit(str(10**digits)).cast("decimal(38,0)")
    return (number(file, 30) + number(block, 11) + row.cast("decimal(38,0)")).cast("decimal(38,0)")
