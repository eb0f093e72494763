"""What the corpus operators share: packed rows, row keys, text helpers, written steps.

An operator keeps the columns of its input whatever they are called. It packs a row into one struct,
works on columns of its own beside it, and unpacks at the end, so that no name can clash. A result column
that the input already has replaces the input's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagshelf.sources.shared import new_folder

ROW = "_row"
KEY = ["_id", "_h1", "_h2"]

# The white space of the words and lines in the contracts, as characters and as a pattern's class.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FREE_SHUFFLE_FILES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bound_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Texts are long: hand Python tasks no more than so many rows at once (Spark bounds the bytes as well)."""
    if int(spark.conf.get(BATCH_ROWS)) > rows:
        spark.conf.set(BATCH_ROWS, rows)


def pack(docs: DataFrame) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(F.struct("*").alias(ROW))


def field(name: str) -> Column:
    return F.col(ROW).getField(name)


def unpack(packed: DataFrame, columns: list[str], **results: Column) -> DataFrame:
    """The packed input columns in their order, then the results; a result replaces a column of its name."""
    taken = {name.lower() for name in results}
    kept = [field(c).alias(c) for c in columns if c.lower() not in taken]
    return packed.select(*kept, *[value.alias(name) for name, value in results.items()])


def hashes(*values: Column) -> list[Column]:
    """128 bits of hash as two longs, from two seeds."""
    return [F.xxhash64(*values), F.xxhash64(F.lit(1), *values)]


def with_key(packed: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The id and a hash of the text: rows that share both are equal for every operator here."""
    h1, h2 = hashes(F.coalesce(field(text), F.lit("")))
    return packed.select(ROW, field(doc_id).alias(KEY[0]), h1.alias(KEY[1]), h2.alias(KEY[2]))


def lower_ascii(value: Column) -> Column:
    """A-Z lower-cased, everything else as it is; the built-in lower() knows a faster way for pure ASCII."""
    pure = F.octet_length(value) == F.char_length(value)
    return F.when(pure, F.lower(value)).otherwise(F.translate(value, UPPER, LOWER))


def write_step(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Compute `df` once into the shared folder and go on from the table; its shuffle files are freed.

    A `folder` from `new_folder`, taken before the steps of a part of the work began, outlives these.
    """
    spark = df.sparkSession
    folder = folder or new_folder(spark, label)
    before = spark.conf.get(FREE_SHUFFLE_FILES, "false")
    spark.conf.set(FREE_SHUFFLE_FILES, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(FREE_SHUFFLE_FILES, before)
    return spark.read.schema(df.schema).parquet(folder)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
