"""Raw game records: one JSON object keyed by appid, or one JSON record per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagshelf.fixed_values import COUNTS, FLAGS
from tagshelf.functions.coerce import json_text
from tagshelf.sources.files import place_of, with_files
from tagshelf.sources.json_object import read_entries
from tagshelf.sources.shared import write_through

# The low bits of monotonically_increasing_id(): the row within its partition, in which a split's rows are in their order.
ROWS_OF_A_PARTITION = (1 << 33) - 1

# Typed as loosely as each coercion rule needs. VARIANT keeps apart an absent key, a JSON null, a
# boolean and a string; a field of an unexpected kind becomes NULL without touching its neighbours.
# The tags stay a map of raw texts, which keeps the written order that a VARIANT would sort away.
RECORD_SCHEMA = ", ".join(
    ["name STRING", "release_date STRING", "price VARIANT"]
    + [f"{c} VARIANT" for c in FLAGS + COUNTS]
    + ["developers ARRAY<STRING>", "publishers ARRAY<STRING>", "categories ARRAY<STRING>"]
    + ["tags MAP<STRING,STRING>"]
)


def read_games(spark: SparkSession, path, layout: str = "ndjson") -> DataFrame:
    """Raw records as columns, plus `appid` as text and `record_ord`, the place of the record in the input.

    `layout="object"` reads files that hold one JSON object keyed by appid, `layout="ndjson"` one record in each line.
    Either way a file is split among many tasks, and `record_ord` has the order of the paths and of the records in each
    file, however they are split.
    """
    if layout == "object":
        return parse_records(_object_records(spark, path), F.col("appid"))
    if layout == "ndjson":
        return parse_records(_line_records(spark, path), None)
    raise ValueError(f"layout must be 'object' or 'ndjson', not {layout!r}")


def _object_records(spark: SparkSession, path) -> DataFrame:
    """appid, record and record_ord of the entries of each file; a repeated key keeps its first place and its last value."""
    entries = read_entries(spark, path)
    raw_key = F.regexp_extract("entry", r'^\s*"((?:[^"\\]|\\.)*+)"', 1)
    key = F.when(raw_key.contains("\\"), F.from_json(F.concat(F.lit('{"k":"'), raw_key, F.lit('"}')), "k STRING")["k"]).otherwise(raw_key)
    places = place_of(F.col("file"), F.col("block"), F.col("place"))
    # Only keys and places are grouped, and only the few repeated ones are joined: no record is moved.
    keyed = entries.select("file", key.alias("key"), places.alias("at"))
    repeated = write_through(
        keyed.groupBy("file", "key").agg(F.min("at").alias("first"), F.max("at").alias("last")).filter(F.col("first") < F.col("last")),
        "repeated-keys",
    )
    settled = (
        entries.select("file", key.alias("key"), "entry", places.alias("at")).join(repeated, ["file", "key"], "left")
        .filter(F.col("last").isNull() | (F.col("at") == F.col("last")))
    )
    record = F.from_json(F.concat(F.lit("{"), F.col("entry"), F.lit("}")), "MAP<STRING,STRING>")
    broken = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("entry", 1, 200)))
    return settled.select(
        F.coalesce("first", "at").alias("record_ord"), F.explode(F.when(record.isNotNull(), record).otherwise(broken)).alias("appid", "record")
    )


def _line_records(spark: SparkSession, path) -> DataFrame:
    lines = spark.read.text(path).filter(F.trim("value") != "").select(
        F.col("value").alias("record"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    )
    return with_files(spark, lines, path)


def parse_records(records: DataFrame, key: Column | None) -> DataFrame:
    """Parse the JSON text in `record`. With `key` None the appid is a field of the record itself, and
    a line that is not a JSON object fails the job, as a broken file does.

    The place of the record is a value of the projection that parses it, and depends on its row: filters on the result
    are then not pushed below it, where they would parse every record again for each field they look at.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(ROWS_OF_A_PARTITION))
    if key is None:
        place = place_of(F.col("file"), F.col("block"), row)
        parsed = records.select("record", place.alias("record_ord"), F.from_json("record", f"appid VARIANT, {RECORD_SCHEMA}").alias("r"))
        broken = F.raise_error(F.concat(F.lit("not a JSON object: "), F.substring("record", 1, 200)))
        key = F.coalesce(
            json_text(F.col("r.appid")),
            F.when(F.json_object_keys("record").isNull(), broken.cast("string")),
        )
    else:
        place = F.when(row >= 0, F.col("record_ord"))
        parsed = records.select("appid", place.alias("record_ord"), F.from_json("record", RECORD_SCHEMA).alias("r"))
    names = [field.split()[0] for field in RECORD_SCHEMA.split(", ")]
    return parsed.select(key.alias("appid"), "record_ord", *[F.col(f"r.{n}").alias(n) for n in names])
