"""Versioned snapshots of the three tables: written, checked, then made current in one step."""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagshelf.operators.quality import is_active, is_played, statistics
from tagshelf.sources.layout import CLUSTERED_BY, LISTED, clustered, postings
from tagshelf.sources.shared import small_tasks
from tagshelf.tables import Tables

LOG = "_published"
LOG_SCHEMA = "run_id STRING, buckets INT, layout BOOLEAN, analyzed BOOLEAN, games BIGINT, tags BIGINT, game_tags BIGINT"

# The two sides of the wide join of the KPIs, by the column they meet on.
BUCKETED_BY = {"games": "appid", "game_tags": "appid"}
POSTINGS, STATISTICS = "genre_lists", "statistics"


def write_layout(df: DataFrame, path: str, sort_by: list[str], partitions: int | None = None) -> None:
    """Write sorted ranges of `sort_by`, so that min-max statistics let a filter skip files and row
    groups: release_date_parsed, price_usd or average_playtime_forever for games, tag_id for the bridge.

    Add a key as the last column if a single value may be very frequent; it then spans several ranges.
    """
    ranges = [partitions] if partitions else []
    df.repartitionByRange(*ranges, *sort_by).sortWithinPartitions(*sort_by).write.parquet(path)


def publish(
    tables: Tables, root: str, run_id: str | None = None, validate=None, buckets: int | None = None, layout: bool = False,
    analyze: bool = False, report: dict | None = None,
) -> str:
    """Write a new snapshot under `root`, check what was written, then make it the current one.

    The switch is a single new file in a log, named by the next number and created only if there is none: of two runs that
    end together one gets the number, the other the next. A run that fails before leaves the former snapshot in force; a
    snapshot is never written to again.

    With `buckets` the games and the bridge are bucketed and sorted by appid: the wide join of the KPIs then reads matching
    buckets side by side and shuffles nothing. Aim at buckets that fit a task. With `layout` the games are clustered by
    date, price and playtime, played and active ones apart, the bridge is sorted by tag, and lists of games by genre are added (`load_postings`): filters
    on any of them then read few files. One excludes the other. `analyze` keeps statistics of every column with the
    snapshot (`load_statistics`). Row counts go into `report`.
    """
    if buckets and layout:
        raise ValueError("a snapshot is bucketed by appid or laid out for filters, not both")
    spark = tables.games.sparkSession
    run_id = run_id or uuid.uuid4().hex
    with small_tasks(spark):
        for name, df in tables._asdict().items():
            path = table_path(root, run_id, name)
            if buckets and name in BUCKETED_BY:
                _write_bucketed(df, path, BUCKETED_BY[name], buckets)
            elif layout and name == "games":
                clustered(df, [c for c in CLUSTERED_BY if c in df.columns], "appid", [is_played(), is_active()]).write.parquet(path)
            elif layout and name == "game_tags":
                write_layout(df, path, ["tag_id", "appid"])
            else:
                df.write.parquet(path)
        written = _read(spark, root, run_id, buckets)
        if validate is not None:
            validate(written)
        if layout:
            postings(written.games, LISTED, "appid").write.parquet(table_path(root, run_id, POSTINGS))
        if analyze:
            statistics(written).write.parquet(table_path(root, run_id, STATISTICS))
        counts = {name: df.count() for name, df in written._asdict().items()}
    if report is not None:
        report.update({f"published_{name}": n for name, n in counts.items()})
    entry = {"run_id": run_id, "buckets": buckets, "layout": layout, "analyzed": analyze, **counts}
    _commit(spark, root, entry)
    return run_id


def _commit(spark: SparkSession, root: str, entry: dict) -> int:
    """Add an entry to the log under the next free number, and return that.

    The entry is written beside the log and renamed to its number: a rename does not replace a file that is there, so that
    of several writers one succeeds and the others try the next number.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    log = path(f"{root}/{LOG}")
    fs = log.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(log)
    written = path(log, f".{uuid.uuid4().hex}")
    stream = fs.create(written, False)
    stream.write(bytearray(json.dumps(entry).encode()))
    stream.close()
    number = _last_number(spark, root) + 1
    while not _renamed(jvm, fs, written, path(log, f"{number:020d}.json")):
        number += 1
    return number


def _renamed(jvm, fs, source, target) -> bool:
    """Whether `source` got the name; false if that was taken."""
    no_overwrite = SparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.getFileSystem(fs.getConf()).getUri(), fs.getConf()).rename(
            fs.makeQualified(source), fs.makeQualified(target), no_overwrite
        )
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise


def _numbers(spark: SparkSession, root: str) -> list[int]:
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{LOG}")
    fs = log.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(log):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(log)]
    return [int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n))]


def _last_number(spark: SparkSession, root: str) -> int:
    return max(_numbers(spark, root), default=0)


def published(spark: SparkSession, root: str) -> DataFrame:
    """All runs in the order in which they were published: number and the entry of each."""
    log = spark.read.schema(LOG_SCHEMA).json(f"{root}/{LOG}/*.json")
    return log.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("bigint").alias("number"), "*")


def current_run(spark: SparkSession, root: str) -> str:
    return _current(spark, root)["run_id"]


def load_tables(spark: SparkSession, root: str) -> Tables:
    """The tables of the current snapshot."""
    run = _current(spark, root)
    return _read(spark, root, run["run_id"], run["buckets"])


def table_path(root: str, run_id: str, name: str) -> str:
    return f"{root}/run_id={run_id}/{name}"


def _read(spark: SparkSession, root: str, run_id: str, buckets: int | None) -> Tables:
    def table(name: str) -> DataFrame:
        df = spark.read.parquet(table_path(root, run_id, name))
        if not (buckets and name in BUCKETED_BY):
            return df
        # Only a catalog table carries the bucketing to the planner.
        catalog_name = f"tagshelf_{name}_{run_id.replace('-', '_')}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        key = BUCKETED_BY[name]
        escaped = table_path(root, run_id, name).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {catalog_name} ({columns}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS "
            f"LOCATION '{escaped}'"
        )
        return spark.table(catalog_name)

    return Tables(*[table(name) for name in Tables._fields])


def _write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """One file per bucket, in a scratch catalog entry that is dropped again; the files stay."""
    name = f"tagshelf_writing_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).format("parquet").saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def _current(spark: SparkSession, root: str) -> dict:
    latest = _latest(spark, root)
    if latest is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return latest


def _latest(spark: SparkSession, root: str) -> dict | None:
    number = _last_number(spark, root)
    if not number:
        return None
    return spark.read.schema(LOG_SCHEMA).json(f"{root}/{LOG}/{number:020d}.json").first().asDict()


def load_postings(spark: SparkSession, root: str) -> DataFrame:
    """value and appid of the genres and tags in the games' lists, of the current snapshot, if that was laid out."""
    return _beside(spark, root, "layout", POSTINGS)


def load_statistics(spark: SparkSession, root: str) -> DataFrame:
    """The statistics of every column of the current snapshot, if that was analyzed."""
    return _beside(spark, root, "analyzed", STATISTICS)


def _beside(spark: SparkSession, root: str, flag: str, name: str) -> DataFrame:
    run = _current(spark, root)
    if not run[flag]:
        raise FileNotFoundError(f"the current snapshot under {root} was published without {name}")
    return spark.read.parquet(table_path(root, run["run_id"], name))
