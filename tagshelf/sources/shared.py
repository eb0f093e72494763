"""The folder all executors share, for steps that must be computed once and outlive an executor."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session: a folder that the driver and every executor reach."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder.rstrip("/")


_steps: ContextVar[str | None] = ContextVar("steps", default=None)


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own for a step: among the steps of the run that is under way, if there is one."""
    return f"{_steps.get() or f'{shared_dir(spark)}/tagshelf'}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def temporary_steps(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """Steps that are written inside have one folder, which goes when the run ends or fails.

    A result that is read from steps must be written elsewhere, or collected, before that.
    """
    folder = new_folder(spark, label)
    token = _steps.set(folder)
    try:
        yield folder
    finally:
        _steps.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


# What a task reads at most, in bytes as they are written and as they are shuffled.
TASK_SIZES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}


@contextlib.contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside have tasks of a few megabytes, unless the session asks for smaller ones.

    Keys in their order are written in less than a byte a row, so that a task of the usual size has tens of millions of
    rows to group or sort.
    """
    before = {name: spark.conf.get(name, None) for name in TASK_SIZES}
    try:
        for name, size in TASK_SIZES.items():
            spark.conf.set(name, min(size, _in_bytes(spark, spark.conf.get(name))))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _in_bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt by `columns` over as many tasks as the session has for shuffles. Adaptive execution does not merge
    these, which it would by bytes (see `small_tasks`): for steps of a result whose jobs run elsewhere."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Compute `df` once into the shared folder and go on from the written table.

    Unlike a cache it survives a lost executor, and the planner sees the real size of the table, which
    is what lets it choose a broadcast join for a small one and a shuffle join for a large one.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    with small_tasks(spark):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
