"""One large JSON object, read by many tasks: `{"key": value, "key": value, ...}`.

Spark's text reader splits a file of any length at a separator, on any file system it knows. Here the separator is the
closing brace, which every record has, so that no row is longer than a record and each split holds the rows that begin
in it. What a brace, a comma or a quote means depends on what stands before it, so the file is read twice:

1. Each split tells what it does to the state of a reader, for both states it may be entered in: whether it ends inside
   a string, and how many levels further in. Composed in the order of the file, these are the states that splits begin in.
2. Knowing its state, each split hands out the entries that begin and end in it, and the text before and behind them:
   parts of entries that cross into other splits, which are put together by a grouping of these few parts.

A backslash before a closing brace is no JSON, so an escape never crosses a row.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagshelf.sources.files import file_paths, with_files
from tagshelf.sources.shared import small_tasks, write_through

SEPARATOR = b"}"
OTHER, OPEN, CLOSE, COMMA, QUOTE = range(5)
_CLASS = np.zeros(256, np.uint8)
for _bytes, _class in ((b"{[", OPEN), (b"}]", CLOSE), (b",", COMMA), (b'"', QUOTE)):
    _CLASS[list(_bytes)] = _class

MIN_SPLITS = "spark.sql.files.minPartitionNum"
SPLIT = (
    "file bigint, file_size bigint, block bigint, quotes bigint, outside bigint, inside bigint, n_open bigint, "
    "n_bytes bigint, blank_end boolean"
)
FOUND = "file bigint, block bigint, place bigint, kind string, entry string"


class State(NamedTuple):
    """Of a reader between two bytes: 1 inside a string, else 0; how many braces and brackets are open; and whether the
    object is behind it."""

    inside: int
    depth: int
    closed: bool = False


class Structure(NamedTuple):
    """The braces, brackets, commas and quotes of a text, and the number of quotes up to each."""

    at: np.ndarray
    kind: np.ndarray
    quotes: np.ndarray

    def steps(self, inside: int) -> np.ndarray:
        """What each adds to the depth if the text begins inside a string, or not."""
        step = (self.kind == OPEN).astype(np.int64) - (self.kind == CLOSE)
        return np.where((self.quotes + inside) % 2 == 0, step, 0)


def structure(raw: bytes) -> Structure:
    text = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero(_CLASS[text])
    kind = _CLASS[text[at]]
    slashes = np.flatnonzero(text == ord("\\"))
    if slashes.size:
        # The character behind an odd run of backslashes is escaped.
        first = np.append(True, np.diff(slashes) != 1)
        runs = np.flatnonzero(first)
        length = np.diff(np.append(runs, slashes.size))
        escaped = (slashes[runs] + length)[length % 2 == 1]
        own = (kind != QUOTE) | ~np.isin(at, escaped)
        at, kind = at[own], kind[own]
    return Structure(at, kind, np.cumsum(kind == QUOTE))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], bytes, bool]]:
    """(number of the file, its size, first byte of the split), the bytes of rows of this split with their separators, whether the last
    row is blank. A partition holds its splits one after the other; a split's rows come in their order."""
    for batch in batches:
        files, sizes, blocks = (batch.column(i).to_pylist() for i in range(3))
        rows = batch.column(3).to_pylist()
        first = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or (files[i], blocks[i]) != (files[first], blocks[first]):
                yield (files[first], sizes[first], blocks[first]), SEPARATOR.join(rows[first:i]) + SEPARATOR, not rows[i - 1].strip()
                first = i


# --- what a split does to the state ---------------------------------------------------------------


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split of a partition: quotes, and the change of depth if entered outside or inside a string."""
    found: dict[tuple, list] = {}
    for split, raw, blank in _splits(batches):
        own = found.setdefault(split, [0, 0, 0, 0, 0, True])
        s = structure(raw)
        for inside in (0, 1):
            own[1 + inside] += int(s.steps((inside + own[0]) % 2).sum())
        own[0] += int((s.kind == QUOTE).sum())
        own[3] += int((s.kind == OPEN).sum())
        own[4] += len(raw)
        own[5] = blank
    if found:
        columns = zip(*[(*split, *own) for split, own in found.items()], strict=True)
        kinds = [*[pa.int64()] * 8, pa.bool_()]
        names = [c.split()[0] for c in SPLIT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def entry_states(splits: list) -> tuple[dict[tuple[int, int], State], list[int]]:
    """The state in which each split begins, by file and first byte, from the rows of all splits; and the files that are
    no object, as their braces, brackets or quotes do not match."""
    by_file: dict[int, list] = {}
    for r in splits:
        by_file.setdefault(r["file"], []).append(r)
    states, broken = {}, []
    for file, own in by_file.items():
        state, n_bytes = State(0, 0), 0
        own.sort(key=lambda r: r["block"])
        for i, r in enumerate(own):
            states[file, r["block"]] = state._replace(closed=i > 0 and state == State(0, 0))
            state = State((state.inside + r["quotes"]) % 2, state.depth + (r["inside"] if state.inside else r["outside"]))
            n_bytes += r["n_bytes"]
        # Rows end with a separator, the last one too, except for what may stand behind the last brace of the file. (A
        # compressed file, or one with a byte order mark, has other sizes than its rows: then the text alone decides.)
        missing = n_bytes - own[-1]["file_size"] == 1
        extra = own[-1]["blank_end"] and n_bytes != own[-1]["file_size"]
        if state != State(0, -1 if extra else 0) or (missing and not extra) or not any(r["n_open"] for r in own):
            broken.append(file)
    return states, broken


# --- the entries of a split -----------------------------------------------------------------------


class Reader:
    """Cuts the bytes of a split into entries."""

    def __init__(self, state: State):
        self.inside, self.depth, self.closed = state
        self.open: list[bytes] = []  # what is read of the entry that is not ended
        self.begun = self.depth == 0  # whether that entry, if any, begins in this split
        self.alone = False  # nothing but the opening brace stands before it

    def feed(self, raw: bytes) -> Iterator[tuple[str, bytes]]:
        """Kind and text of the entries that end here: 'entry', or 'head' if it begins in an earlier split; 'broken' where
        something stands beside the object, or nothing between two commas."""
        s = structure(raw)
        depth = self.depth + np.cumsum(s.steps(self.inside))
        outside = (s.quotes + self.inside) % 2 == 0
        opens = outside & (s.kind == OPEN) & (depth == 1)
        ends = outside & (((s.kind == COMMA) & (depth == 1)) | ((s.kind == CLOSE) & (depth <= 0)))
        last = 0
        for i in np.flatnonzero(opens | ends).tolist():
            at = int(s.at[i])
            text = b"".join([*self.open, raw[last:at]])
            self.open, last = [], at + 1
            if opens[i] or depth[i] < 0:
                if text.strip() or (opens[i] and (self.closed or raw[at : at + 1] != b"{")):
                    yield "broken", b""
                self.begun = self.alone = True
                continue
            self.closed = bool(s.kind[i] == CLOSE)
            if not self.begun:
                yield "head", text
            elif text.strip():
                yield "entry", text
            elif not (self.closed and self.alone):
                yield "broken", b""
            self.begun, self.alone = True, False
        self.open.append(raw[last:])
        if len(s.at):
            self.inside = int((self.inside + s.quotes[-1]) % 2)
            self.depth = int(depth[-1])

    def rest(self) -> tuple[str, bytes] | None:
        """What is begun and not ended, as 'tail', or the 'middle' of an entry; nothing beside the object."""
        text = b"".join(self.open)
        if self.depth > 0 or self.inside:
            return ("tail" if self.begun else "middle"), text
        return ("broken", b"") if text.strip() else None


def _entries(batches: Iterator[pa.RecordBatch], states: dict[tuple[int, int], State]) -> Iterator[pa.RecordBatch]:
    reader, split, place = None, None, 0

    def batch(rows: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
        places, kinds, texts = zip(*rows, strict=True)
        columns = [
            pa.array([split[0]] * len(rows), pa.int64()), pa.array([split[2]] * len(rows), pa.int64()), pa.array(places, pa.int64()),
            pa.array(kinds, pa.string()), pa.array(texts, pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FOUND.split(", ")])

    def ending() -> Iterator[pa.RecordBatch]:
        left = reader.rest() if reader else None
        if left:
            yield batch([(place, *left)])

    for now, raw, _ in _splits(batches):
        if now != split:
            yield from ending()
            split, place, reader = now, 0, Reader(states[now[0], now[2]])
        rows = [(place + i, *r) for i, r in enumerate(reader.feed(raw))]
        place += len(rows)
        if rows:
            yield batch(rows)
    yield from ending()


# --- on files -------------------------------------------------------------------------------------


@contextlib.contextmanager
def _fixed_splits(spark: SparkSession):
    """The number of cores a cluster has just then decides on the splits, unless it is told: both readings need the same."""
    before = spark.conf.get(MIN_SPLITS, None)
    spark.conf.set(MIN_SPLITS, before or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.unset(MIN_SPLITS) if before is None else spark.conf.set(MIN_SPLITS, before)


def read_entries(spark: SparkSession, path) -> DataFrame:
    """file, block, place and entry of every entry of the JSON objects in the files of `path`, one object to a file.

    `entry` is the text `"key": value`. file is the number of the file in the order of paths, block and place tell where
    in it the entry begins: their order is that of the text, however it is split. Entries are written to the shared
    folder. No task holds more of a file than a batch of rows and one entry; the driver holds a row for each split, as it
    does to plan the reading. A file that is no JSON object as a whole fails; what stands inside an entry is for its
    parser. An object without entries gives no row, nor does a file without a byte.
    """
    rows = with_files(spark, spark.read.option("lineSep", SEPARATOR.decode()).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"),
    ), path).select("file", "file_size", "block", "value")
    with _fixed_splits(spark), small_tasks(spark):
        states, broken = entry_states(rows.mapInArrow(_changes, SPLIT).collect())
        _refuse(spark, path, broken)
        found = write_through(rows.mapInArrow(lambda batches: _entries(batches, states), FOUND), "entries")
    _refuse(spark, path, [r["file"] for r in found.filter("kind = 'broken'").select("file").distinct().limit(5).collect()])
    whole = found.filter("kind = 'entry'").select("file", "block", "place", "entry")
    # Parts of entries over the ends of splits: at most two for each split. A tail begins an entry, the rest goes on.
    so_far = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, 0)
    parts = found.filter("kind IN ('tail', 'middle', 'head')").withColumn("n", F.count_if(F.col("kind") == "tail").over(so_far))
    joined = parts.groupBy("file", "n").agg(F.sort_array(F.collect_list(F.struct("block", "place", "entry"))).alias("parts"))
    first = F.get("parts", 0)
    crossing = joined.select("file", first["block"].alias("block"), first["place"].alias("place"), F.array_join("parts.entry", "").alias("entry"))
    return whole.unionByName(crossing)


def _refuse(spark: SparkSession, path, broken: list[int]) -> None:
    if broken:
        named = file_paths(spark, path).filter(F.col("file").isin(sorted(broken)[:5])).orderBy("file").collect()
        raise ValueError(f"not a JSON object: {[r['path'] for r in named]}")
