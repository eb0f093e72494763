"""Pack token pieces into windows: combinations of lengths by non-negative least squares, the rest greedily.

Only the histogram of lengths decides, which has as many entries as the window has tokens, however many
documents there are. Shallow combinations of lengths that fill the window are enumerated; how often each is
to be repeated is the non-negative least squares solution against the histogram; rounded, it uses up most of
it, and what is left is packed longest first into the narrowest gap. Each piece then takes the place that its
rank among the pieces of its length stands for.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagshelf.llm.bpe import byte_letters, encode_text, load
from tagshelf.llm.rows import ROW, field, pack, unpack, write_step

PIECE = StructType().add("start", "long").add("length", "integer").add("ids_crc32", "long").add("doc_tokens", "long")
DEPTH = 3
ROUNDS = 300


# Fixed value: how byte-level vocabularies with spaced words split a text.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# The faster library's pattern engine gives up on white space of about a million characters.
MOST_SPACE = 100_000


# --- pieces ---------------------------------------------------------------------------------------


@functools.cache
def encoder(path: str):
    """The vocabulary of a byte-level tokenizer file for the faster of the two public libraries, one per worker
    process. Their ids are the same where, as in such files, a token's id grows with the rank of its merge."""
    from tiktoken import Encoding

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    if made != sorted(made) or spec["normalizer"] is not None:
        raise ValueError(f"{path} is no byte-level vocabulary in the order of its merges")
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    return Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)


def text_ids(text: str, path: str) -> np.ndarray:
    """The ids of a text; one with a very long run of white space goes through this package's own encoder."""
    if len(text) > MOST_SPACE and any(m.end() - m.start() > MOST_SPACE for m in re.finditer(r"\s+", text)):
        return load(path).encode([text.encode()])[0]
    return encoder(path).encode_to_numpy(text, allowed_special="all")


def text_pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, window: int) -> Iterator[pa.RecordBatch]:
    """Of ids and texts, the pieces of each text's ids with `end_id` behind them: as many of a window's length as there
    are, and the rest.

    A null text counts as empty and is one piece of the end alone.
    """
    for batch in batches:
        start, length, checksum, tokens, n_pieces = [], [], [], [], []
        for text in batch.column(1):
            raw = np.append(text_ids(text.as_py() or "", path), end_id).astype("<u4").tobytes()
            n = len(raw) // 4
            firsts = range(0, n, window)
            start += firsts
            length += [min(window, n - a) for a in firsts]
            checksum += [zlib.crc32(raw[4 * a : 4 * (a + window)]) for a in firsts]
            tokens += [n] * len(firsts)
            n_pieces.append(len(firsts))
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(n_pieces)), n_pieces)))
        columns = [pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(checksum, pa.int64()), pa.array(tokens, pa.int64())]
        yield pa.RecordBatch.from_arrays([ids, *columns], ["_id", *PIECE.names])


def cut_documents(
    docs: DataFrame, path: str, end_id: int = 0, window: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: `doc_id`, start, length, ids_crc32 (of the ids as little-endian unsigned 32 bits), doc_tokens.

    Other columns are dropped. Every row has at least one piece, as `end_id` is behind each text, a null one included;
    rows that repeat have theirs each, a null id stays null, and an empty table gives an empty one. A text is taken whole,
    however long, and its ids are in one task's memory at a time.

    Tasks give rows, not a list to be exploded: for lists, Spark adds a filter that has each text encoded twice, in two
    workers of a task at the same time.
    """
    rows = pack(docs).select(field(doc_id).alias("_id"), field(text).alias("_text"))
    pieces = rows.mapInArrow(
        functools.partial(text_pieces, path=path, end_id=end_id, window=window),
        StructType([rows.schema["_id"], *PIECE]),
    )
    return pieces.withColumnRenamed("_id", doc_id)


# --- how often which combination of lengths -------------------------------------------------------


def combinations(lengths: np.ndarray, window: int, depth: int = DEPTH) -> np.ndarray:
    """All multisets of up to `depth` of `lengths` with `window` as their sum: rows, longest first, 0 for none."""
    present = np.zeros(window + 1, bool)
    present[lengths] = True
    lengths = np.sort(lengths)[::-1]
    rows = np.zeros((1, 1), np.int64) + window if present[window] else np.empty((0, 1), np.int64)
    found = [np.pad(rows, ((0, 0), (0, depth - 1)))]
    heads = lengths[:, None][lengths < window]  # the longest ones chosen so far
    for size in range(2, depth + 1):
        rest = window - heads.sum(1)
        fits = (rest > 0) & (rest <= heads[:, -1])
        closing = np.column_stack([heads[fits], rest[fits]])[present[rest[fits]]]
        found.append(np.pad(closing, ((0, 0), (0, depth - size))))
        if size < depth:
            grown = [np.column_stack([heads, np.full(len(heads), x)])[(heads[:, -1] >= x) & (rest > x)] for x in lengths]
            heads = np.concatenate(grown) if grown else np.empty((0, size), np.int64)
    return np.concatenate(found)


def non_negative_least_squares(parts: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeats x >= 0 of the combinations with the least squares of (lengths used - histogram).

    Multiplicative steps: each x is scaled by what its lengths still offer against what is used, which keeps
    it non-negative and never raises the squares. Lengths are weighed by their tokens: a long piece left over
    costs more than a short one.
    """
    if not len(parts):
        return np.empty(0)
    size = len(histogram)
    weight = np.arange(size, dtype=float) / (size - 1)
    weight[0] = 0
    wanted = (weight * histogram)[parts].sum(1)
    x = np.full(len(parts), histogram.sum() / (2 * len(parts)) + 1e-9)
    for _ in range(rounds):
        used = np.bincount(parts.ravel(), np.repeat(x, parts.shape[1]), size)
        x *= wanted / np.maximum((weight * used)[parts].sum(1), 1e-12)
    return x


class Plan(NamedTuple):
    """Slots, ordered by length: from `slot` on, `each` places a sequence, of sequences from `sequence` on."""

    first_slot: np.ndarray  # by length
    slot: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    each: np.ndarray
    n_sequences: int

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.first_slot[lengths] + ranks
        entry = np.searchsorted(self.slot, at, "right") - 1
        local = at - self.slot[entry]
        turn, within = local // self.each[entry], local % self.each[entry]
        return self.sequence[entry] + turn, self.offset[entry] + within * lengths


def make_plan(histogram: np.ndarray, window: int) -> Plan:
    """A place for each piece of a histogram (index: length, 0 to `window`)."""
    left = histogram.astype(np.int64).copy()
    chosen: list[tuple[list[int], int]] = []

    def take(lengths: list[int], repeats: int) -> None:
        need = {x: lengths.count(x) for x in lengths}
        repeats = min([repeats, *[left[x] // n for x, n in need.items()]])
        if repeats > 0:
            for x, n in need.items():
                left[x] -= n * repeats
            chosen.append((lengths, int(repeats)))

    parts = combinations(np.flatnonzero(histogram), window)
    # What rounding takes from one combination, the next of the same longest lengths gets.
    upto = np.cumsum(non_negative_least_squares(parts, histogram))
    repeats = np.diff(np.floor(upto + 0.5), prepend=0).astype(np.int64)
    for row, n in zip(parts[repeats > 0].tolist(), repeats[repeats > 0].tolist(), strict=True):
        take([x for x in row if x], n)
    while (rest := np.flatnonzero(left)).size:
        lengths, gap, open_ = [], window, left.copy()
        while (able := rest[(rest <= gap) & (open_[rest] > 0)]).size:
            lengths.append(int(able[-1]))
            open_[able[-1]] -= 1
            gap -= int(able[-1])
        take(lengths, window * int(left.sum()))

    entries, sequence = [], 0
    for lengths, n in chosen:
        offset = 0
        for x in sorted(set(lengths), reverse=True):
            each = lengths.count(x)
            entries.append((x, sequence, offset, each, n * each))
            offset += x * each
        sequence += n
    entries.sort()
    table = np.array(entries, np.int64).reshape(-1, 5)
    slot = np.append(0, np.cumsum(table[:, 4]))
    first_slot = np.append(0, np.cumsum(histogram))[:-1]
    return Plan(first_slot, slot[:-1], table[:, 1], table[:, 2], table[:, 3], sequence)


# --- places for all pieces ------------------------------------------------------------------------


def pack_pieces(pieces: DataFrame, window: int = 1024, salts: int | None = None) -> DataFrame:
    """The columns of `pieces` (with a `length` of 1 to `window`) with sequence_id and offset.

    In a sequence the pieces lie without gaps from 0 on and end within `window`. Whole windows are sequences of
    their own. Pieces that equal each other in all columns may swap places. An empty table gives an empty result.

    The ranks of a length are counted in `salts` parts (as many as there are shuffle partitions), so that a
    length that a third of all pieces have is not in one task. What lies before a part is joined to it by the keys that
    its ranks are counted by anyway: no row moves for it. The driver sees the histogram, tasks the plan made from it;
    the window bounds both.
    """
    spark = pieces.sparkSession
    salts = salts or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = pack(pieces)
    length = field("length")
    columns = pieces.columns
    by_hash = [F.col(ROW).getField(c) for c in columns]
    salted = rows.filter(length < window).select(ROW, length.cast("int").alias("_length"), F.pmod(F.xxhash64(*by_hash), F.lit(salts)).cast("int").alias("_salt"))
    counts = write_step(salted.groupBy("_length", "_salt").agg(F.count("*").alias("_n")), "length-counts")
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("_length").agg(F.sum("_n").alias("n")).collect():
        histogram[r["_length"]] = r["n"]
    plan = make_plan(histogram, window)

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        sequence, offset = plan.place(lengths.to_numpy(zero_copy_only=False).astype(np.int64), ranks.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    earlier = Window.partitionBy("_length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    order = Window.partitionBy("_length", "_salt").orderBy(*[f.asc() for f in by_hash])
    ranked = salted.withColumn("_rank", F.row_number().over(order) - 1).join(before.hint("merge"), ["_length", "_salt"])
    placed = ranked.select(ROW, place("_length", F.col("_before") + F.col("_rank")).alias("_place"))
    whole = rows.filter(length == window).select(
        ROW, F.struct(
            (F.lit(plan.n_sequences).cast("long") + F.monotonically_increasing_id()).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        ).alias("_place"),
    )
    both = placed.unionByName(whole)
    return unpack(both, columns, sequence_id=F.col("_place.sequence_id"), offset=F.col("_place.offset"))


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 0, window: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every piece of every document with its place: the rows of `cut_documents` with sequence_id and offset, for nulls,
    repeated rows and empty tables as there."""
    return pack_pieces(write_step(cut_documents(docs, path, end_id, window, doc_id, text), "pieces"), window)


def sequences(
    docs: DataFrame, placed: DataFrame, path: str, end_id: int = 0, window: int = 1024, pad_id: int = 0,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids padded to `window` unless their number is a power of two.

    Documents have an id of their own here. A sequence gathers at most `window` tokens.
    """
    ids = pack(docs).select(field(doc_id).alias("_id"), F.array_append(encode_text(field(text), path), F.lit(end_id)).alias("ids"))
    own = placed.select(F.col(doc_id).alias("_id"), "start", "length", "sequence_id", "offset")
    parts = own.join(ids, "_id").select(
        "sequence_id", F.struct("offset", F.expr("slice(ids, int(start) + 1, length)").alias("ids")).alias("part")
    )
    joined = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list("part")).alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids")
    )
    n = F.size("ids")
    is_power = F.bit_count(n) == 1
    padded = F.concat("ids", F.array_repeat(F.lit(pad_id), F.when(is_power, 0).otherwise(window - n)))
    return joined.select("sequence_id", n.alias("n_tokens"), padded.alias("ids"))
