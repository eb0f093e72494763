"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every position, the polynomial of the code points before it, modulo a
prime. Any span's hash is the difference of two entries, so that spans are compared without reading them
again, and how far two texts agree from given positions on is found by binary search. A fingerprint is
the smallest of the mixed hashes of all spans of a fixed width: texts that share spans share hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.rows import field, hashes, pack

PRIME = (1 << 31) - 1
BASES = (1_350_490_027, 1_911_520_717)  # two polynomials: 62 bits of hash
WIDTH = 12  # code points of a span
KEPT = 64  # hashes of a fingerprint
EDITS = (
    "{id}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, common_prefix bigint"
)


def _reduce(x: np.ndarray) -> np.ndarray:
    """Modulo the prime, of values below 2^62; its bits are all ones, so that halves can be added."""
    mask, bits = np.uint64(PRIME), np.uint64(31)
    x = (x & mask) + (x >> bits)
    x = (x & mask) + (x >> bits)
    return np.where(x == mask, np.uint64(0), x)


class _Powers:
    """Powers of the bases and of their inverses, as many as the longest text so far needs."""

    def __init__(self):
        self.up = [np.ones(1, np.uint64) for _ in BASES]
        self.down = [np.ones(1, np.uint64) for _ in BASES]

    def upto(self, n: int) -> None:
        while len(self.up[0]) < n:
            have = len(self.up[0])
            for tables, roots in ((self.up, BASES), (self.down, [pow(b, -1, PRIME) for b in BASES])):
                for k, root in enumerate(roots):
                    tables[k] = np.concatenate([tables[k], _reduce(tables[k] * np.uint64(pow(root, have, PRIME)))])


POWERS = _Powers()


class Prefixes:
    """The prefix arrays of a text's code points."""

    def __init__(self, points: np.ndarray, sums: list[np.ndarray] | None = None):
        self.points = points
        POWERS.upto(len(points) + 1)
        self.sums = sums or [
            np.concatenate([np.zeros(1, np.uint64), self._sums(points, k, 0)]) for k in range(len(BASES))
        ]

    @staticmethod
    def _sums(points: np.ndarray, k: int, start: int) -> np.ndarray:
        # A sum of n terms stays below n * 2^31: far from 64 bits for any text.
        terms = _reduce(points * POWERS.up[k][start : start + len(points)])
        return _reduce(np.cumsum(terms, dtype=np.uint64))

    @classmethod
    def of(cls, text: str) -> Prefixes:
        return cls(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64))

    def __len__(self) -> int:
        return len(self.points)

    def with_tail(self, keep: int, tail: np.ndarray) -> Prefixes:
        """The first `keep` code points and `tail`; the entries of what is kept are used again."""
        points = np.concatenate([self.points[:keep], tail])
        POWERS.upto(len(points) + 1)
        sums = [
            np.concatenate([s[: keep + 1], _reduce(s[keep] + self._sums(tail, k, keep))]) for k, s in enumerate(self.sums)
        ]
        return Prefixes(points, sums)

    def spans(self, width: int) -> np.ndarray:
        """The hash of each span of `width`, wherever it stands."""
        out = np.zeros(len(self) - width + 1, np.uint64)
        for k, s in enumerate(self.sums):
            difference = s[width:] + (np.uint64(PRIME) - s[:-width])
            own = _reduce(_reduce(difference) * POWERS.down[k][: len(out)])
            out = out << np.uint64(31) | own
        return out

    def span(self, start: int, end: int) -> int:
        """The hash of one span: equal spans have equal hashes, others but for a chance of about 2^-60 do not."""
        out = 0
        for k, s in enumerate(self.sums):
            out = out << 31 | (int(s[end]) - int(s[start])) * int(POWERS.down[k][start]) % PRIME
        return out

    def common_extension(self, start: int, other: Prefixes, at: int) -> int:
        """How many code points from `start` on equal those of `other` from `at` on, by binary search."""
        low, high = 0, min(len(self) - start, len(other) - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, start + middle) == other.span(at, at + middle):
                low = middle
            else:
                high = middle - 1
        return low

    def fingerprint(self, width: int = WIDTH, kept: int = KEPT) -> np.ndarray:
        """The `kept` smallest distinct mixed span hashes; a text shorter than `width` is one span, an empty one none."""
        if not len(self):
            return np.empty(0, np.uint32)
        x = self.spans(min(width, len(self)))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed = ((x ^ (x >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)
        # Half of the places may repeat others and still leave enough; else all are looked at.
        near = np.unique(np.partition(mixed, 2 * kept)[: 2 * kept]) if len(mixed) > 4 * kept else np.unique(mixed)
        if len(near) < kept < len(mixed):
            near = np.unique(mixed)
        return near[:kept]


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Shared among the smallest of both: an estimate of the Jaccard similarity of the texts' spans. Two
    fingerprints of nothing are alike."""
    both = np.union1d(a, b)[:kept]
    if not len(both):
        return 1.0
    return float(np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True).size / len(both))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a whole text as hexadecimal text, eight digits a hash; null and empty give an empty one.
    Equal texts have equal fingerprints."""

    @F.arrow_udf("string")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([as_text(Prefixes.of(t.as_py() or "").fingerprint()) for t in texts], pa.string())

    return made(text)


def _edits(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a bucket in their order, each with the one after it. A border row only is the next."""
    before = None  # the row that waits for its next: bucket, id, text, prefixes, fingerprint
    for batch in batches:
        out = []
        for bucket, border, doc_id, text in zip(*(batch.column(i) for i in range(4)), strict=True):
            bucket, border, text = bucket.as_py(), border.as_py(), text.as_py() or ""
            own = Prefixes.of(text)
            printed = own.fingerprint()
            if before and before[0] == bucket:
                _, last_id, last_text, last, last_print = before
                n = len(last)
                cut = n // 3
                edited = last.with_tail(n - cut, own.points[:cut])
                edited_print = edited.fingerprint()
                edited_text = last_text[: n - cut] + text[:cut]
                out.append({
                    schema.names[0]: last_id.as_py(), "n_chars": n,
                    "edited_sha256": hashlib.sha256(edited_text.encode()).hexdigest(),
                    "fingerprint": as_text(last_print), "edited_fingerprint": as_text(edited_print),
                    "near_edited": likeness(last_print, edited_print), "near_next": likeness(last_print, printed),
                    "common_prefix": last.common_extension(0, edited, 0),
                })
            before = None if border else (bucket, doc_id, text, own, printed)
        yield pa.RecordBatch.from_pylist(out, schema)


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The next document is the one that follows in descending order of the id, after the last the first. The
    edited text has the last third (rounded down) of the code points replaced by as many of the next document's
    first, or all if it has fewer. Columns: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (`likeness`), common_prefix (code points before text and edited text differ). Other
    columns are not carried along.

    Ids are whole numbers. Null texts count as empty. Rows that share an id follow each other in the order of their texts' hashes;
    rows without an id come last. A single document is its own next. An empty table gives an empty result.

    Texts are moved once: to ranges of ids, whose bounds are quantiles. The head of each range is copied to the
    range before it, so that no order over the whole table is needed. The driver sees bounds and heads, a
    few for each shuffle partition. A task reads its ranges in a stream and holds two texts.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_bounds = 4 * partitions
    h1, h2 = hashes(F.coalesce(field(text), F.lit("")))
    rows = pack(docs).select(field(doc_id).cast("long").alias("_id"), field(text).alias("_text"), h1.alias("_h1"), h2.alias("_h2"))
    probabilities = [i / n_bounds for i in range(1, n_bounds)]
    quantiles = rows.agg(F.percentile_approx("_id", probabilities, 20 * n_bounds).alias("b")).first()["b"]
    bounds = np.unique(np.array(quantiles or [], np.int64))

    @F.arrow_udf("int")
    def bucket_of(ids: pa.Array) -> pa.Array:
        # Descending: the range of the largest ids is 0; one more for rows without an id.
        at = len(bounds) - np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), "left")
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        return pa.array(np.where(missing, len(bounds) + 1, at).astype(np.int32))

    numbered = rows.withColumn("_bucket", bucket_of("_id"))
    order = F.struct(F.col("_id"), F.col("_h1"), F.col("_h2"))
    found = rows.select("_id", "_h1", "_h2").withColumn("_bucket", bucket_of("_id")).groupBy("_bucket").agg(F.max(order).alias("head"))
    heads = sorted((r["_bucket"], tuple(r["head"])) for r in found.collect())
    # Who needs a head as its next: the range before, and the last range that of all.
    needed_by = {here: heads[i - 1][0] for i, (here, _) in enumerate(heads)}
    table = [(here, needed_by[here], *head) for here, head in heads]
    listed = spark.createDataFrame(table, "_bucket int, _to int, _hid long, _hh1 long, _hh2 long")
    is_head = (
        F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_h1") == F.col("_hh1")) & (F.col("_h2") == F.col("_hh2"))
    )
    # The ranges are as few as the bounds.
    marked = numbered.join(F.broadcast(listed), "_bucket")
    places = F.when(is_head, F.array(
        F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("border")),
        F.struct(F.col("_to").alias("b"), F.lit(True).alias("border")),
    )).otherwise(F.array(F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("border"))))
    spread = marked.select("_id", "_text", "_h1", "_h2", F.inline(places))
    ordered = spread.repartition(partitions, "b").sortWithinPartitions(
        "b", "border", F.col("_id").desc_nulls_last(), F.col("_h1").desc(), F.col("_h2").desc()
    )
    schema = pa.schema([
        (doc_id, pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("common_prefix", pa.int64()),
    ])
    return ordered.select("b", "border", "_id", "_text").mapInArrow(
        lambda batches: _edits(batches, schema), EDITS.format(id=f"`{doc_id}` bigint")
    )
