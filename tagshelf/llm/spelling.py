"""Spelling variants: words one edit apart, found by products of letter-count matrices.

One replaced letter changes two letter counts of a word by one, an inserted or deleted letter changes one. So the squared
distance of the count vectors of two such words is at most two, and their lengths differ by at most one. A product of two
blocks of count vectors gives all squared distances between them at once; pairs at most two apart are verified letter by
letter.

A block holds words of one length that also agree in the sums of their counts over a few groups of letters. An edit adds
one to one of the sums, or moves one from a sum to another, so that a block need only be compared with itself and with
its neighbours under such steps: blocks of the same and of the next length. Of two neighbours, one visits the other. A
large block is cut into pieces, and a large crowd of visitors into slots, so that what one task compares is bounded.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.rows import LOWER, UPPER, field, pack, write_step

GROUPS = 6  # a letter's group is its code point modulo this
PIECE, SLOT = 2_048, 16_384  # words of a block, and visitors to it, that one task compares (on average)
COLUMNS = 4_096  # of them at a time
HELD = 300_000  # different words that a task counts before it hands them over

# The letters of words are A-Z, a-z and the code points C0 to FF: one byte each in Latin-1. A-Z count as a-z.
LETTERS = LOWER.encode() + bytes(range(0xC0, 0x100))
_SPACED = bytes(b if b in LETTERS + UPPER.encode() else 32 for b in range(256)).lower()

Change = Callable[[object, list[bytes]], list[bytes]]
NEAR = "word string, n_near bigint, best struct<minus_n: bigint, form: string>"
_NEAR_TYPE = pa.schema([
    ("word", pa.string()), ("n_near", pa.int64()), ("best", pa.struct([("minus_n", pa.int64()), ("form", pa.string())])),
])


# --- the words of a corpus ------------------------------------------------------------------------


def count_words(docs: DataFrame, least_letters: int = 1, change: Change | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n, how often it occurs, of the words of all texts: maximal runs of letters, A-Z as a-z.

    `change` is given a document's id and its different words in Latin-1, and returns each as it is to be counted; it
    makes no word longer. Words of fewer than `least_letters` letters are left out. A null text has no words; equal rows
    each count. A task adds up its words before they are shuffled, and holds HELD different ones and a batch of texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def handed() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            batch = pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                letters = (raw.as_py() or "").encode("latin-1", "replace").translate(_SPACED)
                own = Counter(w for w in letters.split() if len(w) >= least_letters)
                if change is None:
                    total.update(own)
                    continue
                for word, n in zip(change(name, list(own)), own.values(), strict=True):
                    if len(word) >= least_letters:
                        total[word] += n
            if len(total) >= HELD:
                yield handed()
        yield handed()

    rows = pack(docs).select(field(doc_id).alias("doc_id"), field(text).alias("text"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# --- near words of blocks -------------------------------------------------------------------------


def _letters(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def _counts(letters: np.ndarray) -> np.ndarray:
    """Letter counts of words, a row each, in a type whose products are exact."""
    m, length = letters.shape
    at = np.arange(m)[:, None] * 256 + letters
    counts = np.bincount(at.ravel(), minlength=m * 256).reshape(m, 256)[:, np.frombuffer(LETTERS, np.uint8)]
    return counts.astype(np.float32 if length < 4_000 else np.float64)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows differ by one replaced letter, or by one letter that `b`, of the next length, has more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    same_before = np.logical_and.accumulate(a == b[:, :-1], 1).sum(1)
    same_behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], 1).sum(1)
    return same_before + same_behind >= a.shape[1]


def near_pairs(a: list[bytes], b: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of `a` and `b` that are one edit apart; with None, pairs within `a`, each once.

    The words of `a` have one length, as have those of `b`, which is the same or one more.
    """
    own = _letters(a, len(a[0]))
    other = own if b is None else _letters(b, len(b[0]))
    x = _counts(own)
    squares = (x * x).sum(1)
    left, right = [], []
    for first in range(0, len(other), COLUMNS):
        part = other[first : first + COLUMNS]
        y = _counts(part)
        distances = squares[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)
        i, j = np.nonzero(distances <= 2)
        if b is None:
            i, j = i[i < j + first], j[i < j + first]
        for at in range(0, len(i), 100_000):
            k, m = i[at : at + 100_000], j[at : at + 100_000]
            near = _one_edit(own[k], part[m])
            left.append(k[near])
            right.append(m[near] + first)
    none = np.empty(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _compare(table: pa.Table) -> pa.Table:
    """The near words of a task's words: for each word their number and the most frequent one."""
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    n, home = table.column("n").to_pylist(), np.array(table.column("home").to_pylist())
    own, guests = np.flatnonzero(home), np.flatnonzero(~home)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if own.size:
        length = len(words[own[0]])
        named = lambda at: [words[i] for i in at.tolist()]
        if table.column("slot")[0].as_py() == 0:
            i, j = near_pairs(named(own), None)
            found.append((own[i], own[j]))
        same = guests[[len(words[i]) == length for i in guests.tolist()]] if guests.size else guests
        short = np.setdiff1d(guests, same)
        if same.size:
            i, j = near_pairs(named(own), named(same))
            found.append((own[i], same[j]))
        if short.size:
            i, j = near_pairs(named(short), named(own))
            found.append((short[i], own[j]))
    near: dict[int, int] = {}
    best: dict[int, tuple[int, bytes]] = {}
    for i, j in found:
        for a, b in [*zip(i.tolist(), j.tolist(), strict=True), *zip(j.tolist(), i.tolist(), strict=True)]:
            near[a] = near.get(a, 0) + 1
            best[a] = min(best.get(a, (1, b"")), (-n[b], words[b]))
    rows = [{"word": words[a].decode("latin-1"), "n_near": k, "best": {"minus_n": best[a][0], "form": best[a][1].decode("latin-1")}} for a, k in near.items()]
    return pa.Table.from_pylist(rows, _NEAR_TYPE)


# --- near words of a vocabulary -------------------------------------------------------------------


def _sums(word: Column) -> list[Column]:
    """The letters of a word in each group."""
    groups = [bytes(b for b in LETTERS if b % GROUPS == g).decode("latin-1") for g in range(GROUPS)]
    return [F.char_length(word) - F.char_length(F.translate(word, letters, "")) for letters in groups]


def _visited(block: Column) -> Column:
    """The blocks that a block's words visit: one letter more in a group, or one moved to an earlier group."""
    sums = [block[g] for g in range(GROUPS)]
    moved = lambda more, less: F.array(*[s + (int(g == more) - int(g == less)) for g, s in enumerate(sums)])
    longer = [moved(g, None) for g in range(GROUPS)]
    return F.array(*longer, *[moved(a, b) for a in range(GROUPS) for b in range(a + 1, GROUPS)])


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, n_near and best (minus_n, form) of the words with near words: how many there are, and of these the one with
    the largest n, of several the first in code-point order. `vocabulary` has each word once, and its n.
    """
    n_tasks = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = write_step(vocabulary.select("word", "n", F.array(*_sums(F.col("word"))).alias("block")), "words")
    pieces = F.ceil(F.count("*") / PIECE).cast("int")
    blocks = write_step(words.groupBy("block").agg(F.count("*").alias("members"), pieces.alias("pieces")), "blocks")
    dealt = words.join(blocks, "block").select(
        "word", "n", "block", "pieces", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int").alias("piece")
    )
    # Counting per block first: the members of a block all visit the same blocks.
    crowds = blocks.select(F.explode(_visited(F.col("block"))).alias("block"), F.col("members").alias("guests"))
    crowds = crowds.unionByName(blocks.filter("pieces > 1").select("block", F.col("members").alias("guests")))
    crowds = crowds.groupBy("block").agg(F.sum("guests").alias("guests"))
    rooms = write_step(
        blocks.join(crowds, "block", "left").select(
            "block", "pieces", F.greatest(F.lit(1), F.ceil(F.coalesce("guests", F.lit(0)) / SLOT)).cast("int").alias("slots")
        ),
        "rooms",
    )
    slot_of = F.pmod(F.xxhash64(F.lit(1), "word"), F.col("slots")).cast("int")
    span = lambda first, behind: F.explode(F.when(behind > first, F.sequence(first, behind - 1)))
    at_home = dealt.drop("pieces").join(rooms, "block").select(
        "block", "piece", span(F.lit(0), F.col("slots")).alias("slot"), "word", "n", F.lit(True).alias("home")
    )
    neighbours = dealt.filter("pieces > 1").drop("pieces").join(rooms, "block").select(
        "block", span(F.col("piece") + 1, F.col("pieces")).alias("piece"), slot_of.alias("slot"), "word", "n", F.lit(False).alias("home")
    )
    guests = words.select("word", "n", F.explode(_visited(F.col("block"))).alias("block")).join(rooms, "block").select(
        "block", span(F.lit(0), F.col("pieces")).alias("piece"), slot_of.alias("slot"), "word", "n", F.lit(False).alias("home")
    )
    met = at_home.unionByName(neighbours).unionByName(guests)
    # So many tasks whatever the bytes: the products are the work, not the words.
    task = ["block", "piece", "slot"]
    near = met.repartition(n_tasks, *task).groupBy(*task).applyInArrow(_compare, NEAR)
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """word and root: forms of forms, until no form has one. A form occurs several times as often as its word, so that
    the way is short, and it halves each time."""
    links = write_step(links, "forms")
    while True:
        up = links.select(F.col("word").alias("at"), F.col("root").alias("above"))
        links = write_step(
            links.select("word", "root").join(up, F.col("root") == F.col("at"), "left")
            .select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")),
            "roots",
        )
        if links.filter("moved").isEmpty():
            return links.select("word", "root")


def group_variants(counted: DataFrame, ratio: int = 5) -> DataFrame:
    """Words with their standard forms: word, form, root, n, n_near, form_n.

    `counted` has each word once, with its n; words are of the letters that `count_words` knows. Two words are near that
    differ by one inserted, deleted or replaced letter. A word's form is the near word of largest n, ties by code point,
    if that is at least `ratio` (2 or more) times the word's own n; root is where forms of forms end, or the word itself.
    Null words are left out, as are null counts; the empty table gives an empty one. Other columns are dropped.
    """
    if ratio < 2:
        raise ValueError("a form is to occur at least twice as often, else forms could go in circles")
    vocabulary = write_step(counted.select("word", "n").filter("word IS NOT NULL AND n IS NOT NULL"), "vocabulary")
    near = near_words(vocabulary)
    best_n = -F.col("best.minus_n")
    is_form = best_n >= F.col("n") * ratio
    judged = write_step(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, best_n).alias("form_n"),
        ),
        "near-words",
    )
    roots = _roots(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
