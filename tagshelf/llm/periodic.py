"""Runs of periodic words: maximal pairs out of the LCP-interval tree of a text's suffixes.

Two places of a text are a maximal pair if the same words stand from both on, the words behind these differ, and so do
the words before the two places. Where the common words are at least three times as many as the places are apart,
they overlap, and the stretch from the first place to the end of the second's words is periodic with the distance as
its period, four times over; as a maximal pair it cannot be extended either way. So the runs are read off the pairs.

The suffixes of many texts are sorted together, by doubling the number of words that are compared; suffixes whose first
words occur once in their text have no partner and are left out early. The intervals of the sorted suffixes that share
their first words are a tree, which is walked bottom up. Each interval keeps its places in order, with the word before
each place as its class. When an interval is joined to another, only neighbours in that order can be a run's pair: an
occurrence between two that are a period apart would give a shorter period. Neighbours of one class are no maximal pair.
The smaller list is put into the larger one, so that a place moves a logarithmic number of times.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.rows import ROW, field, pack, unpack

REPEATS = 4  # a run's length is at least so many periods
LEAST = 6  # and at least so many words
FIRST = 4  # a power of two; a pair that matters has more words than this in common
AT_ONCE = 500_000  # words whose suffixes are sorted together; one text is never split

RUN = "struct<start: bigint, length: bigint, period: bigint>"
FOUND = f"struct<n_words: bigint, runs: array<{RUN}>, collapsed: string>"
_RUN_TYPE = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
_FOUND_TYPE = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN_TYPE)), ("collapsed", pa.string())])


# --- sorted suffixes ------------------------------------------------------------------------------


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Equal numbers for equal keys, in their order."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def repeated_suffixes(words: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """The places whose next FIRST words occur again in their text, sorted by text and by all words that follow.

    `words` has a number below those of all words at the end of each text, and there alone.
    """
    n = len(words)
    rank, k = words.astype(np.int64), 1
    while k < FIRST:
        behind = np.zeros(n, np.int64)
        behind[:-k] = rank[k:] + 1
        rank = _ranks(rank * (behind.max() + 1) + behind)
        k *= 2
    key = text_of * (rank.max() + 1) + rank
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.append(True, sorted_key[1:] != sorted_key[:-1])
    # A suffix's rank is the place of the first suffix with the same words; whoever is alone there keeps it for good.
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    alone = head & np.append(head[1:], True)
    at = np.flatnonzero(~alone)
    repeated, slots = order[at], at
    open_, k = np.arange(len(at)), FIRST
    # `open_`: the slots, among those of repeated suffixes, whose order is still open.
    while open_.size:
        suffix = repeated[open_]
        ahead = np.minimum(suffix + k, n - 1)
        keys = np.stack([rank[ahead], rank[suffix]])
        by = np.lexsort(keys)
        suffix, (second, first) = suffix[by], keys[:, by]
        repeated[open_] = suffix
        new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        rank[suffix] = slots[open_][np.flatnonzero(new)[np.cumsum(new) - 1]]
        open_ = open_[~(new & np.append(new[1:], True))]
        k *= 2
    return repeated


def common_words(words: list[int], suffixes: list[int]) -> list[int]:
    """For each suffix of one text, in sorted order, how many words it has in common with the one before it.

    In the order of the text: the suffix one word on has at most one word less in common with some other.
    """
    place = {at: i for i, at in enumerate(suffixes)}
    common, n, last, h = [0] * len(suffixes), len(words), -2, 0
    for at in sorted(suffixes):
        i = place[at]
        if not i:
            last = -2
            continue
        # With fewer, the suffix before it among all may be one that was left out.
        h = h - 1 if at == last + 1 and h > FIRST else 0
        other = suffixes[i - 1]
        most = n - max(at, other)
        while h < most and words[at + h] == words[other + h]:
            h += 1
        common[i], last = h, at
    return common


# --- the interval tree ----------------------------------------------------------------------------


def _join(a: list[int], b: list[int], common: int, words: list[int], runs: dict[tuple[int, int], int]) -> list[int]:
    """The places of two parts of an interval in one list; their maximal pairs that are runs go to `runs`."""
    large, small = (a, b) if len(a) >= len(b) else (b, a)
    reach, n = common // (REPEATS - 1), len(large)
    for x in small:
        i = bisect_left(large, x)
        for y in (large[i - 1] if i else -1, large[i] if i < n else -1):
            if y < 0:
                continue
            first, period = (x, y - x) if x < y else (y, x - y)
            # Their classes are the words before them; the beginning of a text is a class of its own.
            if period <= reach and common + period >= LEAST and (not first or words[x - 1] != words[y - 1]):
                key = (first, common + period)
                if period < runs.get(key, period + 1):
                    runs[key] = period
    if len(small) * 8 < n:
        for x in small:
            insort(large, x)
    else:
        large += small
        large.sort()
    return large


def runs_of(words: list[int], suffixes: list[int]) -> list[tuple[int, int, int]]:
    """start, length and period of the runs of a text, by start and period, from its repeated suffixes in order.

    A stretch is found once for each multiple of its period that still repeats often enough; the least is its period.
    """
    runs: dict[tuple[int, int], int] = {}
    common = common_words(words, suffixes)
    open_: list[tuple[int, list[int]]] = []  # intervals whose end is not reached, each with more in common
    for i, suffix in enumerate(suffixes):
        h = common[i] if common[i] > FIRST else 0
        if i:
            done = [suffixes[i - 1]]
            while open_ and open_[-1][0] > h:
                depth, places = open_.pop()
                done = _join(places, done, depth, words, runs)
            if h:
                if open_ and open_[-1][0] == h:
                    done = _join(open_.pop()[1], done, h, words, runs)
                open_.append((h, done))
    if suffixes:
        done = [suffixes[-1]]
        while open_:
            depth, places = open_.pop()
            done = _join(places, done, depth, words, runs)
    return sorted(((start, length, period) for (start, length), period in runs.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by a blank."""
    kept, at = [], 0
    dropped = sorted((start + period, start + length) for start, length, period in runs)
    for start, end in dropped:
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    return b" ".join(kept + words[at:])


# --- on tables ------------------------------------------------------------------------------------


def _search(texts: list[list[bytes]]) -> list[dict]:
    """n_words, runs and collapsed text of each text, given as its words."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = lambda: len(numbers) + 1
    lengths = np.array([len(words) for words in texts])
    coded = np.zeros(int(lengths.sum()) + len(texts), np.int64)  # 0 behind each text
    first = np.append(0, np.cumsum(lengths + 1))
    for a, words in zip(first, texts, strict=False):
        coded[a : a + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    suffixes = repeated_suffixes(coded, np.repeat(np.arange(len(texts)), lengths + 1))
    of_text = np.searchsorted(first, suffixes, "right") - 1
    bounds = np.searchsorted(of_text, np.arange(len(texts) + 1))
    out = []
    for i, words in enumerate(texts):
        a, b = bounds[i], bounds[i + 1]
        runs = runs_of(coded[first[i] : first[i + 1] - 1].tolist(), (suffixes[a:b] - first[i]).tolist()) if b > a else []
        out.append({
            "n_words": len(words), "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs],
            "collapsed": collapsed(words, runs).decode(),
        })
    return out


def periodic_runs(text: Column) -> Column:
    """n_words, runs (start, length and period, in words, by start and period) and collapsed, the text without repeats.

    Words are what stands between blanks and the control characters 9 to 13. A run is a stretch of at least LEAST words
    and REPEATS times its smallest period that cannot be extended. collapsed has the words joined by a blank that are
    not, in any run, behind its first period. A null, empty or blank text has no words and no runs, and is collapsed to
    the empty text. A worker holds AT_ONCE words, or one text if that has more.
    """

    @F.arrow_udf(FOUND)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found, group, held = [], [], 0
            for raw in texts.cast(pa.binary()):
                words = (raw.as_py() or b"").split()
                if group and held + len(words) > AT_ONCE:
                    found += _search(group)
                    group, held = [], 0
                group.append(words)
                held += len(words)
            yield pa.array(found + (_search(group) if group else []), type=_FOUND_TYPE)

    return find(text)


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of `docs` with n_words, runs and collapsed of their texts (see `periodic_runs`).

    Equal rows each get their result, an empty table none; a result column replaces a column of its name.
    """
    found = pack(docs).select(ROW, periodic_runs(field(text)).alias("_found"))
    return unpack(found, docs.columns, **{n: F.col("_found").getField(n) for n in ("n_words", "runs", "collapsed")})


def longest_run(runs: Column) -> Column:
    """The longest of the runs; of several the first, then that of the smallest period; null if there are none."""
    # Runs are in the order of start and period: array_max of the length, and of the place from the end.
    placed = F.transform(runs, lambda r, i: F.struct(r["length"].alias("length"), (-i).alias("before"), r.alias("run")))
    return F.array_max(placed)["run"]


def repeat_words(text: Column, start: Callable[[Column], Column], period: Callable[[Column], Column]) -> Column:
    """The text's words joined by a blank, where from word `start` on the first `period` words of there come again and
    again; both are given the number of words, which is not 0. Null stays null."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        source = lambda i: F.when(i < start(n), i).otherwise(start(n) + (i - start(n)) % period(n))
        moved = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, source(i).cast("int")))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    # As an element of an array the words are a variable: they are split once, not for each of them.
    return F.get(F.transform(F.array(words), repeated), 0)
