"""Benchmark decontamination: stream the words of documents through a suffix automaton of the test items.

The normalised test items make one generalised suffix automaton. A document is read word by word; the automaton's
state and the matching length say what the longest stretch of words up to here is that some item has as well. Where
the length reaches a window, the window's words are hit and its state names the items that have it. An item of fewer
words than a window must occur as a whole: it is one of the suffixes that the state stands for.

A set of test items is bounded by the people who write it, not by this code: items are cut into chunks that overlap
by a window, chunks are dealt to blocks of bounded size, and the documents are read once for each block. One block is
what the driver and a worker hold at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.rows import LOWER, ROW, UPPER, field, pack, unpack, write_step

CHUNK_WORDS = 2_000
BLOCK_BYTES = 2_000_000  # of item text; some 300,000 words, whose automaton takes about 200 MB

# Words are runs of a-z, digits and everything beyond ASCII; A-Z count as a-z.
_WORD_BYTES = b"0123456789" + LOWER.encode() + UPPER.encode() + bytes(range(128, 256))
_SPACED = bytes(b if b in _WORD_BYTES else 32 for b in range(256)).lower()
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SPAN = "struct<start: bigint, end: bigint, from_char: bigint, to_char: bigint>"
FOUND = f"struct<n_words: bigint, n_hit: bigint, longest: bigint, items: array<string>, spans: array<{SPAN}>>"


def words_of(raw: bytes) -> list[bytes]:
    """The normalised words of a text in UTF-8."""
    return raw.translate(_SPACED).split()


def word_places(raw: bytes, wanted: list[int]) -> list[tuple[int, int]]:
    """Where the words of ascending numbers begin and end in the text, in bytes."""
    spaced, places, number, at = raw.translate(_SPACED), [], 0, 0
    left = iter(wanted)
    want = next(left, None)
    for part in spaced.split(b" "):
        if part:
            while want == number:
                places.append((at, at + len(part)))
                want = next(left, None)
            if want is None:
                break
            number += 1
        at += len(part) + 1
    return places


# --- the automaton --------------------------------------------------------------------------------


class Hit(NamedTuple):
    n_words: int
    longest: int
    spans: list[tuple[int, int]]  # first word, word behind the last
    items: set[str]


class Automaton:
    """A generalised suffix automaton over words, with the items of each window and of each short item."""

    def __init__(self, items: list[tuple[str | None, list[bytes], bool]], window: int):
        """`items`: id, words, and whether these words are all that the item has."""
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], whole) for name, words, whole in items]
        for _, words, _ in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(coded)

    def _extend(self, last: int, word: int) -> int:
        step, link, length = self.step, self.link, self.length
        if word in step[last]:
            return self._exact(last, word)
        new = self._add(length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            link[new] = self._exact(at, word)
        return new

    def _exact(self, at: int, word: int) -> int:
        """The state that `at` leads to, split off from longer strings if it stands for such as well."""
        step, link, length = self.step, self.link, self.length
        to = step[at][word]
        if length[to] == length[at] + 1:
            return to
        split = self._add(length[at] + 1, step[to].copy(), link[to])
        link[to] = split
        while at >= 0 and step[at].get(word) == to:
            step[at][word] = split
            at = link[at]
        return split

    def _add(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _mark(self, coded: list[tuple[str | None, list[int], bool]]) -> None:
        """Which items a state of a window's length has, and which whole short items end in a state."""
        link, length = self.link, self.length
        # Of the strings a state stands for, its shortest suffixes of at least a window's length are one state's.
        self.of_window = [0] * len(link)
        for state in sorted(range(1, len(link)), key=length.__getitem__):
            if length[state] >= self.window:
                up = link[state]
                self.of_window[state] = self.of_window[up] if length[up] >= self.window else state
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, tuple[int, set[str]]] = {}
        for name, words, whole in coded:
            state = 0
            for n, word in enumerate(words, 1):
                state = self.step[state][word]
                if n >= self.window:
                    self.items.setdefault(self.of_window[state], set()).update([name] if name is not None else [])
            if whole and 0 < len(words) < self.window:
                self.short.setdefault(state, (len(words), set()))[1].update([name] if name is not None else [])
        # The nearest state among a state and its suffixes that ends a short item.
        self.near_short = [0] * len(link)
        if self.short:
            for state in sorted(range(1, len(link)), key=length.__getitem__):
                self.near_short[state] = state if state in self.short else self.near_short[link[state]]

    def find(self, raw: bytes) -> Hit:
        """All stretches of a text's words that lie in a window of an item, and these items."""
        words = words_of(raw)
        if not words:
            return Hit(0, 0, [], set())
        step, link, length, window = self.step, self.link, self.length, self.window
        near_short, any_short = self.near_short, bool(self.short)
        state = matched = longest = 0
        ends: list[tuple[int, int]] = []  # first word of a hit, word behind its last
        states: set[int] = set()
        shorts: set[int] = set()
        for at, word in enumerate(map(self.vocabulary.get, words), 1):
            to = step[state].get(word)
            if to is not None:
                matched += 1
            else:
                if word is not None:
                    while state and to is None:
                        state = link[state]
                        to = step[state].get(word)
                if to is None:
                    state = matched = 0
                    continue
                matched = length[state] + 1
            state = to
            if matched > longest:
                longest = matched
            if matched >= window:
                ends.append((at - window, at))
                # The state itself, or the one of its suffixes whose strings reach from a window's length on.
                states.add(self.of_window[state])
            if any_short:
                ending = near_short[state]
                while ending:
                    n = self.short[ending][0]
                    if n <= matched:
                        ends.append((at - n, at))
                        shorts.add(ending)
                    ending = near_short[link[ending]]
        items = set().union(*(self.items[s] for s in states), *(self.short[s][1] for s in shorts))
        return Hit(len(words), longest, merged(ends), items)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


# --- on tables ------------------------------------------------------------------------------------

_built: dict[str, Automaton] = {}


def _automaton(block, window: int) -> Automaton:
    """The automaton of a broadcast block, built once in each worker process; it holds one at a time."""
    name, items = block.value
    if name not in _built:
        _built.clear()
        _built[name] = Automaton([(i, words_of(raw), whole) for i, raw, whole in items], window)
    return _built[name]


def _found(block, window: int, text: Column, before: Column | None) -> Column:
    """What the items of a block have in common with the texts, together with what was found before."""

    def search(automaton: Automaton, texts: pa.Array, earlier: pa.Array | None) -> pa.Array:
        out = []
        for at, raw in enumerate(texts.cast(pa.binary()).to_pylist()):
            hit = automaton.find(raw or b"")
            spans, items, longest = hit.spans, hit.items, hit.longest
            if earlier is not None:
                old = earlier[at].as_py()
                spans = merged(spans + [(s["start"], s["end"]) for s in old["spans"]])
                items, longest = items.union(old["items"]), max(longest, old["longest"])
            out.append({
                "n_words": hit.n_words, "n_hit": sum(end - start for start, end in spans), "longest": longest,
                "items": sorted(items), "spans": _placed(raw, spans) if spans else [],
            })
        return pa.array(out, type=FOUND_TYPE)

    if before is None:

        @F.arrow_udf(FOUND)
        def first(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            automaton = _automaton(block, window)
            for texts in batches:
                yield search(automaton, texts, None)

        return first(text)

    @F.arrow_udf(FOUND)
    def further(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        automaton = _automaton(block, window)
        for texts, earlier in batches:
            yield search(automaton, texts, earlier)

    return further(text, before)


_SPAN_TYPE = pa.struct([(n, pa.int64()) for n in ("start", "end", "from_char", "to_char")])
FOUND_TYPE = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(_SPAN_TYPE)),
])


def _placed(raw: bytes, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Spans of words with their places in code points."""
    places = word_places(raw, [w for start, end in spans for w in (start, end - 1)])
    out, chars, upto = [], 0, 0

    def char_of(byte: int) -> int:
        nonlocal chars, upto
        chars += len(raw[upto:byte].decode())
        upto = byte
        return chars

    for (start, end), (a, _), (_, b) in zip(spans, places[::2], places[1::2], strict=True):
        out.append({"start": start, "end": end, "from_char": char_of(a), "to_char": char_of(b)})
    return out


def _chunks(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """The items as texts of so many words, which overlap by a window less one: id, raw text, whether it is all."""
    spaced = F.trim(F.regexp_replace(F.translate(field(text), UPPER, LOWER), NOT_WORD, " "))
    items = pack(benchmark).select(field(item_id).cast("string").alias("_item"), F.split(spaced, " ").alias("_words"))
    items = items.filter(F.element_at("_words", 1) != "")
    size, overlap = max(CHUNK_WORDS, window), window - 1
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - overlap - 1, F.lit(0)), F.lit(size))
    return items.select("_item", "_words", F.explode(starts).alias("_start")).select(
        "_item", F.array_join(F.slice("_words", F.col("_start") + 1, F.lit(size + overlap)), " ").alias("_chunk"),
        (F.size("_words") <= size + overlap).alias("_whole"),
    ).distinct()


def find_items(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The columns of `docs` and what their texts share with test items.

    n_words: words of the text; n_hit: those inside an occurrence of `window` consecutive words of an item, or of all
    words of an item that has fewer; longest: the longest stretch of words that an item has as well (items are cut at some
    2,000 words, it ends there); items: the ids, as
    strings in code-point order, of the items with an occurrence; spans: the stretches of hit words (first word, word
    behind the last, the same in code points), merged where they touch.

    A null text has no words, a null or wordless item no window, and an empty table on either side no hit. An item
    without an id hits words and is not listed; rows of one id are one item; equal rows each get their result. A result
    column replaces a column of its name. A worker holds one block of items and one batch of texts.
    """
    spark = docs.sparkSession
    chunks = write_step(_chunks(benchmark, item_id, item_text, window), "test-items")
    total = chunks.agg(F.sum(F.octet_length("_chunk"))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    dealt = chunks.withColumn("_block", F.pmod(F.xxhash64("_item", "_chunk"), F.lit(n_blocks)))
    rows = pack(docs).select(ROW)
    for number in range(n_blocks):
        # One block: its size is bounded above, whatever the number of items.
        items = [(r["_item"], r["_chunk"].encode(), r["_whole"]) for r in dealt.filter(F.col("_block") == number).collect()]
        block = spark.sparkContext.broadcast((uuid.uuid4().hex, items))
        found = _found(block, window, field(text), F.col("_found") if number else None)
        rows = rows.select(ROW, found.alias("_found"))
        if number < n_blocks - 1:
            rows = write_step(rows, "shared-words")
    results = {n: F.col("_found").getField(n) for n in ("n_words", "n_hit", "longest", "items", "spans")}
    return unpack(rows, docs.columns, **results)


def without_spans(text: Column, spans: Column) -> Column:
    """The text without its spans; null stays null."""
    end_of = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(spans, (i - 1).cast("int"))["to_char"])
    begin_of = lambda i: F.coalesce(F.get(spans, i.cast("int"))["from_char"], F.char_length(text))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.substring(text, (end_of(i) + 1).cast("int"), (begin_of(i) - end_of(i)).cast("int")),
    )
    return F.when(F.size(spans) == 0, text).otherwise(F.array_join(pieces, ""))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, longest: int = 50, coverage: float = 0.5,
    text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """`docs` without what they share with test items, in their own columns.

    A document goes where it has a stretch of at least `longest` words of an item, or more than a share of `coverage`
    of its words is hit. Of the others the hit spans go. For odd rows see `find_items`.
    """
    packed = pack(docs).select(ROW, field(text).alias("text"))
    found = find_items(packed, benchmark, window, "text", item_id, item_text)
    kept = found.filter((F.col("longest") < longest) & (F.col("n_hit") <= F.col("n_words") * F.lit(coverage)))
    return unpack(kept.select(ROW, without_spans(F.col("text"), F.col("spans")).alias("_text")), docs.columns, **{text: F.col("_text")}).select(*docs.columns)
