"""Byte pair encoding by forced boundaries, and decoding.

Byte pair encoding only ever joins neighbours into tokens of its vocabulary. Where two neighbouring symbols
stand next to each other inside no token at all, nothing can be joined across them: a cut there is certain,
the fragments on both sides can be encoded on their own, and their ids put together are those of the whole.

Texts are cut at white space first, which no token contains but at its start. The pieces are cut further at
the pairs of symbols that no token contains. The fragments that a batch of texts adds are encoded together, those of
one length as the rows of a matrix, and pieces seen lately are remembered in a table of bounded size.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.rows import field, pack

NEVER = np.iinfo(np.int32).max
LONG = 64  # symbols from which on a fragment is encoded on its own, with a heap
REMEMBERED = 200_000  # pieces
MARKS = frozenset([b".", b",", b";", b":", b"!", b"?"])
AT_ONCE = 2 << 20  # bytes of text that are encoded together

# Precomposed Latin letters: normal forms leave them alone, and each has one lower case of its own.
LATIN = "À-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[\t-\r -~{LATIN}]*")
ENDED_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^\\sa-z0-9{LATIN}]+")
SPACED_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z{LATIN}]+| ?[0-9]+| ?[^\\sA-Za-z0-9{LATIN}]+|\\s+(?!\\S)|\\s+"
)

# White space beyond ASCII's: separators of the control range, and what starts other spaces in UTF-8; and zero,
# which marks keys.
OTHER_SPACE = [b"\0", b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"]
SPACE_BY_SPACE = [b"  ", *[x for c in b"\t\n\x0b\f\r" for x in (bytes([32, c]), bytes([c, 32]))]]
SPACED = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself if it is printable
    Latin, else the next free letter from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class Joins:
    """Which pairs of tokens become which token, at which rank; found by hashing, for whole arrays at once."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        self.by_pair: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.by_pair[vocabulary[left], vocabulary[right]] = rank, vocabulary[left + right]
        self.bits = max(8, (4 * len(self.by_pair)).bit_length())
        size = 1 << self.bits
        self.key, self.rank, self.token = np.full(size, -1, np.int64), np.full(size, NEVER, np.int32), np.zeros(size, np.int32)
        self.probes = 1
        for (left, right), (rank, token) in self.by_pair.items():
            key, at, probe = left << 32 | right, int(self._at(np.array([left << 32 | right]))[0]), 1
            while self.key[at] != -1:
                at, probe = (at + 1) % size, probe + 1
            self.key[at], self.rank[at], self.token[at] = key, rank, token
            self.probes = max(self.probes, probe)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER without a join) and token of each pair; ids below 0 are in no pair."""
        keys = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        at = self._at(keys)
        found = self.key[at]
        rank, token = np.where(found == keys, self.rank[at], NEVER), self.token[at]
        open_ = np.flatnonzero((found != keys) & (found != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) % len(self.key)
            there = self.key[at[open_]]
            hit = open_[there == keys[open_]]
            rank[hit], token[hit] = self.rank[at[hit]], self.token[at[hit]]
            open_ = open_[(there != keys[open_]) & (there != -1)]
        return rank, token

    def rows(self, ids: np.ndarray) -> np.ndarray:
        """Fragments of one length, a row each, in place: the lowest rank of a row is joined first, of equal ones
        the leftmost, until none is left. Freed places are -1 at the right."""
        alive, work = np.arange(len(ids)), ids.copy()
        ids[:] = -1
        rank, token = (x.reshape(len(ids), -1) for x in self.find(work[:, :-1].ravel(), work[:, 1:].ravel()))
        while len(alive):
            width, row = work.shape[1], np.arange(len(alive))
            place = rank.argmin(1) if width > 1 else np.zeros(len(alive), np.int64)
            going = rank[row, place] != NEVER if width > 1 else np.zeros(len(alive), bool)
            if not going.all():
                ids[alive[~going], :width] = work[~going]
                alive, work, rank, token, place = alive[going], work[going], rank[going], token[going], place[going]
                row = np.arange(len(alive))
                if not len(alive):
                    break
            # Every row that goes on loses one place: what is behind it moves up.
            work[row, place] = token[row, place]
            work = np.where(np.arange(width - 1) > place[:, None], work[:, 1:], work[:, :-1])
            behind = np.arange(width - 2) >= place[:, None]
            rank = np.where(behind, rank[:, 1:], rank[:, :-1])
            token = np.where(behind, token[:, 1:], token[:, :-1])
            for at in (place - 1, place):
                has = np.flatnonzero((at >= 0) & (at < width - 2))
                rank[has, at[has]], token[has, at[has]] = self.find(work[has, at[has]], work[has, at[has] + 1])
        return ids

    def one(self, ids: list[int]) -> list[int]:
        """The same for a single long fragment, with a linked list and a heap."""
        joins, n = self.by_pair, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(join[0], i, ids[i], ids[i + 1], join[1]) for i in range(n - 1) if (join := joins.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, token = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = token, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if join := joins.get((token, ids[after[i]])):
                    heapq.heappush(heap, (join[0], i, token, ids[after[i]], join[1]))
            if before[i] >= 0 and (join := joins.get((ids[before[i]], token))):
                heapq.heappush(heap, (join[0], before[i], ids[before[i]], token, join[1]))
        return [i for i in ids if i >= 0]


class Bpe:
    """A byte-level tokenizer file, of words with ends or of words with a space before them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, self.library = spec["model"], Tokenizer.from_file(path)
        vocabulary, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.joins = Joins(vocabulary, model["merges"])
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        # Symbols: 0 to 255 a byte, 256 to 511 a byte that ends its word.
        self.symbol_id = np.array([vocabulary[c] for c in letters] + [vocabulary[c + self.suffix] for c in letters], np.int32)
        self.inside = np.zeros((512, 512), bool)
        for token in vocabulary:
            symbols = self._symbols(token)
            self.inside[symbols[:-1], symbols[1:]] = True
        self._forget()

    def _symbols(self, token: str) -> list[int]:
        ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
        symbols = [self.byte_of[c] for c in (token[: -len(self.suffix)] if ends else token)]
        return [*symbols[:-1], symbols[-1] + 256] if ends else symbols

    def _forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.starts, self.flat = np.zeros(1, np.int64), np.empty(0, np.int32)

    def _keep(self, pieces: set[bytes]) -> None:
        """Remember no others but these."""
        kept = list(pieces & self.slots.keys())
        slots = np.fromiter(map(self.slots.__getitem__, kept), np.int64, len(kept))
        self.flat, length = self._gather(slots)
        self.starts = np.append(0, np.cumsum(length))
        self.slots = dict(zip(kept, range(len(kept)), strict=True))

    def _gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in `slots` one after the other, and the number of ids of each."""
        start, length = self.starts[slots], self.starts[slots + 1] - self.starts[slots]
        ends = np.cumsum(length)
        where = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)
        return self.flat[where], length

    # --- texts to pieces that are encoded independently -------------------------------------------

    def pieces(self, text: bytes) -> list[bytes]:
        """Pieces as keys: for spaced words, what stands behind a single space is itself the key, and
        anything else has a zero byte before it."""
        if self.suffix:
            return text.split()  # the file drops white space
        if any(x in text for x in OTHER_SPACE):
            return [b"\0" + text]
        if any(x in text for x in SPACE_BY_SPACE):
            return [b"\0" + p for p in SPACED.findall(text)]
        found = text.split(b" ")
        if not found[0]:
            return found[1:]
        found[0] = b"\0" + found[0]
        return found

    # --- pieces to words, the units that the file's own rules encode one by one -------------------

    def words(self, piece: bytes) -> list:
        """Words as bytes; a special token as its id."""
        text = piece.decode()
        if not self.suffix:
            text = text[1:] if text[:1] == "\0" else " " + text
        if self.special_pattern and "<" in text:
            out = []
            for part in self.special_pattern.split(text):
                out += [self.special[part]] if part in self.special else self._words(part)
            return out
        return self._words(text)

    def _words(self, text: str) -> list[bytes]:
        if PLAIN.fullmatch(text):
            found = ENDED_WORDS.findall(text.lower()) if self.suffix else SPACED_WORDS.findall(text)
            return [w.encode() for w in found]
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        # The library's own splitter gives words in letters that stand for bytes.
        return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    # --- fragments to ids -------------------------------------------------------------------------

    def _encode_words(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word ends."""
        special = {i: w for i, w in enumerate(words) if not isinstance(w, bytes)}
        raw = [b"\0" if i in special else w for i, w in enumerate(words)] if special else words
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        if self.suffix:
            symbols[ends - 1] += 256
        starts_fragment = np.ones(len(symbols), bool)
        starts_fragment[1:] = ~self.inside[symbols[:-1], symbols[1:]]
        starts_fragment[(ends - lengths)] = True
        start = np.flatnonzero(starts_fragment)
        size = np.diff(np.append(start, len(symbols)))
        ids = self.symbol_id[symbols]
        for length in np.unique(size):
            if length == 1:
                continue
            at = start[size == length]
            if length < LONG:
                where = at[:, None] + np.arange(length)
                ids[where] = self.joins.rows(ids[where])
            else:
                for a in at:
                    joined = self.joins.one(ids[a : a + length].tolist())
                    ids[a : a + length] = -1
                    ids[a : a + len(joined)] = joined
        for i, token in special.items():
            ids[ends[i] - 1] = token
        kept = ids >= 0
        return ids[kept], np.cumsum(kept)[ends - 1]

    def _remember(self, pieces: list[bytes]) -> None:
        # Pieces of ASCII letters are one word each, whatever the rules; they come first.
        # So are the letters before a single mark, and the mark.
        plain = [p for p in pieces if p.isalpha()]
        marked = [p for p in pieces if p[-1:] in MARKS and p[:-1].isalpha()]
        others = list(set(pieces).difference(plain, marked))
        words = [self.words(p) for p in others]
        counts = np.concatenate([
            np.ones(len(plain), np.int64), np.full(len(marked), 2), np.fromiter(map(len, words), np.int64, len(words))
        ])
        as_word = bytes.lower if self.suffix else b" ".__add__
        flat_words = list(map(as_word, plain))
        for p in marked:
            flat_words += (as_word(p[:-1]), p[-1:])
        flat_words += itertools.chain.from_iterable(words)
        if flat_words:
            ids, ends = self._encode_words(flat_words)
        else:
            ids, ends = np.empty(0, np.int32), np.empty(0, np.int64)
        piece_ends = np.append(0, ends)[np.cumsum(counts)]
        known = len(self.starts) - 1
        self.slots.update(zip(plain + marked + others, range(known, known + len(pieces)), strict=True))
        self.starts = np.concatenate([self.starts, self.starts[-1] + piece_ends])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        listed = [self.pieces(t) for t in texts]
        used = set().union(*listed)
        new = used - self.slots.keys()
        if len(self.slots) + len(new) > REMEMBERED:
            self._keep(used)
        self._remember(list(new))
        counts = np.fromiter(map(len, listed), np.int64, len(listed))
        every = itertools.chain.from_iterable(listed)
        ids, length = self._gather(np.fromiter(map(self.slots.__getitem__, every), np.int64, int(counts.sum())))
        total = np.append(0, np.cumsum(length))
        return ids, np.diff(total[np.append(0, np.cumsum(counts))])


@functools.cache
def load(path: str) -> Bpe:
    """One per worker process."""
    return Bpe(path)


def text_bytes(texts: pa.Array) -> list[bytes]:
    """The texts in UTF-8; null is empty."""
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in texts.cast(pa.large_binary())]


def in_portions(texts: list[bytes], most: int = AT_ONCE) -> Iterator[list[bytes]]:
    """Whole texts in their order, about `most` bytes at a time; a longer text comes alone."""
    portion, size = [], 0
    for t in texts:
        if portion and size + len(t) > most:
            yield portion
            portion, size = [], 0
        portion.append(t)
        size += len(t)
    if portion:
        yield portion


def encode_text(text: Column, path: str) -> Column:
    """array<int> of the token ids of a text, as the library gives them without added special tokens; the strings
    of special tokens in a text are these tokens, as in the library. A null or empty text has no ids.

    Texts are taken whole. A worker holds one batch, which Spark bounds in bytes, the ids of it, and its table
    of pieces. `path`: a tokenizer file that every worker has.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for texts in batches:
            parts = [bpe.encode(portion) for portion in in_portions(text_bytes(texts))]
            ids = np.concatenate([np.empty(0, np.int32), *[p[0] for p in parts]])
            ends = np.append(0, np.cumsum(np.concatenate([np.empty(0, np.int64), *[p[1] for p in parts]])))
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))

    return encode(text)


def decode_ids(ids: Column, path: str) -> Column:
    """The text that the library decodes from ids, special tokens kept. No ids give an empty text, ids that
    the file does not have give nothing. A file without a decoder has its tokens joined by spaces."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        to_text = decoder(path)
        for lists in batches:
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.append(0, np.cumsum([n or 0 for n in lists.value_lengths().to_pylist()])).astype(int).tolist()
            yield pa.array([to_text(values[a:b]) for a, b in zip(ends, ends[1:], strict=False)], pa.string())

    return decode(ids)


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id of each row, the `ids` of its text as `encode_text` gives them, and the `decoded` text of these ids
    as `decode_ids` does: both in one pass of one worker, a few texts at a time.

    A null text counts as empty and has no ids; rows that repeat have a row each, a null id stays null, an empty table gives
    an empty one. Other columns, whatever their names, are dropped. A text is taken whole, however long.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, to_text = load(path), decoder(path)
        for batch in batches:
            done = 0
            for portion in in_portions(text_bytes(batch.column(1))):
                ids, counts = bpe.encode(portion)
                ends = np.append(0, np.cumsum(counts)).tolist()
                texts = [to_text(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(done, len(portion)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(texts, pa.string()),
                ], [doc_id, "ids", "decoded"])
                done += len(portion)

    rows = pack(docs).select(field(doc_id).alias("_id"), field(text).alias("_text"))
    kind = dict(docs.dtypes)[doc_id]
    return rows.mapInArrow(coded, f"`{doc_id}` {kind}, ids array<int>, decoded string")


@functools.cache
def decoder(path: str) -> Callable[[np.ndarray], str]:
    """Ids to text, as the file's own decoder does it; one per worker process."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    listed = {**{i: t for t, i in spec["model"]["vocab"].items()}, **{i: t for t, i in special.items()}}
    known = max(listed) + 1
    has = np.zeros(known + 1, bool)
    has[list(listed)] = True
    names = np.full(known, "", object)
    names[list(listed)] = list(listed.values())
    kept = lambda ids: ids[has[np.where((ids < 0) | (ids > known), known, ids)]]
    if spec["decoder"] is None:
        return lambda ids: " ".join(names[kept(ids)])
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    raw = np.array([t.encode() if t in special else bytes(byte_of[c] for c in t) for t in names], object)
    return lambda ids: b"".join(raw[kept(ids)]).decode("utf-8", "replace")
