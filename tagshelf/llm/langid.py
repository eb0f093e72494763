"""Language identification: unigram pieces of a fixed vocabulary, summed over all segmentations.

A language is a probability for each piece of a public vocabulary. A word's probability is the sum over all
ways to cut it into pieces, which a forward pass over its characters gives; a text's is the product over its
words. The piece probabilities are fitted by expectation maximisation: a forward and a backward pass give how
often each piece is expected in each way of cutting the words of the training texts.
"""

from __future__ import annotations

import functools
import itertools
import re
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.bpe import in_portions, text_bytes
from tagshelf.llm.rows import field, hashes, pack, unpack, write_step

UNKNOWN = "und"
SCALED = 8  # characters after which probabilities are scaled again, so that long words do not run into zero
AT_ONCE = 400_000  # characters of words that are scored together; one word is never split
REMEMBERED, REMEMBERED_LETTERS = 400_000, 8_000_000  # words
DOUBT = 5  # standard deviations that a text's words may be less probable together before it counts as strange
START = "▁"  # what the vocabulary marks a word's start with
# Words are runs of letters, Unicode's category L, in training and scoring: what is alphanumeric here, but no numeral.
NUMERALS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
WORD = re.compile(r"[^\W\d_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """The words of a lower-cased text."""
    found = () if text.isascii() else NUMERALS.intersection(text)
    return WORD.findall(text.translate(dict.fromkeys(map(ord, found), " ")) if found else text)


class Vocabulary:
    """The pieces of letters of a public vocabulary, found by hash for whole arrays of substrings."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        listed = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not model.is_control(i)}
        self.pieces = sorted(p for p in listed if p == START or p.removeprefix(START).isalpha())
        self.longest = max(map(len, self.pieces))
        self.size = len(self.pieces)  # an unknown character is the piece after the last, a substring that is none the next
        self.bits = (8 * self.size).bit_length()
        self.key = np.zeros(1 << self.bits, np.uint64)
        self.value = np.full(1 << self.bits, self.size + 1, np.int64)
        self.probes = 1
        for i, piece in enumerate(self.pieces):
            h = np.zeros(1, np.uint64)
            for c in piece:
                h = self.extend(h, np.array([ord(c)], np.uint64))
            at, probe = int(self._at(h)[0]), 1
            while self.key[at]:
                at, probe = (at + 1) % len(self.key), probe + 1
            self.key[at], self.value[at] = h[0], i
            self.probes = max(self.probes, probe)

    @staticmethod
    def extend(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        mixed = (h + c + np.uint64(1)) * BASE
        return mixed ^ (mixed >> np.uint64(29))

    def _at(self, h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        at = self._at(h)
        there = self.key[at]
        out = np.where(there == h, self.value[at], self.size + 1)
        open_ = np.flatnonzero((there != h) & (there != 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) % len(self.key)
            there = self.key[at[open_]]
            hit = open_[there == h[open_]]
            out[hit] = self.value[at[hit]]
            open_ = open_[(there != h[open_]) & (there != 0)]
        return out

    def lattice(self, words: np.ndarray) -> list[np.ndarray]:
        """For words of one length (code points, a row each): at k - 1, the piece of each span of k characters."""
        n, h, out = words.shape[1], np.zeros(words.shape, np.uint64), []
        for k in range(1, min(self.longest, n) + 1):
            h = self.extend(h[:, : n - k + 1], words[:, k - 1 :])
            found = self.find(h.ravel()).astype(np.int32).reshape(h.shape)
            if k == 1:
                found = np.where(found > self.size, self.size, found)
            out.append(found)
        return out

    def spans(self, lattice: list[np.ndarray]) -> list[list[int]]:
        """For each place, the lengths of the spans from it on that are a piece in any of the words."""
        out: list[list[int]] = [[] for _ in range(lattice[0].shape[1])]
        for k, found in enumerate(lattice, 1):
            for i in np.flatnonzero((found <= self.size).any(0)).tolist():
                out[i].append(k)
        return out


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(path)


class Model(NamedTuple):
    languages: list[str]
    probability: np.ndarray  # piece, unknown character, no piece (0) by language
    reached: np.ndarray | None = None  # by language, of its training words: log probability a character, spread of a word's about it


def _prefixes(
    lattice: list[np.ndarray], into: list[list[tuple[int, int]]], probability: np.ndarray, keep: int | None = None
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Probability of the first i characters, by word and language, over all ways to cut them, and the logarithm of
    what it is to be multiplied with. `into` has for each i the spans that end there: length and column of the lattice.
    Only the last `keep` are held, if that is given."""
    rows = lattice[0].shape[0]
    alpha, scale = [np.ones((rows, probability.shape[1]))], [np.zeros((rows, probability.shape[1]))]
    reach = len(lattice)
    for i, spans in enumerate(into[1:], 1):
        total = 0
        for k, column in spans:
            total = total + alpha[i - k] * probability[lattice[k - 1][:, column]]
        alpha.append(total)
        scale.append(scale[i - 1])
        if i % SCALED == 0:
            by, more = total, np.log(total)
            for j in range(max(0, i - reach), i + 1):
                alpha[j], scale[j] = alpha[j] / by, scale[j] + more
        if keep is not None and i > keep:
            alpha[i - keep - 1] = scale[i - keep - 1] = None
    return alpha, scale


def _ending(spans: list[list[int]]) -> list[list[tuple[int, int]]]:
    """For each number of characters, the spans that end there: their lengths and places."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(spans) + 1)]
    for at, lengths in enumerate(spans):
        for k in lengths:
            out[at + k].append((k, at))
    return out


def _log_probability(pieces: Vocabulary, points: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """Of words of one length, by language: the forward pass over all ways to cut them."""
    lattice = pieces.lattice(points)
    alpha, scale = _prefixes(lattice, _ending(pieces.spans(lattice)), probability, pieces.longest)
    return np.log(alpha[-1]) + scale[-1]


def _expected(pieces: Vocabulary, points: np.ndarray, probability: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected count of each piece by language, of words of one length with a weight by language."""
    lattice = pieces.lattice(points)
    spans, n = pieces.spans(lattice), points.shape[1]
    alpha, before = _prefixes(lattice, _ending(spans), probability)
    # From the end, the same the other way round: a span from its place on ends where those behind it begin.
    backward = [[]] + [[(k, n - i) for k in spans[n - i]] for i in range(1, n + 1)]
    beta, behind = _prefixes(lattice, backward, probability)
    share = weight / alpha[n]
    out = np.zeros(probability.shape)
    for i, lengths in enumerate(spans):
        for k in lengths:
            used, j = lattice[k - 1][:, i], n - i - k
            part = alpha[i] * probability[used] * beta[j] * share
            if n >= SCALED:
                part = part * np.exp(before[i] + behind[j] - before[n])
            for language in range(part.shape[1]):
                out[:, language] += np.bincount(used, part[:, language], len(out))
    return out


def _chars(words: list[str]) -> np.ndarray:
    """Characters that are scored: those of a word and its mark."""
    return np.fromiter(map(len, words), float, len(words)) + 1


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length as code points, so many at once, and their places; a word starts with a mark."""
    length = np.array([len(w) + 1 for w in words], np.int64)
    for n in np.unique(length).tolist():
        every = np.flatnonzero(length == n)
        for at in np.split(every, range(max(1, AT_ONCE // n), len(every), max(1, AT_ONCE // n))):
            text = "".join([START + words[i] for i in at])
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(at), n)
            yield points.astype(np.uint64), at


# --- fitting --------------------------------------------------------------------------------------


def _step(batches: Iterator[pa.RecordBatch], path: str, model: Model) -> Iterator[pa.RecordBatch]:
    """Expected counts of a partition's words: rows of word, language, n."""
    pieces, n_languages = vocabulary(path), len(model.languages)
    place = {name: j for j, name in enumerate(model.languages)}
    total = np.zeros(model.probability.shape)
    for batch in batches:
        words = batch.column(0).to_pylist()
        weight = np.zeros((len(words), n_languages))
        weight[np.arange(len(words)), [place[x] for x in batch.column(1).to_pylist()]] = batch.column(2).to_numpy()
        for points, at in _by_length(words):
            total += _expected(pieces, points, model.probability, weight[at])
    piece, language = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(piece), pa.array(language), pa.array(total[piece, language])], ["piece", "language", "n"]
    )


def _probabilities(counts: np.ndarray, smoothing: float) -> np.ndarray:
    """Smoothed shares by language; a substring that is no piece has none."""
    out = counts + smoothing
    out[-1] = 0
    return out / out.sum(0)


def _sums(batches: Iterator[pa.RecordBatch], path: str, model: Model) -> Iterator[pa.RecordBatch]:
    """Sums over a partition's words, by language, of what `_reached` needs."""
    scorer = Scorer(path, model)
    place = {name: j for j, name in enumerate(model.languages)}
    total = np.zeros((len(model.languages), 6))
    for batch in batches:
        words = batch.column(0).to_pylist()
        of = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
        logs, chars, n = scorer._score(words)[np.arange(len(words)), of], _chars(words), batch.column(2).to_numpy()
        for j, x in enumerate((np.ones(len(words)), chars, logs, logs * logs, logs * chars, chars * chars)):
            total[:, j] += np.bincount(of, x * n, len(total))
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(total))), *[pa.array(total[:, j]) for j in range(6)]], ["language", *"abcdef"]
    )


def _reached(words: DataFrame, path: str, model: Model) -> np.ndarray:
    """For each language the mean log probability of a character of its training words, and the standard deviation
    of a word's log probability from what this gives for its length."""
    summed = words.mapInArrow(
        functools.partial(_sums, path=path, model=model), "language bigint, " + ", ".join(f"{x} double" for x in "abcdef")
    ).groupBy("language").agg(*[F.sum(x).alias(x) for x in "abcdef"])
    out = np.zeros((len(model.languages), 2))
    for r in summed.collect():
        n, chars, logs, logs2, both, chars2 = [r[x] for x in "abcdef"]
        if n:
            mean = logs / chars
            out[r["language"]] = mean, np.sqrt(max((logs2 - 2 * mean * both + mean * mean * chars2) / n, 0.0))
    return out


def fit(
    labelled: DataFrame, path: str, text: str = "text", lang: str = "lang", max_documents: int = 2_000, rounds: int = 2,
    smoothing: float = 0.01,
) -> Model:
    """Piece probabilities of each language in `lang`, from rows whose `text` and `lang` are not null.

    Copies of a text teach as one. Of a language with more than `max_documents` distinct texts, a share is used
    that leaves about so many, drawn by the hash of the text: the bound of the sample that the classifier is
    fitted on. The counts of its words stay distributed; the driver sees a figure for each piece and language.
    Without rows there is no language.
    """
    rows = pack(labelled).select(field(lang).alias("language"), field(text).alias("text")).dropna()
    h1, h2 = hashes(F.col("text"))
    # Only hashes are shuffled to count the distinct texts, with equal ones combined before.
    distinct = rows.select("language", h1.alias("h1"), h2.alias("h2")).distinct()
    counts = {r["language"]: r["n"] for r in distinct.groupBy("language").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    size = vocabulary(path).size + 2
    if not languages:
        return Model([], np.zeros((size, 0)))
    share = F.create_map(*[x for n in languages for x in (F.lit(n), F.lit(min(1.0, max_documents / counts[n])))])
    drawn = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.element_at(share, F.col("language")) * (1 << 20))
    drawn = drawn.groupBy("language", h1.alias("h1"), h2.alias("h2")).agg(F.first("text").alias("text"))
    words = write_step(
        drawn.select("language", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
        .groupBy("word", "language").agg(F.count("*").alias("n")),
        "language-words",
    )
    lengths = np.array([len(p) for p in vocabulary(path).pieces] + [1, 1], float)
    model = Model(languages, _probabilities(np.repeat((0.1**lengths)[:, None], len(languages), 1), 0))
    for _ in range(rounds):
        summed = words.mapInArrow(
            functools.partial(_step, path=path, model=model), "piece bigint, language bigint, n double"
        ).groupBy("piece", "language").agg(F.sum("n").alias("n"))
        expected = np.zeros((size, len(languages)))
        for r in summed.collect():
            expected[r["piece"], r["language"]] = r["n"]
        model = Model(languages, _probabilities(expected, smoothing))
    return model._replace(reached=_reached(words, path, model))


# --- scoring --------------------------------------------------------------------------------------


class Scorer:
    """Log probabilities of words by language, remembered for the words seen lately."""

    def __init__(self, path: str, model: Model):
        self.pieces, self.model = vocabulary(path), model
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.letters = 0
        self.known = np.empty((0, len(self.model.languages)))

    def _score(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.model.languages)))
        for points, at in _by_length(words):
            out[at] = _log_probability(self.pieces, points, self.model.probability)
        return out

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log probability of each text by language, NaN for a text without a letter; its words and their characters."""
        listed = [words_of(t.lower()) for t in texts]
        new = set().union(*listed)
        new.difference_update(self.slots.keys() & new)
        if len(self.slots) + len(new) > REMEMBERED or self.letters > REMEMBERED_LETTERS:
            self._forget()
            new = set().union(*listed)
        words = list(new)
        self.letters += sum(map(len, words))
        self.slots.update(zip(words, range(len(self.slots), len(self.slots) + len(words)), strict=True))
        self.known = np.concatenate([self.known, self._score(words)])
        counts = np.fromiter(map(len, listed), np.int64, len(listed))
        slots = np.fromiter(map(self.slots.__getitem__, itertools.chain.from_iterable(listed)), np.int64, int(counts.sum()))
        out = np.full((len(texts), self.known.shape[1]), np.nan)
        full = np.flatnonzero(counts)
        if len(full):
            starts = np.append(0, np.cumsum(counts))[full]
            out[full] = np.add.reduceat(self.known[slots], starts, axis=0)
        return out, counts, np.array([sum(map(len, x)) for x in listed], float) + counts


def predict(text: Column, path: str, model: Model) -> Column:
    """struct<lang_pred, score>: the language under which a whole text is most probable, and its share of the
    probability over all languages. `und` and 0 for a null text, one without a letter, or a model of no language.
    Of equally probable languages the first by name. The struct also has `strangeness`: the negative log probability a
    character under that language, by what its training words have; of short texts less, by `DOUBT` standard
    deviations of so many words. Null where there is no language."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("strangeness", pa.float64())])

    @F.arrow_udf("struct<lang_pred: string, score: double, strangeness: double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(path, model)
        for texts in batches:
            out = []
            for portion in in_portions(text_bytes(texts)):
                if not model.languages:
                    out += [{"lang_pred": UNKNOWN, "score": 0.0, "strangeness": None}] * len(portion)
                    continue
                for logs, n, chars in zip(*scorer.score([t.decode() for t in portion]), strict=True):
                    if np.isnan(logs[0]):
                        out.append({"lang_pred": UNKNOWN, "score": 0.0, "strangeness": None})
                    else:
                        share = np.exp(logs - logs.max())
                        best = int(logs.argmax())
                        mean, spread = model.reached[best]
                        strange = (-logs[best] - DOUBT * spread * np.sqrt(n)) / (chars * -mean) if mean < 0 else None
                        out.append({
                            "lang_pred": model.languages[best], "score": float(share[best] / share.sum()),
                            "strangeness": strange if strange is None else float(strange),
                        })
            yield pa.array(out, kind)

    return predicted(text)


def held_out(doc_id: Column) -> Column:
    """A third of the documents, which no model learns from: the checksum of the id as text leaves 1. Rows
    without an id count as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def identify(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_documents: int = 2_000
) -> DataFrame:
    """The columns of `docs` with held_out, lang_pred, score and strangeness; fitted on the rows that are not held out.

    Null texts are `und`, null languages teach nothing, rows that repeat get equal results, an empty table
    gives an empty one. Texts are scored whole, one portion of a batch at a time.
    """
    learn = pack(docs).filter(~held_out(field(doc_id))).select(field(text).alias("text"), field(lang).alias("lang"))
    model = fit(learn, path, max_documents=max_documents)
    rows = pack(docs).withColumn("_found", predict(field(text), path, model))
    return unpack(
        rows, docs.columns, held_out=held_out(field(doc_id)), lang_pred=F.col("_found.lang_pred"), score=F.col("_found.score"),
        strangeness=F.col("_found.strangeness"),
    )
