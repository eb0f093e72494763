"""Personal data in texts, also where it is disguised, at its place in the source text.

Plain forms are found in the text as it is. For disguised ones, transducers rewrite the text while they keep
for every character of the result which characters of the source it stands for: look-alike letters become
plain ones, invisible ones go, spelled digits become digits, "at" and "dot" become signs. The same
detectors then run on the result, and what they find is mapped back.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.rows import field, pack, unpack

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"

# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip(
    "аеорсухіјѕԁһӏАВЕКМНОРСТХІЈЅοαυνικρΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijsdhlABEKMHOPCTXIJSoauvikpABEZHIKMNOPTYX", strict=True,
))
# Invisible characters that are put between others.
INVISIBLE = "­​‌‍⁠﻿"
# Spelled digits and signs.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
}

# --- detectors: spans of the plain forms, leftmost and not overlapping ----------------------------

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile("[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From an @, the run of local characters before it and the domain behind it: linear in the text, where a
    pattern that starts with the run would try each of its places."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 40:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= len(DIGITS.findall(m.group())) <= 15:
            yield m.span()


def detect(text: str) -> list[tuple[int, int, int]]:
    """(place of the kind, start, end), by kind and start."""
    found = [(0, *s) for s in emails(text)] if "@" in text else []
    if DIGITS.search(text):
        found += [(1, *s) for s in ips(text)] + [(2, *s) for s in cards(text)]
        if "+" in text:
            found += [(3, *s) for s in phones(text)]
    return found


# --- transducers ----------------------------------------------------------------------------------


class Mapped(NamedTuple):
    """A text, and for each of its characters the source characters it stands for."""

    text: str
    start: list[int]
    end: list[int]

    @classmethod
    def of(cls, text: str) -> Mapped:
        return cls(text, list(range(len(text))), list(range(1, len(text) + 1)))

    def rewrite(self, pattern: re.Pattern, replace: Callable[[re.Match], str]) -> Mapped:
        """Each match by its replacement, all of whose characters stand for all of the match."""
        parts, start, end, done = [], [], [], 0
        for m in pattern.finditer(self.text):
            a, b = m.span()
            new = replace(m)
            if new == m.group():
                continue
            parts += [self.text[done:a], new]
            start += self.start[done:a] + [self.start[a]] * len(new)
            end += self.end[done:a] + [self.end[b - 1]] * len(new)
            done = b
        if not parts:
            return self
        return Mapped("".join([*parts, self.text[done:]]), start + self.start[done:], end + self.end[done:])


ODD_LETTERS = re.compile("[" + "".join(LOOKALIKES) + INVISIBLE + "！-～" + "]")
DIGIT_WORD = "(?:" + "|".join(SPELLED) + ")"
DIGIT_RUN = re.compile(rf"\b{DIGIT_WORD}(?:[ -]+{DIGIT_WORD})+\b", re.IGNORECASE)
DIGIT_ONE = re.compile(rf"\b{DIGIT_WORD}\b", re.IGNORECASE)
PLUS_WORD = re.compile(r"\bplus\s+(?=[0-9])", re.IGNORECASE)
WRAPPED = re.compile(r"(?<![ \t])[ \t]*+[\[({<][ \t]*+(at|@|dot|\.)[ \t]*+[\])}>][ \t]*+", re.IGNORECASE)
SIGNS = {"at": "@", "@": "@", "dot": ".", ".": "."}
# Bare words count only as a whole address: someone at somewhere dot something. The part behind a run of parts is
# optional, so that a run without it is passed over as a whole and not gone through again from each of its parts.
ADDRESS = re.compile(
    r"(?<![A-Za-z0-9_%+.-])[A-Za-z0-9_%+-]++(?:(?: +dot +|\.)[A-Za-z0-9_%+-]++)*+(?:(?: ++at +|@)"
    r"(?P<domain>[A-Za-z0-9-]++(?:(?: +dot +|\.)[A-Za-z0-9-]++)++))?",
    re.IGNORECASE,
)
# What a text has at least where the rewrites change something in it: bare words of an address, and a spelled
# digit beside a figure, a plus or another one.
BARE = re.compile(r" at +[A-Za-z0-9-]++(?: +dot +|\.)[A-Za-z0-9-]| dot +[A-Za-z0-9_%+-]", re.IGNORECASE)
DIGIT_NEAR = re.compile(
    rf"[0-9+][ ().-]*+{DIGIT_WORD}\b|\b{DIGIT_WORD}[ ().-]++(?:[0-9]|{DIGIT_WORD}\b)", re.IGNORECASE
)
SOME_DIGITS = re.compile(rf"\b{DIGIT_WORD}(?:[ -]+{DIGIT_WORD})*\b", re.IGNORECASE)


def _plain_letter(m: re.Match) -> str:
    c = m.group()
    return "" if c in INVISIBLE else LOOKALIKES.get(c) or chr(ord(c) - 0xFEE0)


def _digits(m: re.Match) -> str:
    return "".join(SPELLED[w.lower()] for w in DIGIT_ONE.findall(m.group()))


def rewrites(text: str) -> list[Mapped]:
    """The rewritten texts with their maps; none where no rewrite changes anything.

    Where digits are spelled, all of them count at first, then those that stand together, then none: a word like
    "one" behind a number may or may not belong to it.
    """
    plain = Mapped.of(text) if not text.isascii() and ODD_LETTERS.search(text) else None
    if plain:
        plain = plain.rewrite(ODD_LETTERS, _plain_letter)
    now = plain.text if plain else text
    lower = now.lower()
    spelled = any(w in lower for w in SPELLED) and DIGIT_NEAR.search(now)
    plus = "plus" in lower and (spelled or PLUS_WORD.search(now))
    wrapped = any(x in now for x in "[({<") and WRAPPED.search(now)
    bare = BARE.search(now)
    if not (plain or spelled or plus or wrapped or bare):
        return []
    plain = plain or Mapped.of(text)
    found: list[Mapped] = []
    for digits in (SOME_DIGITS, DIGIT_RUN, None) if spelled else (None,):
        mapped = plain.rewrite(digits, _digits) if digits else plain
        if plus:
            mapped = mapped.rewrite(PLUS_WORD, lambda m: "+")
        if wrapped:
            mapped = mapped.rewrite(WRAPPED, lambda m: SIGNS[m.group(1).lower()])
        if BARE.search(mapped.text):
            mapped = mapped.rewrite(ADDRESS, _address)
        if all(mapped.text != other.text for other in found):
            found.append(mapped)
    return found


def _address(m: re.Match) -> str:
    """The signs for the words, if there is a domain: its last part starts with a letter, unlike that of a time of
    day or an amount, or it is four numbers."""
    if not m["domain"]:
        return m.group()
    domain = re.sub(" +dot +", ".", m["domain"], flags=re.IGNORECASE)
    if not (domain.rsplit(".", 1)[1][0].isalpha() or IP.fullmatch(domain)):
        return m.group()
    local = m.group()[: m.start("domain") - m.start()]
    return re.sub(" +at +$", "@", re.sub(" +dot +", ".", local, flags=re.IGNORECASE), flags=re.IGNORECASE) + domain


def find(text: str) -> list[tuple[int, int, int, bool]]:
    """(place of the kind, start, end, whether it stands there undisguised), by kind and start.

    What the undisguised text has stays; each rewritten text adds what overlaps none of the same kind so far.
    """
    base = detect(text)
    taken = list(base)
    for mapped in rewrites(text):
        added = []
        for kind, a, b in detect(mapped.text):
            start, end = mapped.start[a], mapped.end[b - 1]
            after = bisect.bisect_left(taken, (kind, start, end))
            near = [(x, y) for k, x, y in taken[max(after - 1, 0) : after + 1] if k == kind]
            if all(end <= x or y <= start for x, y in near):
                added.append((kind, start, end))
        taken = sorted([*taken, *dict.fromkeys(added)])
    there = set(base)
    return sorted((*s, s in there) for s in taken)


# --- columns --------------------------------------------------------------------------------------


def find_pii(text: Column) -> Column:
    """Spans of personal data in a whole text: kind, start and end (code points, end exclusive), base (undisguised).

    Ordered by kind (email, ip, card, phone) and start. A null or empty text has none.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    @F.arrow_udf(SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([
                [{"kind": KINDS[k], "start": a, "end": b, "base": x} for k, a, b, x in find(t)] if t else []
                for t in texts.to_pylist()
            ], kind)

    return spans(text)


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap are replaced together."""
    out, done = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b, _ in find(text)):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]]) if out else text


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of `docs` with the personal data in `text` replaced by its kind. Nulls stay null; rows that
    repeat get equal results; an empty table gives an empty one. Every document stays."""

    @F.arrow_udf("string")
    def replaced(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([t and redacted(t) for t in texts.to_pylist()], pa.string())

    return unpack(pack(docs), docs.columns, **{text: replaced(field(text))}).select(*docs.columns)
