"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagshelf.llm import spelling
from tests.llm.conftest import lower

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters if c != word[i])


def brute(counts, ratio=5):
    letters = sorted({c for w in counts for c in w})
    around = {w: {v for v in edits(w, letters) if v in counts} for w in counts}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(around[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def some_counts(n, letters, longest=9):
    random.seed(n)
    words = {"".join(random.choices(letters, k=random.randint(1, longest))) for _ in range(n)}
    words |= {v for w in sorted(words)[:20] for v in random.sample(list(edits(w, letters)), 5) if v}
    return {w: random.choice([1, 2, 5, 5, 10, 24, 25, 26, 125, 625, 10**12]) for w in sorted(words)}


def grouped(spark, counts, **options):
    df = spark.createDataFrame([*counts.items()], "word string, n long")
    got = [tuple(r) for r in spelling.group_variants(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("piece, slot, columns", [(2_048, 16_384, 4_096), (7, 11, 3), (1, 1, 1)])
def test_groups_are_those_of_brute_force(spark, monkeypatch, piece, slot, columns):
    for name, value in (("PIECE", piece), ("SLOT", slot), ("COLUMNS", columns)):
        monkeypatch.setattr(spelling, name, value)
    counts = some_counts(150 if piece == 1 else 500, "abcdefgé÷ÿ", 7)
    assert grouped(spark, counts) == brute(counts)


def test_one_block_holds_most_words(spark, monkeypatch):
    """All words are made of letters of one group: the sums tell nothing about them."""
    monkeypatch.setattr(spelling, "PIECE", 40)
    monkeypatch.setattr(spelling, "SLOT", 100)
    same = "".join(c for c in "abcdefghijklmnopqrstuvwxyz" if ord(c) % spelling.GROUPS == 1)
    counts = some_counts(700, same, 6)
    assert grouped(spark, counts, ratio=2) == brute(counts, 2)


def test_very_long_words_and_anagrams(spark):
    long = "ab" * 3_000
    counts = {long: 5, long + "c": 50, "c" + long[1:]: 500, long[:-1]: 7, "listen": 9, "silent": 90, "enlist": 900}
    got = {r[0]: r for r in grouped(spark, counts)}
    assert got[long][1:] == ("c" + long[1:], "c" + long[1:], 5, 3, 500)
    assert got["listen"][1:] == (None, "listen", 9, 0, None)


def test_long_chains_of_forms(spark):
    counts = {"a" * (i + 1): 5**i for i in range(20)}
    got = {r[0]: r[2] for r in grouped(spark, counts)}
    assert set(got.values()) == {"a" * 20}


def test_empty_and_null(spark):
    df = spark.createDataFrame([(None, 3, 1), ("b", None, 1)], "word string, n long, root int")
    got = spelling.group_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and got.count() == 0
    with pytest.raises(ValueError):
        spelling.group_variants(df, ratio=1)


def counted(rows, least, change=None):
    total = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = change(doc_id, lower(run)) if change else lower(run)
            if len(word) >= least:
                total[word] += 1
    return dict(total)


def slip(doc_id, run):
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    at = h % len(run)
    return run if h % 199 or doc_id is None else run[:at] + run[at + 1 :]


def test_words_are_counted(spark, documents, empty, monkeypatch):
    from tagshelf.llm.queries import slips

    monkeypatch.setattr(spelling, "HELD", 5)
    docs = documents.unionByName(
        spark.createDataFrame([(i, "Éclair ÀÉ×÷ naïveté Ωμεγα-beta Straße's 的kiloİx " * 3) for i in range(500)], "doc_id long, text string"),
        allowMissingColumns=True,
    )
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for least, change, plain in ((1, None, None), (4, slips, slip)):
        got = {r["word"]: r["n"] for r in spelling.count_words(docs, least, change).collect()}
        if change:  # slips look at runs that are long enough
            rows_of = [(i, t) for i, t in rows]
            assert got == counted(rows_of, least, plain)
        else:
            assert got == counted(rows, least)
    assert spelling.count_words(empty, 6).count() == 0


def test_the_query_is_brute_force(spark):
    from tagshelf.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text")).collect()]
    counts = {w: n for w, n in counted(rows, 6, slip).items() if n >= 5}
    got = QUERIES["op11_spelling_variants"](spark, sf)
    assert got.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    assert {tuple(r) for r in got.collect()} == brute(counts)
