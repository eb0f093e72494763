"""Periodic runs against brute force."""

import hashlib
import random
import time
import zlib

import pytest

from tagshelf.llm import periodic
from tests.llm.conftest import words_of


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def brute(w):
    n, runs = len(w), []
    for q in range(1, n // 4 + 1):
        start = 0
        for i in range(n - q + 1):
            if i == n - q or w[i] != w[i + q]:
                length = i + q - start
                if length >= max(6, 4 * q) and i > start and smallest_period(w[start : start + length]) == q:
                    runs.append((start, length, q))
                start = i + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def some_texts():
    random.seed(11)
    texts = [" ".join(random.choices("ab", k=random.randint(0, 60))) for _ in range(150)]
    texts += [" ".join(random.choices("abc", k=random.randint(0, 40)) * random.randint(1, 6)) for _ in range(100)]
    for _ in range(150):
        parts = []
        for _ in range(random.randint(1, 5)):
            unit = random.choices("abcd", k=random.randint(1, 6))
            parts += unit * random.randint(1, 7) + unit[: random.randint(0, len(unit))] + random.choices("abcd", k=random.randint(0, 3))
        texts.append("\t".join(parts))
    return texts + ["", " \n", "a", "a a a a a", "a a a a a a", "a " * 300, "a b " * 100 + "a", "é 的 " * 4, "x\x1cy " * 6]


def test_runs_are_those_of_brute_force():
    texts = some_texts()
    for at in range(0, len(texts), 37):
        part = texts[at : at + 37]
        for text, got in zip(part, periodic._search([t.encode().split() for t in part]), strict=True):
            w = words_of(text)
            runs = brute(w)
            assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == runs, text
            assert got["n_words"] == len(w) and got["collapsed"] == brute_collapsed(w, runs)


def test_texts_are_sorted_apart_from_each_other():
    texts = [t.encode().split() for t in some_texts()]
    together = periodic._search(texts)
    assert together == [periodic._search([t])[0] for t in texts]


def test_on_tables(spark, documents, empty, monkeypatch):
    docs = documents.withColumnRenamed("key", "runs")
    monkeypatch.setattr(periodic, "AT_ONCE", 100)
    got = periodic.find_runs(docs)
    assert got.columns == [*[c for c in docs.columns if c != "runs"], "n_words", "runs", "collapsed"]
    found = got.collect()
    assert len(found) == docs.count()
    for r in found:
        w = words_of(r["text"])
        if len(w) < 2_000:
            runs = brute(w)
            assert [tuple(x) for x in r["runs"]] == runs and r["collapsed"] == brute_collapsed(w, runs) and r["n_words"] == len(w)
    assert periodic.find_runs(empty).count() == 0


@pytest.mark.parametrize("text", ["a " * 400_000, "a b c " * 150_000, " ".join(map(str, range(300_000))), "w " * 200_000 + "x " + "w " * 200_000])
def test_very_long_texts(text):
    began = time.time()
    got = periodic._search([text.encode().split()])[0]
    assert time.time() - began < 60
    for r in got["runs"]:
        w = text.split()[r["start"] : r["start"] + r["length"]]
        assert w[: -r["period"]] == w[r["period"] :]
    assert len(got["runs"]) == {"a": 1, "0": 0, "w": 2}[text[0]]


def test_ties_of_the_longest_run(spark):
    texts = ["a a a a a a z b b b b b b", "z", None, "a b a b a b a b " + "c c c c c c c c"]
    found = periodic.find_runs(spark.createDataFrame([(t,) for t in texts], "text string"))
    got = found.select("text", periodic.longest_run(found["runs"]).alias("r")).collect()
    assert [tuple(x["r"]) if x["r"] else None for x in got] == [(0, 6, 1), None, None, (0, 8, 2)]


def test_the_query_is_brute_force(spark):
    from tagshelf.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_periodic_runs"](spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert dict(got.dtypes)["exponent_milli"] == "bigint"
    edited = 0
    for r in got.collect():
        w = words_of(texts[r["doc_id"]])
        n, h = len(w), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            edited += 1
        if n > 3_000:
            continue
        runs = brute(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        listed = hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert tuple(r)[:2] == (r["doc_id"], len(runs))
        assert tuple(r)[2:6] == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert tuple(r)[6:] == (listed, hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest())
    assert edited > 5
