"""Decontamination against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tagshelf.llm import decontaminate
from tests.llm.conftest import lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(lower(text or ""))


def brute(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        other = words(other)
        size = min(window, len(other))
        there = {tuple(other[i : i + size]) for i in range(len(other) - size + 1)} if size else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in there:
                hit.update(range(i, i + size))
                found.update([item] if item is not None else [])
    return len(own), len(hit), sorted(found), sorted(hit)


def longest_shared(text, items):
    own, best = words(text), 0
    for _, other in items:
        other = words(other)
        lengths = [0] * (len(other) + 1)
        for w in own:
            lengths = [0] + [lengths[j] + 1 if w == v else 0 for j, v in enumerate(other)]
            best = max(best, *lengths)
    return best


@pytest.fixture(scope="module")
def items():
    random.seed(3)
    few = ["a", "B", "c", "dé", "x1", "的"]
    made = [(str(i), " ".join(random.choices(few, k=random.choice([1, 2, 3, 5, 9, 10, 11, 14, 40])))) for i in range(25)]
    return made + [("7", "another text, of the SAME id; with eleven words in it now"), (None, "an item without an id " * 3), ("90", None), ("91", " .,; "), ("92", "")]


@pytest.fixture(scope="module")
def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "k") for i, t in items + items[:3]], "item_id string, text string, n_hit string")


def test_hits_are_those_of_brute_force(spark, documents, benchmark, items):
    random.seed(4)
    few = ["a", "b", "C", "dé", "x1", "的", "zz"]
    own = [(1000 + i, random.choice(["", "... "]) + random.choice([" ", "-", "\n"]).join(random.choices(few, k=random.randint(0, 60)))) for i in range(60)]
    own += [(2000 + i, f"Zürich; {t or ''}! and {t or ''} 😀 end") for i, (_, t) in enumerate(items)]
    docs = documents.unionByName(spark.createDataFrame(own, "doc_id long, text string"), allowMissingColumns=True)
    got = decontaminate.find_items(docs, benchmark, window=10)
    assert got.columns == [*docs.columns, "n_words", "n_hit", "longest", "items", "spans"]
    n = 0
    for r in got.collect():
        n_words, n_hit, found, hit = brute(r["text"], items, 10)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n_words, n_hit, found), r["text"]
        assert [w for s in r["spans"] for w in range(s["start"], s["end"])] == hit
        for s in r["spans"]:
            assert words(r["text"][s["from_char"] : s["to_char"]]) == words(r["text"])[s["start"] : s["end"]]
        if len(r["text"] or "") < 500:
            assert r["longest"] == longest_shared(r["text"], items)
        n += 1
    assert n == docs.count()


def test_many_blocks_find_the_same(spark, documents, benchmark, items, monkeypatch):
    docs = documents.unionByName(
        spark.createDataFrame([(3000 + i, f"so {t} {t} it is") for i, (_, t) in enumerate(items)], "doc_id long, text string"),
        allowMissingColumns=True,
    ).withColumn("words", F.lit(1))
    key = lambda df: sorted(map(str, df.collect()))
    whole = key(decontaminate.find_items(docs, benchmark, window=4))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    monkeypatch.setattr(decontaminate, "CHUNK_WORDS", 7)
    split = key(decontaminate.find_items(docs, benchmark, window=4).drop("longest"))
    assert split == key(decontaminate.find_items(docs, benchmark, window=4).drop("longest"))
    assert len(split) == len(whole)
    monkeypatch.undo()
    assert split == key(decontaminate.find_items(docs, benchmark, window=4).drop("longest"))


def test_a_very_long_text_and_one_window_in_all_documents(spark, benchmark):
    line = "here is a passage of ten words that all have"
    long = ("word " * 300_000) + line + (" other" * 300_000)
    docs = spark.createDataFrame([(1, long), (2, line), (2, line), (3, line + " " + line), (4, "x" * 2_000_000)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"item {i}. {line}") for i in range(300)], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.find_items(docs, items).collect()}
    assert [got[i]["n_hit"] for i in (1, 2, 3, 4)] == [10, 10, 20, 0]
    assert got[1]["spans"][0]["start"] == 300_000 and len(got[1]["items"]) == 300
    assert got[4]["n_words"] == 1 and got[3]["longest"] == 10


def test_empty_tables(documents, benchmark, empty):
    assert decontaminate.find_items(empty, benchmark).count() == 0
    got = decontaminate.find_items(documents, benchmark.limit(0))
    assert got.filter("n_hit > 0 OR size(items) > 0 OR longest > 0").isEmpty() and got.count() == documents.count()


def test_removal(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    long = " ".join(f"v{i}" for i in range(60))
    items = spark.createDataFrame([(1, passage), (2, long)], "item_id long, text string")
    filler = " ".join(f"z{i}" for i in range(100))
    texts = {1: f"é {filler}, {passage.upper()}; end", 2: passage, 3: f"{filler} {long} {filler}", 4: None, 5: "clean", 6: ""}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, spans int")
    got = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: f"é {filler}, ; end", 4: None, 5: "clean", 6: ""}
    assert decontaminate.decontaminate(docs, items).columns == docs.columns


def test_the_query_is_brute_force(spark):
    from tagshelf.llm.queries import QUERIES
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = QUERIES["op13_decontamination"](spark, sf)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for r in got.collect():
        n_words, n_hit, found, _ = brute(texts[r["doc_id"]], items, 10)
        listed = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert tuple(r) == (r["doc_id"], n_words, n_hit, len(found), listed, n_hit > 0)
