"""The registered corpus queries, run as they are registered over a folder of tables, against plain code over its texts."""

import hashlib
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest

from tagshelf.llm.queries import QUERIES
from tests.llm.conftest import lower
from tests.llm.test_operators import brute_components, plain_spans

GIVEN = "/root/testdata/sf0.001/documents.parquet"
ODD = [
    None, "", " \t\n ", "½ ² Ⅷ ①", "a" * 5000, "one\x0btwo\x0cthree\x1cfour\x85five six", "\n" * 50, "漢字 <|endoftext|> 😀\x00",
    "write to a.b@example.com or 10.0.0.1, +49 (170) 123-4567, card 4111 1111 1111 1111", "john at example dot com",
    "Released under the MIT License. GNU General\nPublic License, CC-BY", "word " * 300_000, "x y z", "X Y Z", "x y  z\n",
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The given documents, odd ones, and copies of some with a word more."""
    given = spark.read.parquet(GIVEN)
    odd = [(100_000 + i, t, None, None, 0) for i, t in enumerate(ODD)]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    near = [(200_000 + r[0], r[1] + " more", *r[2:]) for r in given.filter("doc_id < 40").select(columns).collect() if r[1]]
    docs = given.select(columns).unionByName(spark.createDataFrame(odd + near, given.select(columns).schema))
    path = f"{tmp_path_factory.mktemp('tables')}"
    docs.write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def texts(spark, folder):
    return dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())


def result(spark, folder, name, columns):
    """Rows by document; the first columns are those of the contract."""
    df = QUERIES[name](spark, folder)
    assert df.columns[: len(columns)] == columns
    found = df.collect()
    return found, {r["doc_id"]: r for r in found}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark, folder, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found, got = result(spark, folder, "op1_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    assert len(found) == len(texts)
    for i, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert tuple(got[i])[1:4] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_op2(spark, folder, texts):
    found, _ = result(spark, folder, "op2_jaccard_join", ["doc_id", "n_shingles", "component_id"])
    assert {(r[0], r[1]): r[2] for r in found} == brute_components(texts.items(), 4, Fraction(85, 100))
    assert len(found) == len(texts) and any(r[0] != r[2] for r in found)


def test_op3(spark, folder, texts):
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    found, got = result(spark, folder, "op3_fingerprints", columns)
    assert len(found) == len(texts)
    order, prints = sorted(texts, reverse=True), defaultdict(set)
    for i, after in zip(order, order[1:] + order[:1], strict=True):
        text, more = texts[i] or "", texts[after] or ""
        cut = len(text) // 3
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(text), sha(text[: len(text) - cut] + more[:cut]))
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
        prints[text].add(got[i]["fingerprint"])
        prints[text[: len(text) - cut] + more[:cut]].add(got[i]["edited_fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_op5(spark, folder, texts):
    counts = ["n_email", "n_ip", "n_card", "n_phone"]
    found, got = result(spark, folder, "op5_pii", ["doc_id", *counts, "base_sha256", "spans"])
    kinds = ["email", "ip", "card", "phone"]
    assert len(found) == len(texts)
    for i, text in texts.items():
        base = plain_spans(text or "")
        listed = [f"{kinds[k]}:{a}:{b}" for k, a, b in base]
        assert [got[i][c] for c in counts] == [sum(k == n for k, _, _ in base) for n in range(4)]
        assert got[i]["base_sha256"] == sha(",".join(listed))
        assert set(listed) <= set(filter(None, got[i]["spans"].split(",")))


def test_op7(spark, folder, texts):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    found, got = result(spark, folder, "op7_license_scan", columns)
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    assert len(found) == len(texts)
    for i, text in texts.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        places = [(at, label) for p, label in phrases.items() for at in range(len(words)) if words[at : at + len(p.split())] == p.split()]
        starts, labels = [at for at, _ in places], {label for _, label in places}
        assert tuple(got[i])[1:6] == (
            len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))
        )
        assert labels <= set(got[i]["labels"].split(",")) and 0 <= got[i]["score"] <= 1


def test_op8(spark, folder, texts):
    found, got = result(spark, folder, "op8_language_id", ["doc_id", "held_out", "lang_pred", "score"])
    assert len(found) == len(texts)
    for i, text in texts.items():
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert (got[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
    labels = {r["doc_id"]: r["lang"] for r in spark.read.parquet(GIVEN).select("doc_id", "lang").collect()}
    judged = [got[i]["lang_pred"] == lang for i, lang in labels.items() if got[i]["held_out"] and lang and got[i]["lang_pred"] != "und"]
    assert sum(judged) >= 0.95 * len(judged) > 0


def test_op9(spark, folder, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found, _ = result(
        spark, folder, "op9_packing", ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    )
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["length"] > 0
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
