"""The registered corpus queries, each the thin end of an operator, and their DuckDB SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagshelf.llm.bpe import encode_documents
from tagshelf.llm.decontaminate import find_items
from tagshelf.llm.fingerprints import fingerprint_edits
from tagshelf.llm.jaccard_join import link_documents
from tagshelf.llm.langid import identify
from tagshelf.llm.licenses import scan_licenses
from tagshelf.llm.line_dedup import dedup_lines
from tagshelf.llm.oracle import SQL
from tagshelf.llm.packing import pack_documents
from tagshelf.llm.periodic import find_runs, longest_run, repeat_words
from tagshelf.llm.pii import KINDS, find_pii
from tagshelf.llm.quality import quality_rules
from tagshelf.llm.rows import read
from tagshelf.llm.spelling import count_words, group_variants
from tagshelf.llm.warc import read_archives, write_archives
from tagshelf.sources.shared import new_folder


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read(spark, sf_dir, "documents"), WORD_BPE).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read(spark, sf_dir, "documents"), words=4, threshold=Fraction(85, 100))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "documents").select("doc_id", find_pii(F.col("text")).alias("spans"))
    base = F.filter("spans", lambda s: s["base"])
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(read(spark, sf_dir, "documents"), PIECES)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pack_documents(read(spark, sf_dir, "documents"), BYTE_BPE)
    return placed.select(
        "doc_id", "start", F.col("length").cast("long"), "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    write_archives(read(spark, sf_dir, "pages"), folder)
    # Payloads are read back where there are any, and are what their digests say; of revisits only the headers are.
    responses = read_archives(spark, folder, verify=True).filter("record_type = 'response'")
    responses = responses.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    revisits = read_archives(spark, folder, payload=False).filter("record_type = 'revisit'")
    return responses.unionByName(revisits).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def slips(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A document's words, with a letter lost from one in 199. Without an id a document has no slips."""
    if doc_id is None:
        return words
    start, out = zlib.crc32(b"%d:" % doc_id), []
    for word in words:
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        at = h % len(word)
        out.append(word if h % 199 else word[:at] + word[at + 1 :])
    return out


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_words(read(spark, sf_dir, "documents"), least_letters=6, change=slips)
    return group_variants(counted.filter("n >= 5"), ratio=5)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    repeated = repeat_words(F.col("text"), lambda n: g % n, lambda n: 1 + F.floor((n - g % n) / (3 + g % 8)))
    docs = read(spark, sf_dir, "documents").select("doc_id", F.when(h % 10 == 0, repeated).otherwise(F.col("text")).alias("text"))
    run = F.col("longest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return find_runs(docs).withColumn("longest", longest_run(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), run["start"].alias("start"), run["length"].alias("length"),
        run["period"].alias("period"), F.floor(1000 * run["length"] / run["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_fingerprints": op3_fingerprints,
    "op4_line_dedup": op4_line_dedup,
    "op5_pii": op5_pii,
    "op6_quality_rules": op6_quality_rules,
    "op7_license_scan": op7_license_scan,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_warc": op10_warc,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_decontamination": op13_decontamination,
}

ORACLE_SQL = SQL
