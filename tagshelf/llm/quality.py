"""Quality rules: figures of a text on its own, and of its lines among the documents of its host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.line_dedup import line_key
from tagshelf.llm.rows import KEY, ROW, SPACE_CLASS, field, hashes, pack, unpack, with_key, write_step

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"


def _neighbours(values: Column, n: Column, apart: int, span: int) -> Column:
    """Hashes of each value with the one `apart` places on, of an array of which `n` - `span` + 1 remain."""
    left = F.greatest(n - (span - 1), F.lit(0))
    return F.zip_with(
        F.slice(values, F.lit(1), left), F.slice(values, F.lit(1 + apart), left), lambda x, y: F.xxhash64(x, y)
    )


def _covered(windows: Column) -> Column:
    """Words that lie in a window whose hash occurs twice or more.

    Sorted by hash, equal windows are neighbours. Of their places in order, each adds what the one before
    did not cover.
    """
    places = F.arrays_zip(windows.alias("h"), F.sequence(F.lit(0), F.size(windows) - 1).alias("p"))
    ordered = F.sort_array(places)
    last = F.size(ordered) - 1
    twins = F.zip_with(
        F.slice(ordered, F.lit(1), last), F.slice(ordered, F.lit(2), last),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["p"], y["p"])),
    )
    found = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda t: t.isNotNull()))))
    start = F.struct(F.lit(-WINDOW).alias("before"), F.lit(0).alias("total"))
    return F.aggregate(
        found, start,
        lambda a, p: F.struct(
            p.alias("before"), (a["total"] + F.least(F.lit(WINDOW), p - a["before"])).alias("total")
        ),
        lambda a: a["total"],
    )


def text_figures(rows: DataFrame, text: Column) -> DataFrame:
    """`rows` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of `text`; null counts as empty.

    A word is a run of other than white space. n_dup_lines counts lines with a word that equal an earlier
    line, n_repeat_words the words in windows of eight found twice or more, the first included.
    """
    content = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(content, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    n = F.size("words")
    kept = [F.col(c) for c in rows.columns]
    found = rows.select(
        *kept, F.regexp_extract_all(content, F.lit(f"[^{SPACE_CLASS}]+"), F.lit(0)).alias("words"),
        F.regexp_count(content, F.lit(SYMBOLS)).alias("n_symbols"), lines.alias("lines"),
    )
    figures = [
        n.alias("n_words"), F.char_length(F.array_join("words", "")).alias("word_chars"), F.col("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
    ]
    kept_figures = [F.col(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines")]
    one = found.select(*kept, *figures, F.transform("words", lambda w: F.xxhash64(w)).alias("h1"))
    total = F.col("n_words")
    two = one.select(*kept, *kept_figures, _neighbours(F.col("h1"), total, 1, 2).alias("h2"))
    four = two.select(*kept, *kept_figures, _neighbours(F.col("h2"), total, 2, 4).alias("h4"))
    eight = four.select(*kept, *kept_figures, _neighbours(F.col("h4"), total, 4, 8).alias("h8"))
    repeats = F.size(F.array_distinct("h8")) < F.size("h8")
    return eight.select(
        *kept, *[x.cast("long") for x in kept_figures],
        F.when(repeats, _covered(F.col("h8"))).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def removed_chars(
    rows: DataFrame, text: Column, host: Column, max_share: float
) -> DataFrame:
    """For each key of `rows` with lines above the limit: the characters of these lines.

    A line's key counts the distinct documents of a host that hold it. It is above the limit in more than `max_share`
    of the host's documents, if these do not all have one and the same text.
    """
    content = F.coalesce(text, F.lit(""))
    exploded = rows.select(*KEY, host.alias("host"), F.posexplode(F.split(content, "\n")).alias("pos", "line"))
    keyed = exploded.select(*KEY, "host", "pos", line_key(F.col("line")).alias("key")).filter(F.col("key") != "")
    k1, k2 = hashes(F.col("key"))
    lines = write_step(
        keyed.select(*KEY, "host", "pos", F.char_length("key").alias("chars"), k1.alias("k1"), k2.alias("k2")),
        "host-lines",
    )
    of_host = lines.select("host", *KEY).distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    # A document's line counts once: equal rows are combined before the counts are, and copies before the texts are.
    in_docs = lines.select("host", "k1", "k2", *KEY).distinct()
    in_texts = in_docs.groupBy("host", "k1", "k2", "_h1", "_h2").agg(F.count("*").alias("n"))
    held = in_texts.groupBy("host", "k1", "k2").agg(F.sum("n").alias("n_docs"), F.count("*").alias("n_texts"))
    common = held.filter("n_texts > 1")
    above = write_step(
        common.join(of_host.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
        .filter(F.col("n_docs") > max_share * F.col("host_docs")).select("host", "k1", "k2"),
        "common-lines",
    )
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ("host", "k1", "k2")]
    removed = (
        lines.alias("l").join(above.alias("a"), same[0] & same[1] & same[2]).select("l.*")
        .groupBy(*KEY).agg(F.collect_set(F.struct("pos", "chars")).alias("gone"))
    )
    return removed.select(
        *KEY, F.aggregate("gone", F.lit(0).cast("long"), lambda a, x: a + x["chars"]).alias("gone_chars")
    )


def quality_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_words: int = 20,
    max_repeat_percent: int = 30,
    max_share: float = 0.02,
    max_removed: float = 0.5,
) -> DataFrame:
    """The columns of `docs` with the figures of `text_figures`, `base_failed`, `removed_chars` and `kept`.

    base_failed: fewer than `min_words` words, or over `max_repeat_percent` of the words repeat. kept: not
    base_failed, and not depleted: lines that more than `max_share` of the documents of its host hold (`removed_chars`)
    make up at most `max_removed` of its characters. A line that copies of a single text hold is no boilerplate, however
    many they are. So the limit is a share at any size: a table and any number of copies of it get the same verdicts.

    A document is a row's id and text: rows that repeat count once. A null text counts as empty and fails. A null host is a host of its own. Rows that repeat get the same
    figures. An empty table gives an empty result. A line that most documents hold is counted with combining
    before the shuffle and joined between two written tables, which adaptive execution can split.
    """
    rows = with_key(pack(docs), doc_id, text)
    content = F.coalesce(field(text), F.lit(""))
    figures = text_figures(
        rows.select(ROW, *KEY, F.char_length(content).alias("n_text")), field(text)
    )
    gone = removed_chars(rows, field(text), field(host), max_share)
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"g.{k}")) for k in KEY]
    joined = figures.alias("f").join(gone.alias("g"), same[0] & same[1] & same[2], "left").select(
        "f.*", F.coalesce("g.gone_chars", F.lit(0)).alias("gone_chars")
    )
    n = F.col("n_words")
    failed = (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * n)
    depleted = F.col("gone_chars") > max_removed * F.col("n_text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return unpack(
        joined, docs.columns, **{c: F.col(c) for c in names}, base_failed=failed,
        removed_chars=F.col("gone_chars"), kept=~(failed | depleted),
    )
