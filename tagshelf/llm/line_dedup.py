"""Drop lines that other documents hold as well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.rows import KEY, ROW, SPACES, field, hashes, lower_ascii, pack, unpack, with_key, write_step


def line_key(line: Column) -> Column:
    """The line without outer white space, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """The columns of `docs` with `text` reduced to the kept lines, and `n_lines`, `n_dropped`.

    Lines are split at \\n and compared by `line_key`. A key of at least `min_chars` code points found in at
    least `min_docs` documents loses all its lines except in the smallest `doc_id` holding it; there, each
    of its lines stays. The rest is joined in its order.

    A null text counts as empty, that is one empty line. Rows without an id are neither counted nor cut.
    Rows that share an id are one document when documents are counted; each keeps its own lines. An empty
    table gives an empty result. Longer texts only give more lines: a line is a row, no group of one line's
    documents ever meets in one task (counts combine before the shuffle, and the join of the lines with the
    repeated keys reads two written tables, so adaptive execution can split a hot key).
    """
    rows = with_key(pack(docs), doc_id, text)
    content = F.coalesce(field(text), F.lit(""))
    exploded = rows.filter(F.col("_id").isNotNull()).select(
        *KEY, F.posexplode(F.split(content, "\n")).alias("pos", "line")
    )
    keyed = exploded.select(*KEY, "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    k1, k2 = hashes(F.col("key"))
    lines = write_step(keyed.select(*KEY, "pos", k1.alias("k1"), k2.alias("k2")), "lines")
    repeated = write_step(
        lines.groupBy("k1", "k2").agg(F.count_distinct("_id").alias("n_docs"), F.min("_id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs).select("k1", "k2", "keeper"),
        "repeated-lines",
    )
    dropped = (
        lines.join(repeated, ["k1", "k2"]).filter(F.col("_id") != F.col("keeper"))
        .groupBy(*KEY).agg(F.collect_set("pos").alias("dropped"))
    )
    # The lines are split below the join: above it they are a column, which the lambda reads in place.
    marked = rows.withColumn("lines", F.split(content, "\n")).join(dropped, KEY, "left")
    n_lines = F.size("lines")
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), n_lines - 1), "dropped"), lambda i: F.get(F.col("lines"), i)
    )
    nothing = F.col("dropped").isNull()
    return unpack(
        marked.select(ROW, "lines", "dropped"), docs.columns, **{
            text: F.when(nothing, F.array_join("lines", "\n")).otherwise(F.array_join(kept, "\n")),
            "n_lines": n_lines.cast("long"),
            "n_dropped": F.when(nothing, 0).otherwise(F.size("dropped")).cast("long"),
        },
    )
