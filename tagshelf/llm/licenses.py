"""Licence scan: an exact set-similarity join of text blocks with licence templates."""

from __future__ import annotations

import math
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.rows import KEY, ROW, field, lower_ascii, pack, unpack, with_key, write_step

# What words are made of, once A-Z are lower-cased: digits, letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before lower-casing, which is enough to count words.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Short grants, found where a run of words contains all their words, and their labels.
GRANTS = {
    "agpl-3.0": "licensed under the gnu affero general public license version 3",
    "agpl-3.0-or-later": "gnu affero general public license as published by the free software foundation either version 3"
    " of the license or at your option any later version",
    "apache-2.0": "licensed under the apache license version 2 0",
    "cc-by-4.0": "licensed under cc by 4 0",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-nd-4.0": "licensed under cc by nd 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-2.0": "licensed under the gnu general public license version 2",
    "gpl-2.0-or-later": "gnu general public license as published by the free software foundation either version 2 of the"
    " license or at your option any later version",
    "gpl-3.0": "licensed under the gnu general public license version 3",
    "gpl-3.0-or-later": "gnu general public license as published by the free software foundation either version 3 of the"
    " license or at your option any later version",
    "lgpl-2.0-or-later": "gnu library general public license as published by the free software foundation either version 2 of"
    " the license or at your option any later version",
    "lgpl-2.1": "licensed under the gnu lesser general public license version 2 1",
    "lgpl-2.1-or-later": "gnu lesser general public license as published by the free software foundation either version 2 1 of"
    " the license or at your option any later version",
    "lgpl-3.0": "licensed under the gnu lesser general public license version 3",
    "lgpl-3.0-or-later": "gnu lesser general public license as published by the free software foundation either version 3 of"
    " the license or at your option any later version",
    "mit": "released under the mit license",
    "mpl-2.0": "subject to the terms of the mozilla public license v 2 0",
}

# Longer notices, found where a run of words contains most of their words, and their labels.
NOTICES = {
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided"
    " that the following conditions are met",
    "bsl-1.0": "to use reproduce display distribute execute and transmit the software and to prepare derivative works of the"
    " software and to permit third parties to whom the software is furnished to do so",
    "cc0-1.0": "to the extent possible under law the author has waived all copyright and related rights",
    "epl": "this program and the accompanying materials are made available under the terms of the eclipse public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is"
    " hereby granted",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files to deal in the software without restriction",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib": "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
}


# A run of words in which a template is looked for has at most so many times the template's words.
SPREAD = 2


class Template(NamedTuple):
    label: str
    tokens: tuple[str, ...]
    needed: int  # tokens a block has to share
    words: tuple[str, ...] = ()  # in their order; none where the block is the whole text and no run of it
    wider: tuple[tuple[str, ...], ...] = ()  # tokens of the grants that say more than this one
    grant: bool = False


def templates(
    phrases: dict[str, str], grants: dict[str, str], notices: dict[str, str], threshold: Fraction
) -> list[Template]:
    """Phrases are contained in full by a text, grants in full by a run of words, notices to `threshold` by one."""
    words = lambda text: tuple(sorted(set(text.split())))
    made = [Template(p, words(p), len(words(p))) for p in phrases]
    for label, grant in grants.items():
        own = words(grant)
        wider = tuple(words(g) for g in grants.values() if set(own) < set(words(g)))
        made.append(Template(label, own, len(own), tuple(grant.split()), wider, True))
    for label, notice in notices.items():
        made.append(Template(label, words(notice), math.ceil(threshold * len(words(notice))), tuple(notice.split())))
    return made


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def token_order(texts: DataFrame, universe: list[str]) -> list[str]:
    """The tokens of the templates, the rarest in all documents first. Their number is that of the list."""
    hits = texts.select(F.explode("own").alias("token"))
    counts = {r["token"]: r["n"] for r in hits.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return sorted(universe, key=lambda t: (counts.get(t, 0), t))


def _candidates(blocks: DataFrame, chosen: list[Template], order: list[str]) -> DataFrame:
    """Blocks, rows with the array `own` of their distinct template tokens, with each template they share enough with.

    A template that shares `needed` tokens with a block shares one of its first size - needed + 1 in the
    global order (prefix filter). The block needs as many template tokens at all (length filter), and from
    the first shared token on, both must have enough left (positional filter). What passes is verified.
    """
    rank = {t: i for i, t in enumerate(order)}
    prefixes = []
    for t in chosen:
        ranked = sorted(t.tokens, key=rank.__getitem__)
        first = ranked[: len(ranked) - t.needed + 1]
        prefixes += [(token, place, first, t) for place, token in enumerate(first)]
    # The list of templates is small whatever the corpus is, so its index may go to every task.
    index = F.array(*[
        F.struct(
            F.lit(token).alias("token"), F.lit(place).alias("place"), F.lit(t.label).alias("label"),
            _strings(t.tokens).alias("tokens"), F.lit(len(t.tokens)).alias("size"), F.lit(t.needed).alias("needed"),
            _strings(first).alias("first"), _strings(t.words).alias("sequence"),
            F.lit(SPREAD * len(t.words)).alias("span"), F.lit(t.grant).alias("grant"),
            F.lit(max([len(w) - len(t.tokens) for w in t.wider], default=0)).alias("pad"),
            F.array(*[_strings(w) for w in t.wider]).cast("array<array<string>>").alias("wider"),
        )
        for token, place, first, t in prefixes
    ])
    listed = blocks.sparkSession.range(1).select(F.inline(index))
    first = sorted({token for token, *_ in prefixes})
    ordered = blocks.filter(F.arrays_overlap("own", _strings(first))).withColumn(
        "own", F.array_intersect(_strings(order), "own")
    )
    hits = ordered.select("*", F.posexplode("own").alias("at", "token")).join(F.broadcast(listed), "token")
    before = F.least("place", "at")
    after = F.least(F.col("size") - F.col("place"), F.size("own") - F.col("at"))
    able = hits.filter((F.size("own") >= F.col("needed")) & (before + after >= F.col("needed")))
    # Of the prefix tokens that a block and a template share, the first one stands for the pair.
    leader = F.get(F.array_intersect("own", "first"), F.lit(0)) == F.col("token")
    shared = F.size(F.array_intersect("own", "tokens"))
    return able.filter(leader & (shared >= F.col("needed")))


def _run_length(words: Column, start: Column, in_order: bool) -> Column:
    """Words of the shortest run from place `start` (from 1) that holds all words of a grant; 0 if none is short enough.

    In order, the grant's words follow each other, with others between them, and its first word is not repeated.
    """
    run = F.slice(words, start, F.col("span"))
    if not in_order:
        places = F.transform("tokens", lambda t: F.array_position(run, t))
        return F.when(F.array_min(places) > 0, F.array_max(places)).otherwise(F.lit(0)).cast("int")

    def step(done, token):
        found = F.array_position(F.slice(run, done + 1, F.col("span")), token).cast("int")
        return F.when((done < 0) | (found == 0), F.lit(-1)).otherwise(done + found)

    first = F.get("sequence", F.lit(0))
    end = F.aggregate("sequence", F.lit(0), step)
    once = F.array_position(F.slice(run, F.lit(2), F.greatest(end - 1, F.lit(0))), first) == 0
    return F.when((F.element_at(words, start) == first) & (end > 0) & once, end).otherwise(F.lit(0))


def _in_runs(blocks: DataFrame, chosen: list[Template], order: list[str], in_order: bool) -> DataFrame:
    """Template and largest containment for each block, a row with its `words` and `own`, over its runs of words.

    A run has up to `SPREAD` times the template's words, and every place of the block starts one; those that can
    match hold a prefix token, so only the surroundings of these are gone through. Where a run, with as many
    words more on both sides as a grant that says more has, contains that grant, the one that says less
    does not count.
    """
    pairs = _candidates(blocks, chosen, order)
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains("first", F.get("words", i)))
    reach = F.col("span") - 1 + F.col("pad")
    near = pairs.withColumn("place", F.explode(places)).withColumn("from", F.greatest(F.col("place") - reach, F.lit(0)))
    near = near.withColumn("near", F.slice("words", F.col("from") + 1, F.col("place") + reach - F.col("from") + 1))
    near = near.withColumn("anchor", F.col("place") - F.col("from") + 1).drop("words", "own")
    near = near.select(*KEY, "label", "tokens", "size", "needed", "sequence", "span", "grant", "wider", "near", "anchor")
    near = near.filter(F.size(F.array_intersect("near", "tokens")) >= F.col("needed"))
    words = F.col("near")

    def granted(start):
        length = _run_length(words, start, in_order)

        def says_more(w):
            more = F.size(w) - F.col("size")
            left = F.greatest(start - more, F.lit(1))
            wide = F.slice(words, left, start + length + more - left)
            return F.size(F.array_intersect(wide, w)) == F.size(w)

        return (length > 0) & (start + length > F.col("anchor")) & ~F.exists("wider", says_more)

    starts = F.sequence(F.greatest(F.col("anchor") - F.col("span") + 1, F.lit(1)), F.col("anchor"))
    shared = F.array_max(
        F.transform(starts, lambda s: F.size(F.array_intersect(F.slice(words, s, F.col("span")), F.col("tokens"))))
    )
    best = F.when(~F.col("grant"), shared).when(F.exists(starts, granted), F.col("size")).otherwise(F.lit(0))
    return (
        near.withColumn("shared", best).filter(F.col("shared") >= F.col("needed"))
        .groupBy(*KEY, "label").agg(F.max(F.col("shared") / F.col("size")).alias("containment"))
    )


def scan_licenses(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    grants: dict[str, str] = GRANTS,
    notices: dict[str, str] = NOTICES,
    threshold: Fraction = Fraction(8, 10),
) -> DataFrame:
    """The columns of `docs` with n_words, n_base, first_word, last_word, base_labels, labels and score.

    The join finds every text that contains all words of a phrase, every run of words that contains all words of
    a grant, and every run that contains at least `threshold` of the distinct words of a notice. Runs are of up to
    twice the template's words, start at every word and go on over the ends of lines; beyond the end of a line
    a grant's words count in their order only, so that pieces of two grants do not make a third. In the texts found for a phrase, the places where its words
    stand one after the other are counted: n_base over all phrases, first_word and last_word the smallest and
    largest start, counting words from 0 (null without any). base_labels are the labels of phrases with a
    place, labels also those of the grants and notices found; both distinct, sorted, joined by commas, empty without any.
    score is 1 with a place, else the largest containment, else 0.

    A null text counts as empty. Rows that repeat get the same result, an empty table an empty one. Nothing
    is cut from long texts; only texts and runs with a rare enough template word are taken further.
    """
    listed = templates(phrases, grants, notices, threshold)
    whole, by_run = [t for t in listed if not t.words], [t for t in listed if t.words]
    universe = sorted({token for t in listed for token in t.tokens})
    rows = with_key(pack(docs), doc_id, text)
    content = F.coalesce(field(text), F.lit(""))
    words_of = lambda value: F.regexp_extract_all(lower_ascii(value), F.lit(WORD), F.lit(0))

    words = rows.select(*KEY, content.alias("content")).select(
        *KEY, "content", words_of(F.col("content")).alias("words")
    )
    # One pass over all texts: their template words, and the text itself if it has enough for any template.
    own = F.array_intersect("words", _strings(universe))
    seen = words.select(*KEY, "content", own.alias("own"))
    relevant = write_step(
        seen.select(*KEY, "own", F.when(_may_match(F.col("own"), listed), F.col("content")).alias("content")),
        "licence-words",
    )
    order = token_order(relevant, universe)
    able = relevant.filter(F.col("content").isNotNull())

    texts = _candidates(able, whole, order)
    label_of = F.create_map(*[F.lit(x) for pair in phrases.items() for x in pair])
    # Each word between spaces of its own, so that a phrase is found as whole words.
    spaced = F.array_join(F.transform(words_of(F.col("content")), lambda w: F.concat(F.lit(" "), w, F.lit(" "))), "")
    phrase = F.concat(F.lit(" "), F.replace("label", F.lit(" "), F.lit("  ")), F.lit(" "))
    count = lambda s: F.regexp_count(s, F.lit("[^ ]+"))
    placed = texts.select(*KEY, F.col("label").alias("by"), phrase.alias("phrase"), spaced.alias("spaced")).select(
        *KEY, "by", F.element_at(label_of, F.col("by")).alias("label"),
        F.regexp_count("spaced", F.concat(F.lit("(?="), "phrase", F.lit(")"))).alias("n_base"),
        count(F.expr("substring_index(spaced, phrase, 1)")).alias("first_word"),
        (count(F.col("spaced")) - count(F.expr("substring_index(spaced, phrase, -1)"))
         - count(F.col("phrase"))).alias("last_word"),
    ).filter(F.col("n_base") > 0)

    blocks = lambda table, value: table.select(*KEY, words_of(F.col(value)).alias("words")).select(
        *KEY, "words", F.array_intersect("words", _strings(universe)).alias("own")
    )
    lines = able.select(*KEY, F.explode(F.split("content", "\n")).alias("line"))
    noticed = _in_runs(blocks(able, "content"), by_run, order, True).unionByName(
        _in_runs(blocks(lines, "line"), [t for t in by_run if t.grant], order, False)
    )

    found = placed.select(
        *KEY, "by", F.lit(True).alias("is_base"), "label", "n_base", "first_word", "last_word",
        F.lit(1.0).cast("double").alias("score"),
    ).unionByName(
        noticed.select(*KEY, F.lit(False).alias("is_base"), "label", F.col("containment").alias("score")),
        allowMissingColumns=True,
    )
    # Distinct first: rows that repeat would otherwise count their places twice.
    per_text = found.distinct().groupBy(*KEY).agg(
        F.sum("n_base").alias("n_base"), F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word"), F.max("score").alias("score"),
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.sort_array(F.collect_set(F.when(F.col("is_base"), F.col("label")))).alias("base_labels"),
    )
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"f.{k}")) for k in KEY]
    counted = rows.withColumn("n_words", F.regexp_count(content, F.lit(ANY_CASE_WORD)))
    joined = counted.alias("r").join(per_text.alias("f"), same[0] & same[1] & same[2], "left")
    results = ["n_base", "first_word", "last_word", "labels", "base_labels", "score"]
    return unpack(
        joined.select(f"r.{ROW}", "r.n_words", *[f"f.{c}" for c in results]),
        docs.columns,
        n_words=F.col("n_words").cast("long"),
        n_base=F.coalesce("n_base", F.lit(0)).cast("long"),
        first_word=F.col("first_word").cast("long"),
        last_word=F.col("last_word").cast("long"),
        base_labels=F.coalesce(F.array_join("base_labels", ","), F.lit("")),
        labels=F.coalesce(F.array_join("labels", ","), F.lit("")),
        score=F.coalesce("score", F.lit(0.0)),
    )


def _may_match(own: Column, listed: list[Template]) -> Column:
    """Whether the template words of a text are enough for any template, whatever the order of tokens."""
    able = [F.size(F.array_intersect(own, _strings(t.tokens))) >= t.needed for t in listed]
    result = able[0]
    for x in able[1:]:
        result = result | x
    return result
