"""Documents that share most of their word n-grams: an exact Jaccard join by partitioning the universe.

The n-grams of a document are hashed to tokens. Two sets with a Jaccard similarity of at least t differ in at
most H tokens, which their sizes bound. Documents are put into bands of sizes, and in a band all tokens are
hashed into an even number of segments, more than H. Two neighbouring segments are a group; as there are more
than H / 2 groups, two linked sets differ in at most one token in one of them, and so have one of its two
segments in common. Each segment that has tokens is a signature. An empty segment would be one that countless
sets share, so that it is not indexed; there the other segment of the group is, together with all its one-deletion
neighbours: that is the cheaper allocation of the one difference that the group may have. There are some more groups
than needed, and the smaller sets of a band need fewer: each set leaves out groups in which it has next to nothing,
which cost the most, as far as two sets that both do so still have a group in common.

Documents that share a signature are a bucket. A bucket is not expanded into pairs: its member with the most
signatures in common with others is its hub, and a hub's members, over all its buckets, are a star. Two sets that
link are in one star. A star of bounded size is compared exactly in one task, which gives a tree of each linked
part. The members of a larger star are compared with the hub alone first: links between two that are linked to the
hub change no component. Where others are left, which is so if a page's frame is a good part of short texts, the star's
candidates are narrowed: of two linked sets, the few rarest tokens of each have one in common. Members that share such
a token are buckets again, with hubs and stars of their own; only what is large even then is compared in blocks of
bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagshelf.llm.components import components
from tagshelf.llm.rows import field, pack, write_step
from tagshelf.sources.shared import new_folder, temporary_steps

# Odd multipliers, made from a rule: the odd numbers next to 2^64 times the fractions of multiples of the golden ratio.
FACTORS = np.array([(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) | 1 for i in range(1, 9)], np.uint64)
BAND_GROWTH = 1.4
SPARE = 20  # for so many groups that a band needs it gets two more, of which each set may leave one out
AT_ONCE = 200_000  # rows that a task hands over together
MEMBERS, TOKENS = 1_000, 500_000  # of a star, or of one of the two blocks, that one task compares
COLUMNS = 4_096
SLOTS = 1 << 16  # counters that the tokens of large stars share


class Rule(NamedTuple):
    """Documents link when their n-grams' Jaccard similarity is at least up / down."""

    words: int
    up: int
    down: int

    def rarest(self, size: int) -> int:
        """Of so many of its rarest tokens, a set of this size has one in common with every set it links with."""
        return size - -(-size * self.up // self.down) + 1

    def differences(self, sizes: int) -> int:
        """The most tokens in which two linked sets differ whose sizes add up to `sizes`."""
        return (self.down - self.up) * sizes // (self.down + self.up)

    def bands(self, largest: int) -> np.ndarray:
        """First sizes of the bands, up to one that begins beyond `largest`."""
        first = [1]
        while first[-1] <= largest:
            first.append(max(first[-1] + 1, int(first[-1] * BAND_GROWTH)))
        return np.array(first)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit tokens of the `words`-grams, A-Z lower-cased; with fewer words one of them all."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(words, len(found))
    total = np.full(len(found) - size + 1, np.uint64(size))
    for i in range(size):
        total = _mix(total * FACTORS[0] + hashed[i : len(found) - size + 1 + i] * FACTORS[1])
    return np.unique(total)


def set_hash(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: two sums of mixed tokens."""
    return tuple(int(_mix(tokens + f).sum(dtype=np.uint64).astype(np.int64)) for f in FACTORS[2:4])


# --- signatures -----------------------------------------------------------------------------------


def signatures(tokens: np.ndarray, rule: Rule) -> np.ndarray:
    """The keys under which a set meets every set it links with."""
    size = len(tokens)
    bands = rule.bands(size * rule.down // rule.up)
    own = int(np.searchsorted(bands, size, "right")) - 1
    keys = []
    # A pair meets in the band of its larger set.
    for band in range(own, len(bands) - 1):
        if bands[band] * rule.up > size * rule.down:
            break
        most = int(bands[band + 1]) - 1
        groups = rule.differences(2 * most) // 2 + 1
        groups += 2 * (groups // SPARE)
        segments = 2 * groups if most > 1 and rule.differences(2 * most) else 1
        # Two linked sets of these sizes differ in at most one token in all groups but so many. What is beyond the one
        # group that is needed, each of the two may leave out half of.
        apart = rule.differences(size + min(most, size * rule.down // rule.up)) // 2
        with np.errstate(over="ignore"):
            keys.append(_band_keys(tokens, segments, band, max(0, groups - apart - 1) // 2))
    return np.concatenate(keys)


def _band_keys(tokens: np.ndarray, segments: int, band: int, spare: int) -> np.ndarray:
    """Keys in one band; the groups with at most one token are the ones to leave out, up to `spare`: countless
    sets have no token there, or one."""
    base = np.uint64(band + 1) * FACTORS[4]
    place = (tokens % np.uint64(segments)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    mixed, place = _mix(tokens + FACTORS[5])[order], place[order]
    start = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    used = place[start]
    sums = np.add.reduceat(mixed, start)
    keys = [_mix(base + used.astype(np.uint64) * FACTORS[6] + sums * FACTORS[7])]
    if len(used) < segments and segments > 1:
        in_group = np.bincount(place // 2, minlength=segments // 2)
        poor = np.flatnonzero(in_group <= 1)
        left_out = set(poor[np.argsort(in_group[poor], kind="stable")][:spare].tolist())
        if left_out:
            keys = [keys[0][~np.isin(used // 2, list(left_out))]]
        end = np.append(start[1:], len(mixed))
        by_segment = {int(s): i for i, s in enumerate(used)}
        for empty in np.setdiff1d(np.arange(segments), used):
            if int(empty) // 2 in left_out:
                continue
            i = by_segment.get(int(empty) ^ 1)
            whole = sums[i] if i is not None else np.uint64(0)
            less = whole - mixed[start[i] : end[i]] if i is not None else np.empty(0, np.uint64)
            sums_of = np.append(less, whole)
            keys.append(_mix(base + np.uint64(segments + int(empty)) * FACTORS[6] + sums_of * FACTORS[7]))
    return np.concatenate(keys)


# --- tasks ----------------------------------------------------------------------------------------


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
        yield doc_id, text.as_buffer().to_pybytes() if text.is_valid else b""


def _summaries(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(i, len(s), *set_hash(s)) for i, t in _texts(batch) for s in [shingles(t, words)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], ["id", "n", "c1", "c2"]
        )


def _entries(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    ids, keys, held = [], [], 0

    def handed() -> pa.RecordBatch:
        all_keys = np.concatenate(keys).astype(np.int64)
        all_ids = np.repeat(np.array(ids, np.int64), [len(k) for k in keys])
        return pa.RecordBatch.from_arrays([pa.array(all_keys), pa.array(all_ids)], ["key", "id"])

    for batch in batches:
        for doc_id, text in _texts(batch):
            tokens = shingles(text, rule.words)
            if len(tokens):
                ids.append(doc_id)
                keys.append(signatures(tokens, rule))
                held += len(keys[-1])
            if held >= AT_ONCE:
                yield handed()
                ids, keys, held = [], [], 0
    if ids:
        yield handed()


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The token sets of ids and texts, with the columns after these as they are."""
    for batch in batches:
        ids, sets = [], []
        for doc_id, text in _texts(batch):
            ids.append(doc_id)
            sets.append(shingles(text, words).view(np.int64))
        ends = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
        flat = np.concatenate([np.empty(0, np.int64), *sets])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array(np.diff(ends).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), *batch.columns[2:],
            ],
            ["id", "n", "tokens", *batch.schema.names[2:]],
        )


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two sets share: products of 0/1 matrices, some thousand tokens at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = count[token] > 1
    number = np.cumsum(count > 1) - 1
    owner, token = owner[several], number[token[several]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
        a, b = np.searchsorted(token, [first, first + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[a:b], token[a:b] - first] = 1
        out += held @ held.T
    return out.astype(np.int64)  # exact: sums of ones far below 2^24


def _trees(group: pa.Table, rule: Rule) -> pa.Table:
    """Links of a star or of two of its blocks: each linked part as a tree, its members to its smallest id."""
    ids = group.column("id").to_numpy()
    sets = [x.values.to_numpy() for x in group.column("tokens")]
    size, shared = np.array([len(s) for s in sets], np.int64), _shared(sets)
    linked = shared * (rule.down + rule.up) >= rule.up * (size[:, None] + size[None, :])
    label = ids.copy()
    while True:
        lowest = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(1))
        if (lowest == label).all():
            break
        label = lowest
    moved = label != ids
    return pa.table({"hub": pa.array(label[moved]), "id": pa.array(ids[moved])})


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the tokens of each slot occur: one table of bounded size a task."""
    counts = np.zeros(SLOTS, np.int64)
    for batch in batches:
        counts += np.bincount(batch.column(0).flatten().to_numpy() & (SLOTS - 1), minlength=SLOTS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "n"])


def _rarest(batches: Iterator[pa.RecordBatch], rule: Rule, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The tokens of which two linked sets share one. Any order of all tokens would do; by counts, few sets share them."""
    for batch in batches:
        kept = []
        for tokens in (x.values.to_numpy() for x in batch.column(1)):
            order = np.lexsort((tokens, counts[tokens & (SLOTS - 1)]))
            kept.append(tokens[order[: rule.rarest(len(tokens))]])
        ids = np.repeat(batch.column(0).to_numpy(), [len(k) for k in kept])
        flat = np.concatenate([np.empty(0, np.int64), *kept])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(flat)], ["id", "token"])


# --- buckets, hubs and what is left ---------------------------------------------------------------


def _stars(entries: DataFrame, met: Column) -> DataFrame:
    """Pairs of hub and member over all buckets that meet `met`, an aggregate of a bucket; each pair once.

    Keys are counted with combining, and entries are joined back to the keys that are left, so that a key that many
    share is a row for each task in the count, and may be split in the joins.
    """
    spark = entries.sparkSession
    folder = new_folder(spark, "stars")
    with temporary_steps(spark, "buckets"):
        entries = write_step(entries, "entries")
        # Written, so that the files of the count's shuffle are gone when entries are moved.
        keys = write_step(entries.groupBy("key").agg(met.alias("met")).filter("met").select("key"), "keys")
        entries = write_step(entries.select("key", "id").join(keys.hint("merge"), "key", "left_semi"), "shared")
        company = entries.groupBy("id").agg(F.count("*").alias("company"))
        # As many rows as entries may be: moved at any size, so that the work grows as the input does.
        ranked = entries.join(company.hint("merge"), "id")
        best = F.max(F.struct("company", (-F.col("id")).alias("minus"))).alias("best")
        hubs = write_step(
            ranked.groupBy("key").agg(best, F.count("*").alias("members")).select("key", (-F.col("best.minus")).alias("hub"), "members"),
            "hubs",
        )
        # Entries of a hot key are not moved to one task: their hubs, fewer than a thousandth of the entries, are broadcast.
        hot = F.col("members") >= MEMBERS
        met_hot = entries.join(F.broadcast(hubs.filter(hot).drop("members")), "key", "left")
        met_others = met_hot.filter("hub IS NULL").drop("hub").join(hubs.filter(~hot).drop("members").hint("merge"), "key")
        found = met_hot.filter("hub IS NOT NULL").unionByName(met_others)
        return write_step(found.filter("id <> hub").select("hub", "id").distinct(), "stars", folder)


def _linked_to_hub(stars: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Each hub and member of large stars with whether they link; in built-in functions."""
    # One hub for MEMBERS pairs or TOKENS tokens: their ids are broadcast, so that no other set is moved as a hub's.
    hubs = F.broadcast(stars.select(F.col("hub").alias("id")).distinct())
    member = sets.select("id", F.col("tokens").alias("own"))
    of_hub = sets.join(hubs, "id", "left_semi").select(F.col("id").alias("hub"), F.col("tokens").alias("theirs"))
    shared = F.size(F.array_intersect("own", "theirs"))
    linked = shared * F.lit(rule.down + rule.up) >= (F.size("own") + F.size("theirs")).cast("long") * rule.up
    return stars.join(member.hint("merge"), "id").join(of_hub, "hub").groupBy("hub", "id").agg(F.max(linked).alias("linked"))


def _blocks(compared: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members of large stars, dealt into blocks by hash, once for each two blocks they are in: hub, a, b, id.

    Blocks of members that do not link to the hub meet each other and those that do; the latter do not meet.
    """
    with_size = compared.join(sizes, "id")
    many = with_size.groupBy("hub", "linked").agg(F.count("*").alias("members"), F.sum("n").alias("tokens")).select(
        "hub", "linked",
        F.greatest(F.ceil(F.col("members") / MEMBERS), F.ceil(F.col("tokens") / TOKENS)).cast("int").alias("blocks"),
    )
    by_hub = many.groupBy("hub").agg(
        F.coalesce(F.max(F.when(~F.col("linked"), F.col("blocks"))), F.lit(0)).alias("apart"),
        F.coalesce(F.max(F.when(F.col("linked"), F.col("blocks"))), F.lit(0)).alias("near"),
    ).filter("apart > 0")
    dealt = compared.join(by_hub, "hub").withColumn(
        "block", F.when(F.col("linked"), F.col("apart") + F.pmod(F.xxhash64("id"), F.col("near")))
        .otherwise(F.pmod(F.xxhash64("id"), F.col("apart"))).cast("int"),
    )
    others = F.when(F.col("linked"), F.sequence(F.lit(0), F.col("apart") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("apart") + F.col("near") - 1)
    )
    met = dealt.select("hub", "id", "block", F.explode(others).alias("other"))
    return met.select("hub", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "id")


def _open(compared: DataFrame) -> DataFrame:
    """Members of stars where some do not link to the hub."""
    return compared.join(compared.filter("NOT linked").select("hub").distinct(), "hub", "left_semi")


def _narrowed(compared: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Entries key, id and apart: members of stars, of which `sets` are, each under its rarest tokens."""
    counts = np.zeros(SLOTS, np.int64)
    summed = sets.select("tokens").mapInArrow(_slot_counts, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    for row in summed.collect():  # as many rows as slots, whatever the input is
        counts[row["slot"]] = row["n"]
    rare = sets.select("id", "tokens").mapInArrow(lambda b: _rarest(b, rule, counts), "id bigint, token bigint")
    return compared.join(rare.hint("merge"), "id").select(
        F.xxhash64("hub", "token").alias("key"), "id", (~F.col("linked")).alias("apart")
    )


def _weighed(stars: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs of hub and member with whether their star is too large for one task."""
    weights = stars.join(sizes, "id").groupBy("hub").agg(F.count("*").alias("members"), F.sum("n").alias("tokens"))
    large = (F.col("members") >= MEMBERS) | (F.col("tokens") >= TOKENS)
    return write_step(stars.join(weights.select("hub", large.alias("large")), "hub"), "stars-sizes")


def _compared(weighed: DataFrame, sets: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Small stars as groups to compare at once, and the members of large ones with whether they link to the hub."""
    whole = weighed.filter("NOT large").select("hub", "id")
    hubs = whole.select("hub", F.col("hub").alias("id")).distinct()
    groups = whole.unionByName(hubs).select("hub", F.lit(0).alias("a"), F.lit(0).alias("b"), "id")
    large = weighed.filter("large").select("hub", "id")
    return groups, write_step(_linked_to_hub(large, sets, rule), "compared")


def _links(entries: DataFrame, sizes: DataFrame, sets_of, rule: Rule) -> DataFrame:
    """Links between ids, enough for all components. Steps on the way go as soon as these are written.

    A set is moved for what its own stars need: large stars are few or none in a small table, and must not make all
    sets move again as soon as there is one.
    """
    spark = entries.sparkSession
    folder = new_folder(spark, "links")

    def trees(groups: DataFrame, sets: DataFrame) -> DataFrame:
        return groups.join(sets.select("id", "tokens").hint("merge"), "id").groupBy("hub", "a", "b").applyInArrow(
            lambda group: _trees(group, rule), "hub bigint, id bigint"
        ).distinct()

    linked = lambda compared: compared.filter("linked").select("hub", "id")
    with temporary_steps(spark, "candidates"):
        weighed = _weighed(_stars(entries, F.count("*") > 1), sizes)
        ids = weighed.select("id", "large").unionByName(weighed.select(F.col("hub").alias("id"), "large"))
        sets = sets_of(ids.groupBy("id").agg(F.bool_or(~F.col("large")).alias("small"), F.bool_or("large").alias("large")))
        groups, compared = _compared(weighed, sets.filter("large"), rule)
        found = write_step(trees(groups, sets.filter("small")), "trees").unionByName(linked(compared))
        if not compared.filter("NOT linked").isEmpty():
            left = write_step(_open(compared), "open")
            of_left = sets.filter("large").join(left.select("id").distinct().hint("merge"), "id", "left_semi")
            sets = write_step(of_left.select("id", "n", "tokens"), "open-sets")
            narrowed = _weighed(_stars(_narrowed(left, sets, rule), (F.count("*") > 1) & F.bool_or("apart")), sizes)
            groups, compared = _compared(narrowed, sets, rule)
            rest = write_step(trees(groups.unionByName(_blocks(compared, sizes)), sets), "trees")
            found = found.unionByName(rest).unionByName(linked(compared))
        return write_step(found, "links", folder)


# --- the operator ---------------------------------------------------------------------------------


def link_documents(
    docs: DataFrame, words: int = 5, threshold: Fraction = Fraction(8, 10), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: its id, n_shingles (distinct `words`-grams) and component_id.

    Words are runs of other than white space, A-Z lower-cased; a text with fewer words than `words` has them all
    as its one n-gram, a null text or one without words none. Two documents link when the Jaccard similarity of
    their n-grams is at least `threshold`; component_id is the smallest id reachable by links, for a document
    without n-grams its own id. Rows that share an id are one document. A row without an id links with none and
    has no component. Ids are whole numbers; other columns, whatever their names, are not returned. An empty table
    gives an empty result.

    Equal sets are one node, however many documents have them. What is shuffled beside ids are signatures, about a
    sixth of the n-grams at 0.85, and the n-grams of documents that share a signature. No bucket is gathered in
    one place or expanded into pairs.
    """
    rule = Rule(words, threshold.numerator, threshold.denominator)
    rows = pack(docs).select(field(doc_id).cast("long").alias("id"), field(text).alias("text"))
    summary = write_step(
        rows.mapInArrow(lambda b: _summaries(b, words), "id bigint, n bigint, c1 bigint, c2 bigint"), "shingle-sets"
    )
    able = summary.filter("n > 0 AND id IS NOT NULL")
    classes = write_step(able.groupBy("c1", "c2").agg(F.min("id").alias("node")), "shingle-classes")
    copies = write_step(
        able.join(classes, ["c1", "c2"]).groupBy("id").agg(F.max((F.col("id") == F.col("node"))).alias("is_node"))
        .filter(~F.col("is_node")).select("id"),
        "copies",
    )
    with_id = rows.filter("id IS NOT NULL")
    # Copies and candidates are as many as the documents may be: never broadcast, at any size.
    nodes = with_id.join(copies.hint("merge"), "id", "left_anti").select("id", "text")
    entries = nodes.mapInArrow(lambda b: _entries(b, rule), "key bigint, id bigint")

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = with_id.join(write_step(ids, "candidates").hint("merge"), "id").select("id", "text", "small", "large")
        schema = "id bigint, n bigint, tokens array<bigint>, small boolean, large boolean"
        return write_step(wanted.mapInArrow(lambda b: _sets(b, words), schema), "token-sets")

    found = _links(entries, able.groupBy("id").agg(F.sum("n").alias("n")), sets_of, rule)
    # An id with several texts ties their classes together.
    same = able.join(classes, ["c1", "c2"]).filter("id <> node").select(F.col("node").alias("hub"), "id")
    repeated = able.groupBy("id").agg(F.count_distinct("c1", "c2").alias("k")).filter("k > 1").select("id")
    links = same.join(repeated, "id", "left_semi").select("hub", "id").unionByName(found)
    component = components(links)
    of_class = classes.join(component, "node", "left").select(
        "c1", "c2", F.coalesce("component", "node").alias("component")
    )
    labelled = summary.join(of_class, ["c1", "c2"], "left")
    whole = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return labelled.select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), whole).alias("component_id"),
    )
