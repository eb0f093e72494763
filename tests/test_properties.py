"""Laws that must hold on the given tables."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tagshelf.functions import coerce, numeric
from tagshelf.operators import clean, kpi
from tagshelf.plans import pipeline

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return entry.loaded(spark, SF_DIR)


@pytest.fixture(scope="module")
def t(spark):
    return entry.ready(spark, SF_DIR)


def test_removed_and_kept_make_the_whole(raw):
    kept, gone = clean.drop_zero_engagement(raw.games), clean.zero_engagement(raw.games)
    assert kept.count() + gone.count() == raw.games.count()
    assert kept.join(gone, "appid", "left_semi").isEmpty()


def test_bridge_points_at_games_and_tags(t):
    assert all(df.isEmpty() for df in pipeline.violations(t).values())


def test_running_total_ends_at_the_sum(t):
    years = kpi.releases_by_year_tag(t.games, t.game_tags, t.tags, as_of="2026-01-01")
    off = years.groupBy("tag_name").agg(
        (F.sum("games_released") - F.max("cumulative_games")).alias("gap")
    ).filter("gap <> 0")
    assert off.isEmpty()


def test_wilson_stays_below_the_pooled_share(t):
    scores = kpi.review_scores_by_tag(t.games, t.game_tags, t.tags, min_total_reviews=0, min_games=0)
    assert scores.count() == 31
    assert scores.filter("NOT (wilson_score BETWEEN 0 AND 100) OR wilson_score > pooled_approval_pct + 0.1").isEmpty()


def test_brackets_cover_every_played_game_once(t):
    total = kpi.playtime_by_price(t.games).agg(F.sum("game_count")).first()[0]
    assert total == kpi.played(t.games).count()


names = st.lists(st.text(alphabet="aAbB é\t", max_size=4), max_size=8)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(names, names), min_size=1, max_size=20))
def test_merged_lists(spark, pairs):
    """Against the plain definition: strip, drop empties, first spelling of each name whatever its case."""
    df = spark.createDataFrame(pairs, "c array<string>, t array<string>")
    got = [r[0] for r in df.select(coerce.merge_genres_and_tags(F.col("c"), F.col("t"))).collect()]
    for (c, tags), merged in zip(pairs, got):
        first = {}
        for item in [x.strip() for x in c + tags]:
            if item:
                first.setdefault(item.lower(), item)
        assert merged == list(first.values())


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=30))
def test_exact_ratio(spark, pairs):
    from decimal import ROUND_HALF_UP, Decimal
    from fractions import Fraction

    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(F.expr(numeric.rounded_ratio("a", "b", 1))).collect()]
    for (a, b), value in zip(pairs, got):
        exact = Fraction(a, b)
        assert value == float((Decimal(exact.numerator) / Decimal(exact.denominator)).quantize(Decimal("0.1"), ROUND_HALF_UP))
