"""Cleaning, audit and integrity on small tables with expected values worked out by hand."""

import datetime

import pytest

from tagshelf.fixed_values import GAME_INDICATOR_TAGS, NON_GAME_TAGS
from tagshelf.operators import audit, clean, quality
from tagshelf.plans import pipeline
from tagshelf.tables import Tables

GAMES = (
    "appid long, name string, release_date string, price_usd double, achievements long, "
    "positive_reviews long, negative_reviews long, average_playtime_forever long, "
    "median_playtime_forever long, peak_ccu long, genres_and_tags array<string>"
)


def game(appid, name="g", date="Jul 9, 2016", price=1.0, ach=1, pos=1, neg=1, avg=60, med=60, ccu=1):
    return (appid, name, date, price, ach, pos, neg, avg, med, ccu, [])


@pytest.fixture(scope="module")
def make(spark):
    def tables(games, tags, bridge):
        return Tables(
            spark.createDataFrame(games, GAMES),
            spark.createDataFrame(tags, "tag_id long, tag_name string, game_count long"),
            spark.createDataFrame(bridge, "appid long, tag_id long, votes long"),
        )

    return tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_word_lists_are_complete():
    assert len(NON_GAME_TAGS) == len(set(NON_GAME_TAGS)) == 11
    assert len(GAME_INDICATOR_TAGS) == len(set(GAME_INDICATOR_TAGS)) == 32


def test_price_range(make):
    prices = [-1.0, 0.0, 999.0, 999.01, 1500.0, None]
    t = make([game(i, price=p) for i, p in enumerate(prices)], [(1, "A", 1)], [(0, 1, 1)])
    assert [r[1] for r in rows(clean.null_out_of_range(t.games, "price_usd").select("appid", "price_usd"))] == [
        None, 0.0, 999.0, None, None, None,
    ]
    assert rows(audit.audit_price_range(t.games)) == [(1, 2)]


def test_dates(make):
    texts = [
        "2016-07-09", "Jul 2016", "Feb 30, 2020", "jul 09, 2016", "Jul 29, 2016\n", "Foo 4, 2000",
        "Jul 9, 2016", "2016-13-01", None, "Coming soon",
    ]
    t = make([game(i, date=d) for i, d in enumerate(texts)], [(1, "A", 1)], [(0, 1, 1)])
    day = datetime.date(2016, 7, 9)
    parsed = [r.release_date_parsed for r in clean.parse_dates(t.games).orderBy("appid").collect()]
    assert parsed == [day, None, None, day, None, None, day, None, None, None]
    assert rows(clean.date_rejects(t.games)) == [("2016-13-01", 1), ("Feb 30, 2020", 1), ("Foo 4, 2000", 1)]
    extra = [*clean.fv.DATE_RULES, (r"\A\w{3} \d{4}\z", "MMM yyyy")]
    assert clean.parse_dates(t.games, extra).filter("appid = 1").first().release_date_parsed == datetime.date(2016, 7, 1)


def test_dead_entries_and_their_bridge_rows_go(make):
    games = [game(1), game(2, pos=0, neg=0, avg=0, med=0, ccu=5), game(3, pos=0, neg=0, avg=0, med=1)]
    t = make(games, [(1, "A", 9), (2, "B", 9), (3, "C", 9)], [(1, 1, 1), (2, 1, 1), (2, 2, 1), (3, 3, 1)])
    assert rows(audit.zero_engagement_count(t.games)) == [(1,)]
    assert rows(audit.zero_engagement_sample(t.games)) == [(2, "g", "Jul 9, 2016", 1.0)]
    cleaned = pipeline.clean(t)
    assert [r.appid for r in cleaned.games.orderBy("appid").collect()] == [1, 3]
    assert rows(cleaned.game_tags) == [(1, 1, 1), (3, 3, 1)]
    assert rows(cleaned.tags) == [(1, "A", 1), (3, "C", 1)]
    again = pipeline.clean(cleaned)
    assert [rows(a) for a in again] == [rows(c) for c in cleaned]


def software(make):
    games = [game(i) for i in range(1, 6)]
    tags = [(1, "Software", 5), (2, "Indie", 5), (3, "Other", 5)]
    bridge = [(1, 1, 5), (2, 1, 4), (3, 1, 5), (3, 2, 0), (4, 3, 9), (5, 1, 50), (5, 3, 7), (99, 1, 9)]
    return make(games, tags, bridge)


def test_candidates(make):
    """Enough votes, no game tag, and the game must exist."""
    t = software(make)
    assert rows(clean.non_game_appids(t.games, t.game_tags, t.tags)) == [(1,), (5,)]
    review = [(r.appid, r.non_game_tag, r.non_game_tag_votes) for r in audit.non_game_review(*(t.games, t.game_tags, t.tags)).collect()]
    assert review == [(5, "Software", 50), (5, "Other", 7), (1, "Software", 5)]


def test_removal(make):
    t = pipeline.remove_non_games(software(make))
    assert [r.appid for r in t.games.orderBy("appid").collect()] == [2, 3, 4]
    assert rows(t.game_tags) == [(2, 1, 4), (3, 1, 5), (3, 2, 0), (4, 3, 9)]
    assert rows(t.tags) == [(1, "Software", 2), (2, "Indie", 1), (3, "Other", 1)]
    pipeline.validate(t)


def test_guard(spark, make):
    assert clean.guard_max_rows(spark.range(1000)) == 1000
    with pytest.raises(ValueError, match="1001 rows .* more than 1000"):
        clean.guard_max_rows(spark.range(1001))
    with pytest.raises(ValueError, match="2 rows .* more than 1"):
        pipeline.remove_non_games(software(make), max_rows=1)


def test_recount_and_prune(make):
    t = make([game(1), game(2)], [(1, "A", 9), (2, "B", 9)], [(1, 1, 1), (2, 1, 1), (2, 1, 1)])
    assert rows(clean.recount_tags(t.tags, t.game_tags)) == [(1, "A", 2), (2, "B", 0)]
    assert rows(clean.prune_orphan_tags(t.tags, t.game_tags)) == [(1, "A", 9)]
    assert rows(clean.refresh_tags(t.tags, t.game_tags)) == [(1, "A", 2)]


def test_integrity(make):
    t = make([game(1), game(1), game(2)], [(1, "A", 1)], [(1, 1, 1), (1, 1, 2), (3, 1, 1), (2, 9, 1), (None, 1, 1)])
    assert rows(quality.check_pk(t.games, ["appid"])) == [(1, 2)]
    found = quality.check_pk(t.game_tags, ["appid", "tag_id"]).collect()
    assert sorted(((r.appid or 0), r.tag_id, r.n_rows) for r in found) == [(0, 1, 1), (1, 1, 2)]
    assert rows(quality.check_fk(t.game_tags, t.games, "appid")) == [(3, 1)]
    assert rows(quality.check_fk(t.game_tags, t.tags, "tag_id")) == [(9, 1)]
    assert rows(quality.cascade(t.tags, t.game_tags.na.drop(), "tag_id")) == [(1, 1, 1), (1, 1, 2), (3, 1, 1)]


def test_audit_summary(make):
    t = make(
        [game(1, name=None), game(2, price=None, ccu=0), game(3, pos=0, neg=0, avg=0)], [(1, "A", 1)], [(1, 1, 1)]
    )
    assert rows(audit.audit_summary(t.games)) == [(3, 1, 1, 1, 1, 1)]
    assert set(pipeline.audit(t)) == {
        "audit_summary", "audit_price_range", "audit_date_values", "zero_engagement_count",
        "zero_engagement_sample", "non_game_candidates", "non_game_count", "non_game_review",
    }


def test_statistics(spark):
    spark.range(10).write.mode("overwrite").saveAsTable("stats_probe")
    quality.analyze(spark, "stats_probe")
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED stats_probe").collect()}
    assert "10 rows" in described["Statistics"]


def test_one_step_equals_two(make):
    games = [game(1), game(2, pos=0, neg=0, avg=0, med=0), game(3, price=-1.0), game(4)]
    t = make(games, [(1, "Software", 9), (2, "Indie", 9)], [(1, 1, 5), (2, 1, 9), (3, 1, 1), (3, 2, 3), (4, 1, 2)])
    one, two = pipeline.clean_and_remove(t), pipeline.remove_non_games(pipeline.clean(t))
    assert [r.appid for r in one.games.orderBy("appid").collect()] == [3, 4]
    assert [rows(x) for x in one] == [rows(x) for x in two]


def test_two_tags_of_one_name_are_refused(make):
    t = make([game(1)], [(1, "A", 1), (2, "A", 1)], [(1, 1, 5), (1, 2, 9)])
    with pytest.raises(ValueError, match="tags.tag_name"):
        pipeline.validate(t)
