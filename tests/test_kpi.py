"""KPIs on small tables: thresholds, bands, brackets, constants, ties, repeated rows, skew."""

import random
import statistics

import pytest

from tagshelf import fixed_values as fv
from tagshelf.functions import numeric, predicates
from tagshelf.operators import audit, kpi
from tagshelf.operators.summary import bucket_of, summarise
from tests.test_clean import GAMES, game, make, rows  # noqa: F401

from pyspark.sql import functions as F


def by(df, key="tag_name"):
    return {r[key]: r for r in df.collect()}


def tagged(make, games, sizes):  # noqa: F811
    """Tag i holds the first sizes[i] games."""
    tags = [(i, f"T{i}", n) for i, n in enumerate(sizes, 1)]
    bridge = [(games[k][0], i, 1) for i, n in enumerate(sizes, 1) for k in range(n)]
    return make(games, tags, bridge)


def test_constant_achievements_and_the_twenty_games_rule(make):  # noqa: F811
    t = tagged(make, [game(i, ach=0, avg=60 * i) for i in range(1, 31)], [20, 19])
    got = by(kpi.playtime_by_tag(*(t.games, t.game_tags, t.tags)))
    assert set(got) == {"T1"}
    row = got["T1"]
    assert (row.game_count, row.avg_playtime_hrs, row.median_playtime_hrs) == (20, 10.5, 10.5)
    assert (row.avg_achievements, row.playtime_achievements_corr, row.achievement_band) == (0.0, None, "None")


@pytest.mark.parametrize(
    "total, band",
    [(0, "None"), (1, "Low (1–14)"), (299, "Low (1–14)"), (300, "Mid (15–49)"), (999, "Mid (15–49)"),
     (1000, "High (50–99)"), (1999, "High (50–99)"), (2000, "Very High (100+)")],
)
def test_bands_are_cut_on_the_exact_average(spark, total, band):
    df = spark.range(1).select(F.expr(kpi.achievement_band(str(total), "20")).alias("b"))
    assert df.first().b == band


def test_report_labels(spark):
    label = lambda o, style: spark.range(1).select(F.expr(kpi.price_label(str(o), style))).first()[0]
    assert (label(2, "view"), label(2, "report"), label(8, "view")) == ("$0.01–$4.99", "$0.01 – $4.99", "$60+")
    band = spark.range(1).select(F.expr(kpi.achievement_band("20", "20", "report"))).first()[0]
    assert band == "Low  (1–14)"


def test_price_brackets(make):  # noqa: F811
    prices = [0.0, 4.99, 5.0, 10.0, 20.0, 30.0, 40.0, 60.0, None]
    t = tagged(make, [game(i, price=p) for i, p in enumerate(prices)] + [game(99, price=1.0, avg=0)], [1])
    got = kpi.playtime_by_price(t.games, style="report").collect()
    assert [r.sort_order for r in got] == list(range(9))
    assert [r.game_count for r in got] == [1] * 9
    assert [r.price_bracket for r in got][:3] == ["Unknown", "Free", "$0.01 – $4.99"]


def test_release_window(make):  # noqa: F811
    from tagshelf.operators.clean import parse_dates

    days = ["1999-12-31", "2000-01-01", "2020-06-01", "2020-05-31", "2000-07-01"]
    t = tagged(make, [game(i, date=d) for i, d in enumerate(days)], [5])
    got = kpi.releases_by_year_tag(parse_dates(t.games), t.game_tags, t.tags, as_of="2020-06-01")
    assert sorted((r.release_year, r.games_released, r.cumulative_games) for r in got.collect()) == [
        (2000, 2, 2), (2020, 1, 3),
    ]


def test_models(make):  # noqa: F811
    games = [game(i, price=0.0, avg=60) for i in range(10)] + [game(10 + i, price=2.0, avg=120) for i in range(9)]
    games += [game(50, price=None)]
    t = tagged(make, games, [20])
    per_tag = kpi.f2p_vs_paid(t.games, t.game_tags, t.tags).collect()
    assert [(r.model, r.game_count, r.avg_approval_pct) for r in per_tag] == [("Free to Play", 10, 50.0)]
    total = by(kpi.f2p_vs_paid_summary(t.games), "model")
    assert total["Free to Play"].playtime_hrs_per_dollar is None
    assert (total["Paid"].game_count, total["Paid"].playtime_hrs_per_dollar) == (9, 1.0)


def test_review_thresholds(make):  # noqa: F811
    games = [game(i, pos=20, neg=5) for i in range(20)] + [game(99, pos=5, neg=4)]
    t = tagged(make, games, [20, 19])
    row = kpi.review_scores_by_tag(t.games, t.game_tags, t.tags).collect()
    assert [(r.tag_name, r.game_count, r.total_reviews, r.pooled_approval_pct) for r in row] == [("T1", 20, 500, 80.0)]
    one_less = tagged(make, [game(i, pos=20, neg=5) for i in range(19)] + [game(19, pos=20, neg=4)], [20])
    assert kpi.review_scores_by_tag(one_less.games, one_less.game_tags, one_less.tags).isEmpty()


def test_wilson_bound(spark):
    score = lambda p, n: spark.range(1).select(F.expr(numeric.wilson_lower_bound(str(p), str(n)))).first()[0]
    assert score(0, 0) is None
    assert score(0, 10) == pytest.approx(0, abs=1e-9)
    assert score(90, 100) == pytest.approx(83.9638, abs=1e-3)
    assert score(900, 1000) > score(90, 100) > score(9, 10)
    assert score(10, 10) <= 100


def test_rounding_is_half_away_from_zero(spark):
    values = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (0.15,)], "x double")
    got = values.select(F.expr(numeric.rounded("x", 2)), F.expr(numeric.rounded("x", 0))).collect()
    assert [tuple(r) for r in got] == [(1.01, 1.0), (2.5, 3.0), (-2.5, -3.0), (0.15, 0.0)]


@pytest.mark.parametrize(("base", "offset"), [(10**5, 0), (10**6, 0), (10**7, 100), (10**7, 10**6), (10**8, 0)])
def test_correlation_of_narrow_spreads_around_large_means(spark, base, offset):
    """300,000 rows: power sums lose all their digits here."""
    df = spark.range(300_000).selectExpr(
        "'t' AS k", f"{base} + id % 7 AS x", f"{offset} + id % 7 + id % 5 AS y"
    )
    got = summarise(df, ["k"], "x", pair=("x", "y")).select(F.expr(numeric.pearson("sxx", "syy", "sxy", "true"))).first()[0]
    assert got == pytest.approx(df.select(F.corr("x", "y")).first()[0], abs=1e-6)
    assert got == pytest.approx(0.816, abs=1e-3)


def test_correlation_over_many_buckets(spark):
    rng = random.Random(7)
    pairs = [(x := rng.randrange(1, 10**6), x // 1000 + rng.randrange(900)) for _ in range(500)]
    df = spark.createDataFrame([("a", *p) for p in pairs] + [("b", 5, 1), ("c", 1, None)], "k string, x long, y long")
    stats = summarise(df, ["k"], "x", pair=("x", "y"))
    got = {r["k"]: r["r"] for r in stats.select("k", F.expr(numeric.pearson("sxx", "syy", "sxy", "n > 1")).alias("r")).collect()}
    assert got == {"a": pytest.approx(statistics.correlation(*zip(*pairs)), abs=1e-9), "b": None, "c": None}


def test_summary_against_brute_force_with_a_hot_group(spark):
    """A third of the rows in one group; even and odd sizes, repeated values."""
    rng = random.Random(3)
    data = [("hot", rng.randrange(1, 400)) for _ in range(2000)]
    data += [(f"k{rng.randrange(40)}", rng.randrange(1, 10**7)) for _ in range(3999)]
    df = spark.createDataFrame(data, "k string, m long")
    groups = {}
    for k, m in data:
        groups.setdefault(k, []).append(m)
    got = {r.k: (r.n, int(r.total_minutes), r.median_minutes) for r in summarise(df, ["k"], "m").collect()}
    assert got == {k: (len(v), sum(v), float(statistics.median(v))) for k, v in groups.items()}


def test_summary_over_the_whole_range_of_values(spark):
    """Middle rows in one bucket, in two neighbouring and in two distant ones; zero and huge values."""
    groups = {
        "one": [5], "two": [1, 10**15], "same": [7] * 10, "edge": [31, 32, 63, 64, 2**53 - 1, 2**53],
        "far": [1] * 50 + [2**40] * 50, "odd": [1] * 50 + [2**40] * 51, "zero": [0, 0, 3],
        "close": list(range(10**6, 10**6 + 1001)),
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, m long")
    got = {r.k: r.median_minutes for r in summarise(df, ["k"], "m").collect()}
    assert got == {k: float(statistics.median(v)) for k, v in groups.items()}


def test_sums_are_exact_at_any_size(spark):
    groups = {"e": [3] * 7 + [2**40 + 1] * 3, "a": [2**62] * 5, "b": [9007199254740993] * 3}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, m long")
    got = {r.k: int(r.total_minutes) for r in summarise(df, ["k"], "m").collect()}
    assert got == {k: sum(vs) for k, vs in groups.items()}


def test_buckets_are_in_order(spark):
    edges = sorted({max(0, 2**k + d) for k in range(63) for d in (-2, -1, 0, 1, 2, 2**k // 3)})
    df = spark.createDataFrame([(v,) for v in edges if v < 2**63], "v long")
    numbers = [r.b for r in df.orderBy("v").select(F.expr(bucket_of("v")).alias("b")).collect()]
    assert numbers == sorted(numbers) and numbers[-1] <= 487


def test_repeated_bridge_rows_count_a_game_once(make):  # noqa: F811
    """Unchecked tables: distinct games are counted, while averages see every row of the join."""
    games = [game(i, avg=60 * i, price=1.0, pos=30) for i in range(1, 31)]
    t = tagged(make, games, [25])
    doubled = t.game_tags.union(t.game_tags.filter("appid = 1"))
    args = (t.games, doubled, t.tags)
    row = kpi.playtime_by_tag(*args).first()
    minutes = [60 * i for i in range(1, 26)] + [60]
    assert (row.game_count, row.median_playtime_hrs) == (25, statistics.median(minutes) / 60)
    assert row.avg_playtime_hrs == pytest.approx(statistics.mean(minutes) / 60, abs=0.05)
    assert kpi.f2p_vs_paid(*args).first().game_count == 25
    assert kpi.review_scores_by_tag(*args).first().game_count == 25


def test_reports_are_sorted_and_cut(make):  # noqa: F811
    t = tagged(make, [game(i, avg=60 * i) for i in range(1, 41)], [20, 30, 40])
    got = kpi.playtime_by_tag(t.games, t.game_tags, t.tags, top=2, style="report").collect()
    assert [r.tag_name for r in got] == ["T3", "T2"]
    assert "playtime_achievement_corr" in got[0].asDict()
    top = kpi.f2p_vs_paid(t.games, t.game_tags, t.tags, top=1).collect()
    assert [r.tag_name for r in top] == ["T3"]


def test_predicates(spark):
    df = spark.sql("SELECT map('Action', 1500L, 'RPG', 2L) AS tags, array('RPG', 'Indie') AS items")
    has = lambda c: df.select(c).first()[0]
    tags, items = F.col("tags"), F.col("items")
    assert has(predicates.json_has_key(tags, "Action")) is True
    assert has(predicates.json_has_key(tags, "Indie")) is False
    assert has(predicates.json_contains_object(tags, {"Action": 1500})) is True
    assert has(predicates.json_contains_object(tags, {"Action": 1})) is False
    assert has(predicates.json_contains_object(tags, {"Indie": 1})) is False
    assert has(predicates.json_contains_object(tags, {"Action": 1500, "RPG": 3})) is False
    assert has(predicates.json_contains_array(items, ["RPG"])) is True
    assert has(predicates.json_contains_array(items, ["RPG", "Casual"])) is False
    assert has(predicates.json_contains_array(items, [])) is True


def test_votes_filter(make):  # noqa: F811
    t = make([game(1), game(2), game(3)], [(1, "A", 3), (2, "B", 1)], [(1, 1, 5), (2, 1, 6), (3, 2, 9)])
    assert [r.appid for r in audit.tag_votes_over(t.games, t.game_tags, t.tags, "A", 5).collect()] == [2]


def test_repeated_rows_count_as_often_as_they_meet(spark):
    """Without checked keys: rows of games and bridge that repeat, against a plain join and plain aggregates."""
    random.seed(9)
    games = [(i, random.choice([0, 5, 60, 600, 10**9 + i]), random.randint(0, 50), random.choice([0.0, 5.0, None]),
              random.randint(0, 40), random.randint(0, 40), None) for i in range(60)]
    games += games[:20] * 3 + [(i, 77, 7, 9.0, 30, 3, None) for i in range(10)]
    bridge = [(i, t, 1) for i in range(60) for t in range(4) if random.random() < 0.6]
    bridge += bridge[:50] * 2
    schema = "appid long, average_playtime_forever long, achievements long, price_usd double, positive_reviews long, negative_reviews long, release_date_parsed date"
    g, b = spark.createDataFrame(games, schema), spark.createDataFrame(bridge, "appid long, tag_id long, votes long")
    tags = spark.createDataFrame([(t, f"T{t}", 1) for t in range(4)], "tag_id long, tag_name string, game_count long")
    met = [(t, x) for x in games for (i, t, _) in bridge if i == x[0]]
    got = {r.tag_name: r for r in kpi.playtime_by_tag(g, b, tags, min_games=1).collect()}
    for t in range(4):
        own = [x for tag, x in met if tag == t and x[1] > 0]
        r = got[f"T{t}"]
        assert r.game_count == len({x[0] for x in own})
        assert r.median_playtime_hrs == pytest.approx(round(statistics.median(x[1] for x in own) / 60, 1), abs=0.051)
        assert r.avg_playtime_hrs == pytest.approx(round(sum(x[1] for x in own) / len(own) / 60, 1), abs=0.051)
        assert r.avg_achievements == pytest.approx(sum(x[2] for x in own) / len(own), abs=0.51)
        xs, ys = [x[1] for x in own], [x[2] for x in own]
        assert r.playtime_achievements_corr == pytest.approx(statistics.correlation(xs, ys), abs=0.00051)
    got = {(r.tag_name, r.model): r for r in kpi.f2p_vs_paid(g, b, tags, min_games=1).collect()}
    for (t, model), r in got.items():
        own = [x for tag, x in met if f"T{tag}" == t and x[1] > 0 and x[3] is not None and (x[3] == 0) == (model == fv.FREE_MODEL)]
        rated = [100 * x[4] / (x[4] + x[5]) for x in own if x[4] + x[5]]
        assert r.game_count == len({x[0] for x in own})
        assert r.median_playtime_hrs == pytest.approx(statistics.median(x[1] for x in own) / 60, abs=0.051)
        assert r.avg_approval_pct == pytest.approx(sum(rated) / len(rated), abs=0.051)
    for r in kpi.review_scores_by_tag(g, b, tags, min_games=1, min_total_reviews=1).collect():
        own = [x for tag, x in met if f"T{tag}" == r.tag_name and x[4] + x[5] >= 10]
        assert r.game_count == len({x[0] for x in own}) and r.total_reviews == sum(x[4] + x[5] for x in own)
        assert r.avg_approval_pct == pytest.approx(sum(100 * x[4] / (x[4] + x[5]) for x in own) / len(own), abs=0.051)


def test_the_shared_join_needs_checked_keys(spark):
    games = spark.createDataFrame([], "appid long, average_playtime_forever long, achievements long")
    with pytest.raises(ValueError, match="keys are checked"):
        kpi.playtime_by_tag(games, games, games, joined=games)
