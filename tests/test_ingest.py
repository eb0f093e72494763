"""Ingest on hand-written records with expected values worked out by hand."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from tagshelf.functions import coerce
from tagshelf.operators import shaping
from tagshelf.plans import pipeline
from tagshelf.sources.records import read_games

REGULAR = {
    "name": "Regular", "release_date": "Jul 9, 2016", "price": 9.99, "dlc_count": 1,
    "windows": True, "mac": False, "linux": False, "metacritic_score": 80, "achievements": 12,
    "recommendations": 7, "developers": ["Dev"], "publishers": ["Pub"], "categories": ["Single-player"],
    "positive": 10, "negative": 2, "average_playtime_forever": 120, "median_playtime_forever": 60,
    "peak_ccu": 3, "tags": {"RPG": 5}, "estimated_owners": "0 - 20000",
}


def record(**changes):
    changed = {**REGULAR, **changes}
    return json.dumps({k: v for k, v in changed.items() if v is not ...})


def write_object(folder, records, name="games.json"):
    """Records as one object, keys as given, so that a key may come up twice."""
    path = folder / name
    path.write_text("{" + ",\n ".join(f"{json.dumps(k)}: {v}" for k, v in records) + "}", encoding="utf-8")
    return str(path)


def load(spark, folder, records, **kw):
    return pipeline.load(spark, write_object(folder, records), "object", **kw)


def by_appid(games):
    return {row.appid: row for row in games.collect()}


def bridge(tables):
    named = tables.game_tags.join(tables.tags, "tag_id")
    return {(r.appid, r.tag_name): r.votes for r in named.collect()}


def test_regular_record_keeps_every_column(spark, tmp_path):
    tables = load(spark, tmp_path, [("10", record())])
    row = by_appid(tables.games)[10].asDict()
    assert row == {
        "appid": 10, "name": "Regular", "release_date": "Jul 9, 2016", "price_usd": 9.99, "dlc_count": 1,
        "windows": True, "mac": False, "linux": False, "metacritic_score": 80, "achievements": 12,
        "recommendations": 7, "developers": ["Dev"], "publishers": ["Pub"], "positive_reviews": 10,
        "negative_reviews": 2, "average_playtime_forever": 120, "median_playtime_forever": 60,
        "peak_ccu": 3, "tags": {"RPG": 5}, "genres_and_tags": ["Single-player", "RPG"],
    }
    assert pipeline.clean_games(tables.games).first().release_date_parsed == datetime.date(2016, 7, 9)
    assert [tuple(r) for r in tables.tags.collect()] == [(1, "RPG", 1)]
    assert [tuple(r) for r in tables.game_tags.collect()] == [(10, 1, 5)]


def test_keys(spark, tmp_path):
    """A key that is no number is dropped; a decimal one is cut and then clashes with its twin."""
    tables = load(spark, tmp_path, [("abc", record()), ("20", record()), ("20.5", record()), ("", record())])
    assert [r.appid for r in tables.games.collect()] == [20, 20]
    with pytest.raises(ValueError, match="primary key of games"):
        pipeline.validate(tables)


@pytest.mark.parametrize(
    "given, expected",
    [("9.99", 9.99), ("free", None), (0, 0.0), (..., None), (None, None), (" 5. ", 5.0), ("1d", None),
     ("nan", None), ("1e2", 100.0), (True, 1.0), ("true", None), ([1], None)],
)
def test_price(spark, tmp_path, given, expected):
    tables = load(spark, tmp_path, [("1", record(price=given))])
    assert tables.games.first().price_usd == expected


def test_counts(spark, tmp_path):
    given = ["3.7", -3.7, None, "x", True, ..., "true", "\t7\n", 1e30, [], {}, 3.0]
    expected = [3, -3, 0, 0, 1, 0, 0, 7, 0, 0, 0, 3]
    tables = load(spark, tmp_path, [(str(i), record(achievements=v)) for i, v in enumerate(given)])
    games = by_appid(tables.games)
    assert [games[i].achievements for i in range(len(given))] == expected


def test_infinite_count_is_softened_and_reported(spark, tmp_path):
    report = {}
    records = [("1", record(achievements="inf")), ("2", record(windows=..., name="A test"))]
    tables = load(spark, tmp_path, records, report=report)
    assert tables.games.first().achievements == 0
    assert report == {
        "records": 2, "absent_windows": 1, "absent_mac": 0, "absent_linux": 0, "infinite_counts": 1,
        "with_appid": 2, "null_names": 0, "test_names": 1, "zero_signal": 0,
    }


def test_flags(spark, tmp_path):
    given = [True, None, ..., "yes", "false", "", 0, 0.0, 2, [], [0], {}, {"a": 1}, False]
    expected = [True, False, True, True, True, False, False, False, True, False, True, False, True, False]
    tables = load(spark, tmp_path, [(str(i), record(windows=v)) for i, v in enumerate(given)])
    games = by_appid(tables.games)
    assert [games[i].windows for i in range(len(given))] == expected


def test_absent_flag_is_a_choice(spark, tmp_path):
    tables = load(spark, tmp_path, [("1", record(mac=...))], absent_flag=False)
    assert tables.games.first().mac is False


def test_lists(spark, tmp_path):
    given = ["x", 5, {"a": 1}, ["d"], None, ..., []]
    tables = load(spark, tmp_path, [(str(i), record(developers=v)) for i, v in enumerate(given)])
    games = by_appid(tables.games)
    assert [games[i].developers for i in range(len(given))] == [[], [], [], ["d"], [], [], []]


def test_tags(spark, tmp_path):
    """Anything but an object is no tags; names are stripped but stay apart by case; votes are lenient."""
    given = [[], {"RPG": 5, " rpg ": 3, "Zed": "x", " ": 4}, '{"q": 1}', None, {"RPG": 5, "RPG ": 9}]
    tables = load(spark, tmp_path, [(str(i), record(tags=v)) for i, v in enumerate(given)])
    games = by_appid(tables.games)
    assert [games[i].tags for i in (0, 2, 3)] == [{}, {}, {}]
    assert bridge(tables) == {(1, "RPG"): 5, (1, "rpg"): 3, (1, "Zed"): 0, (4, "RPG"): 5}


def test_repeated_json_key_keeps_first_place_and_last_value(spark, tmp_path):
    text = record(tags=..., categories=[])[:-1] + ', "tags": {"Z": 1, "A": 2, "Z": 3}}'
    tables = load(spark, tmp_path, [("1", text)])
    row = tables.games.first()
    assert row.tags == {"Z": 3, "A": 2}
    assert row.genres_and_tags == ["Z", "A"]
    assert bridge(tables) == {(1, "Z"): 3, (1, "A"): 2}


def test_repeated_appid_in_the_object_keeps_its_last_record(spark, tmp_path):
    tables = load(spark, tmp_path, [("1", record(name="old")), ("2", record()), ("1", record(name="new"))])
    assert {r.appid: r.name for r in tables.games.collect()} == {1: "new", 2: "Regular"}


def test_first_record_wins_for_a_tag_of_two_records(spark, tmp_path):
    tables = load(spark, tmp_path, [("7.1", record(tags={"A": 1})), ("7", record(tags={"A": 2, "B": 3}))])
    assert bridge(tables) == {(7, "A"): 1, (7, "B"): 3}


def test_merged_list(spark, tmp_path):
    changes = {"categories": [" RPG", "Co-op", ""], "tags": {"rpg": 1, "CO-OP": 2, "New": 3}}
    tables = load(spark, tmp_path, [("1", record(**changes)), ("2", record(categories="x", tags={"B": 1, "A": 2}))])
    games = by_appid(tables.games)
    assert games[1].genres_and_tags == ["RPG", "Co-op", "New"]
    assert games[2].genres_and_tags == ["B", "A"]


def test_names(spark, tmp_path):
    given = ["A Test", "contest", "étest", "test_1", None, ..., "TEST: x", "x-test", 5, ""]
    tables = load(spark, tmp_path, [(str(i), record(name=v)) for i, v in enumerate(given)])
    assert sorted(by_appid(tables.games)) == [1, 2, 3, 8, 9]


def test_zero_signal_is_dropped_whatever_the_playtime(spark, tmp_path):
    dead = {"peak_ccu": 0, "positive": 0, "negative": 0}
    tables = load(spark, tmp_path, [("1", record(**dead)), ("2", record(**{**dead, "peak_ccu": 5})), ("3", record())])
    assert sorted(by_appid(tables.games)) == [2, 3]


def test_no_tags_at_all(spark, tmp_path):
    with pytest.raises(ValueError, match="no tags parsed"):
        load(spark, tmp_path, [("1", record(tags=[])), ("2", record(tags={}))])


def test_tag_ids_follow_codepoint_order(spark, tmp_path):
    names = ["b", "B", "é", "a b", "Z", "日本", "😀", "a"]
    tables = load(spark, tmp_path, [("1", record(tags={n: 1 for n in names})), ("2", record(tags={"b": 1}))])
    got = {r.tag_name: (r.tag_id, r.game_count) for r in tables.tags.collect()}
    assert got == {n: (i, 2 if n == "b" else 1) for i, n in enumerate(sorted(names), 1)}


def test_ids_are_dense_over_many_ranges(spark):
    names = spark.range(5000).selectExpr("concat('n', cast(id * 7919 % 5000 as string)) AS tag_name")
    numbered = shaping.number_names(names, "tag_name", "tag_id").orderBy("tag_id").collect()
    assert [r.tag_id for r in numbered] == list(range(1, 5001))
    assert [r.tag_name for r in numbered] == sorted(r.tag_name for r in numbered)


def test_both_layouts_agree(spark, tmp_path):
    records = [(str(i), record(name=f"Game {i}", tags={f"T{i % 3}": i, "All": 1})) for i in range(1, 40)]
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join('{"appid": "%s", %s' % (k, v[1:]) for k, v in records) + "\n\n")
    a, b = load(spark, tmp_path, records), pipeline.load(spark, str(lines), "ndjson")
    for x, y in zip(a, b):
        assert sorted(map(repr, x.collect())) == sorted(map(repr, y.collect()))


def test_many_object_files(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write_object(folder, [("1", record())], "a.json")
    write_object(folder, [("2", record())], "b.json")
    assert sorted(r.appid for r in pipeline.load(spark, str(folder), "object").games.collect()) == [1, 2]


@pytest.mark.parametrize("layout", ["object", "ndjson"])
def test_broken_input_fails(spark, tmp_path, layout):
    path = tmp_path / "broken.json"
    path.write_text('{"1": {"name": "x"')
    with pytest.raises(Exception, match="not a JSON object"):
        read_games(spark, str(path), layout).collect()


def test_unknown_layout(spark):
    with pytest.raises(ValueError, match="layout"):
        read_games(spark, "x", "xml")


def test_coercion_of_plain_text_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("3.9", '["a"]', '{"k": 1}'), ("x", '{"k": 1}', "[]"), (None, None, None)], "n string, l string, m string")
    rows = df.select(
        coerce.coerce_long0(F.col("n")), coerce.coerce_array(F.col("l")), coerce.coerce_map(F.col("m"))
    ).collect()
    assert [tuple(r) for r in rows] == [(3, ["a"], {"k": "1"}), (0, [], {}), (0, [], {})]
    assert [r.n for r in coerce.coerce_key(df, "n").collect()] == [3]


def test_lines_are_parsed_once(spark, tmp_path):
    """Filters on the result are not pushed below the parsing projection, where they would parse again."""
    lines = tmp_path / "lines.ndjson"
    lines.write_text('{"appid": "1", "name": "a", "price": 1, "positive": 5, "tags": {"x": 1}}\n')
    raw = read_games(spark, str(lines))
    text = raw.filter("name IS NOT NULL AND appid <> ''")._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1


def test_merging_grows_as_sorting_does(spark):
    """A list of 100,000 names, every second a repeat in other spelling, against one of 10,000."""
    def seconds(n):
        names = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.when(i % 2 == 0, "tag ").otherwise("TAG "), (i / 2).cast("int").cast("string")))
        df = spark.range(1).select(F.size(coerce.merge_genres_and_tags(names, F.array(F.lit("x")))).alias("n"))
        best = []
        for _ in range(3):
            began = time.perf_counter()
            assert df.filter("n >= 0").first()[0] == n // 2 + 2
            best.append(time.perf_counter() - began)
        return min(best)

    assert seconds(100_000) < 15 * seconds(10_000)
