"""What a task holds and how often a step runs, whatever the size of the tables."""

import json

import pytest

import __spark_entry__ as entry
from tagshelf.operators import clean, kpi, quality
from tagshelf.sources.json_object import read_entries
from tagshelf.sources.shared import TASK_SIZES, dealt, small_tasks, write_through
from tagshelf.tables import Tables

BRIDGE = [(1, 1, 5), (1, 2, 3), (2, 1, 4), (2, 1, 4), (None, 1, 1), (3, None, 1)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark):
    games = spark.createDataFrame([(i, f"g{i}", 60 * i, i) for i in (1, 2, 3)], "appid long, name string, average_playtime_forever long, achievements long")
    tags = spark.createDataFrame([(1, "a"), (2, "b")], "tag_id long, tag_name string")
    return Tables(games, tags, spark.createDataFrame(BRIDGE, "appid long, tag_id long, votes long"))


def test_small_tasks_lower_sizes_for_a_while(spark):
    reading, shuffled = TASK_SIZES
    spark.conf.set(reading, "600")
    try:
        with small_tasks(spark):
            assert spark.conf.get(reading) == "600"
            assert int(spark.conf.get(shuffled)) == TASK_SIZES[shuffled]
        assert spark.conf.get(reading) == "600"
        assert spark.conf.get(shuffled) == "67108864b"
    finally:
        spark.conf.unset(reading)


def test_steps_are_written_by_small_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(TASK_SIZES, "spark.sql.files.maxPartitionBytes", 1000)
    (tmp_path / "lines").write_text("some words\n" * 1000)
    assert len(write_through(spark.read.text(str(tmp_path / "lines")), "lines").inputFiles()) == 11


def test_dealt_rows_are_not_merged(spark):
    rows = dealt(spark.range(100), "id")
    assert rows.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_games_per_tag_deals_pairs(tables):
    counted = clean.games_per_tag(clean.prune_orphan_bridge(tables.game_tags, tables.games))
    assert {r["tag_id"]: r["game_count"] for r in counted.collect()} == {1: 2, 2: 1, None: 1}
    assert "REPARTITION_BY_NUM" in plan_of(counted)


def test_unchecked_kpi_deals_both_sides(tables):
    text = plan_of(kpi.tagged(tables.games, tables.game_tags, assume_unique=False))
    assert text.count("REPARTITION_BY_NUM") == 2


def test_unread_statistics_are_not_computed(tables):
    found = quality.statistics(tables)
    assert found.columns == ["table_name", "column_name", "n_rows", "n_null", "n_distinct", "min_value", "max_value", "deciles"]
    text = plan_of(found.drop("deciles", "n_distinct"))
    assert "percentile_approx" not in text and "approx_count_distinct" not in text


def test_the_checked_bridge_is_made_once(tables):
    found = entry.bridge_checked(tables._replace(game_tags=tables.game_tags.dropna().distinct()))
    assert sorted(map(tuple, found.collect())) == [(1, 1, 5), (1, 2, 3), (2, 1, 4)]
    assert "collect_list" not in plan_of(found)


def test_objects_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    records = spark.range(40).repartition(4).selectExpr("id AS appid", "concat('{\"n\": ', id, '}') AS record")
    monkeypatch.setattr(entry, "_json_records", lambda spark, sf_dir: records)
    folder = str(tmp_path / "objects")
    entry.write_object(spark, "", folder)
    files = [json.loads(p.read_text()) for p in (tmp_path / "objects").glob("part-*")]
    assert len(files) == 4 and all(list(f)[0] == "none" for f in files)
    assert sorted((int(k), v["n"]) for f in files for k, v in f.items() if k != "none") == [(i, i) for i in range(40)]
    assert read_entries(spark, folder).count() == 44
