"""What the physical plans must and must not hold."""

import re

import pytest

import __spark_entry__ as entry
from tagshelf.operators import clean, kpi
from tagshelf.plans import pipeline
from tagshelf.sources.publish import load_tables, publish
from tagshelf.sources.shared import new_folder

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def operators(df):
    return re.findall(r"(\w*(?:Join|Exchange|Aggregate|Window|Python|Pandas|Arrow|CartesianProduct)\w*)", plan(df))


@pytest.fixture
def no_broadcast(spark):
    """What the planner does once a side is too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(entry.catalogue_queries()))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.catalogue_queries()[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|MapIn|FlatMapGroups|EvalPython", text)


def final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


def test_the_bridge_is_shuffled_once_for_both_passes(spark, no_broadcast):
    t = entry.ready(spark, SF_DIR)
    text = final_plan(kpi.playtime_by_tag(t.games, t.game_tags, t.tags, assume_unique=True))
    assert text.count("SortMergeJoin [appid") == 2
    # The games once per pass, as each needs other columns, the bridge a single time.
    assert len(re.findall(r"- Exchange hashpartitioning\(appid", text)) == 3
    assert len(re.findall(r"ReusedExchange \[appid", text)) == 1
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


@pytest.mark.parametrize("view", [kpi.playtime_by_tag, kpi.f2p_vs_paid, kpi.review_scores_by_tag])
def test_bucketed_join_shuffles_nothing(spark, no_broadcast, view):
    root = new_folder(spark, "bucketed-plan")
    publish(entry.ready(spark, SF_DIR), root, buckets=4)
    t = load_tables(spark, root)
    text = plan(view(t.games, t.game_tags, t.tags, assume_unique=True))
    assert "SortMergeJoin [appid" in text
    assert not re.search(r"Exchange hashpartitioning\(appid", text)


def test_filters_and_columns_reach_the_scan(spark):
    t = entry.ready(spark, SF_DIR)
    text = kpi.playtime_by_price(t.games)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThan(average_playtime_forever,0)" in text
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    columns = sorted(sorted(c.split(":")[0] for c in schema.split(",")) for schema in schemas)
    assert columns == [
        ["average_playtime_forever", "negative_reviews", "positive_reviews", "price_usd"],
        ["average_playtime_forever", "price_usd"],
    ]


def test_releases_window_runs_on_aggregated_rows(spark):
    t = entry.ready(spark, SF_DIR)
    found = operators(kpi.releases_by_year_tag(t.games, t.game_tags, t.tags, assume_unique=True))
    assert found.index("Window") < found.index("HashAggregate")


def test_top_k_is_no_global_sort(spark):
    t = entry.ready(spark, SF_DIR)
    text = plan(kpi.playtime_by_tag(t.games, t.game_tags, t.tags, top=30, assume_unique=True))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_distinct_games_need_no_join_of_their_own(spark, no_broadcast):
    t = entry.ready(spark, SF_DIR)
    for view in (kpi.playtime_by_tag, kpi.f2p_vs_paid):
        text = final_plan(view(t.games, t.game_tags, t.tags))
        assert text.count("SortMergeJoin [appid") == 2
        # Games and bridge once; the second pass reads the same exchanges.
        assert len(re.findall(r"- Exchange hashpartitioning\(appid", text)) == 2
        assert len(re.findall(r"ReusedExchange \[appid", text)) == 2
    text = final_plan(kpi.review_scores_by_tag(t.games, t.game_tags, t.tags))
    assert text.count("SortMergeJoin [appid") == 1


def test_six_views_read_the_bridge_once(spark, no_broadcast):
    t = entry.ready(spark, SF_DIR)
    views = pipeline.kpis(t, as_of=entry.AS_OF, assume_unique=True, shared=True)
    bridge = next(f for f in t.game_tags.inputFiles()).rsplit("/", 1)[0]
    for name, df in views.items():
        text = plan(df)
        assert "Join [appid" not in text and bridge not in text
    alone = pipeline.kpis(t, as_of=entry.AS_OF, assume_unique=True)
    for name, df in views.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, alone[name].collect()))


def test_candidates_need_one_shuffle_of_the_bridge(spark, no_broadcast):
    t = entry.loaded(spark, SF_DIR)
    text = plan(clean.non_game_appids(t.games, t.game_tags, t.tags, **entry.RULES))
    assert len(re.findall(r"Exchange hashpartitioning\(appid", text)) == 2
