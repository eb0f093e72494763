"""The KPI views: stored queries, evaluated when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagshelf.operators import kpi
from tagshelf.tables import Tables


def kpi_views(
    tables: Tables, as_of=None, assume_unique: bool = False, shared: bool = False
) -> dict[str, DataFrame]:
    """The six views as lazy DataFrames. `assume_unique` is for tables that have passed `pipeline.validate`.

    With `shared` (and `assume_unique`) the wide join is computed once, now, for the four views per tag: for whoever
    reads several of them. They then show the tables as they are now.
    """
    t, unique = tables, {"assume_unique": assume_unique}
    if shared:
        unique["joined"] = kpi.join_once(t.games, t.game_tags)
    return {
        "v_kpi_playtime_by_tag": kpi.playtime_by_tag(t.games, t.game_tags, t.tags, **unique),
        "v_kpi_releases_by_year_tag": kpi.releases_by_year_tag(
            t.games, t.game_tags, t.tags, as_of=as_of, **unique
        ),
        "v_kpi_playtime_by_price": kpi.playtime_by_price(t.games),
        "v_kpi_f2p_vs_paid": kpi.f2p_vs_paid(t.games, t.game_tags, t.tags, **unique),
        "v_kpi_f2p_vs_paid_summary": kpi.f2p_vs_paid_summary(t.games),
        "v_kpi_review_scores_by_tag": kpi.review_scores_by_tag(t.games, t.game_tags, t.tags, **unique),
    }


def create_views(tables: Tables, as_of=None, assume_unique: bool = False) -> list[str]:
    """Create or replace the six temporary views and return their names."""
    views = kpi_views(tables, as_of, assume_unique)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def list_views(spark: SparkSession, pattern: str = "v_kpi_*") -> DataFrame:
    """Names of the views that match, sorted."""
    return spark.sql(f"SHOW VIEWS LIKE '{pattern}'").select("viewName").orderBy("viewName")
