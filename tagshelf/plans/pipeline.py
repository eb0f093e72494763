"""The runs: load, audit, clean, remove non-games, validate, KPIs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tagshelf import fixed_values as fv
from tagshelf.fixed_values import COUNTS, FLAGS
from tagshelf.functions.coerce import json_text
from tagshelf.operators import audit as audits
from tagshelf.operators import clean as cleaning
from tagshelf.operators import quality, shaping
from tagshelf.sources.publish import publish
from tagshelf.sources.records import read_games
from tagshelf.sources.shared import temporary_steps, write_through
from tagshelf.sources.views import kpi_views
from tagshelf.tables import GAME_COLUMNS, PRIMARY_KEYS, Tables

INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def load(
    spark: SparkSession, path, layout: str = "ndjson", absent_flag: bool = True, report: dict | None = None
) -> Tables:
    """Raw records to the three tables. Counts of what was dropped or softened go into `report`.

    The games are computed once; the bridge is made from the written games, the tags from the written
    bridge, so that the JSON text is parsed a single time.
    """
    raw = read_games(spark, path, layout)
    return load_records(raw, absent_flag, report)


def load_records(raw: DataFrame, absent_flag: bool = True, report: dict | None = None) -> Tables:
    typed = shaping.coerce_records(raw if report is None else _watch_raw(raw, report), absent_flag)
    typed = typed if report is None else _watch_typed(typed, report)
    games = write_through(shaping.shape_games(shaping.drop_junk(typed)), "games")
    bridge = write_through(shaping.build_bridge(games.select("appid", "record_ord", "tags").repartition("appid")), "bridge")
    shaping.require_non_empty(bridge, games.select("tags"))
    tags = write_through(shaping.build_tags(bridge), "tags")
    if report is not None:
        for watch in (report.pop("_raw"), report.pop("_typed")):
            report.update(watch.get)
    return Tables(games.select(*GAME_COLUMNS), tags, shaping.lookup_tag_ids(bridge, tags))


def _watch_raw(raw: DataFrame, report: dict) -> DataFrame:
    """Count records, absent flags and infinite counts while the records pass by."""
    report["_raw"] = Observation()
    infinite = [F.count_if(json_text(F.col(c)).rlike(INFINITE)) for c in COUNTS]
    return raw.observe(
        report["_raw"],
        F.count("*").alias("records"),
        *[F.count_if(F.col(c).isNull()).alias(f"absent_{c}") for c in FLAGS],
        sum(infinite[1:], infinite[0]).alias("infinite_counts"),
    )


def _watch_typed(typed: DataFrame, report: dict) -> DataFrame:
    """Count what the junk rules will drop; an entry may fall under several of them."""
    report["_typed"] = Observation()
    return typed.observe(
        report["_typed"],
        F.count("*").alias("with_appid"),
        F.count_if(F.col("name").isNull()).alias("null_names"),
        F.count_if(shaping.is_test_name(F.col("name"))).alias("test_names"),
        F.count_if(shaping.is_zero_signal()).alias("zero_signal"),
    )


def audit(tables: Tables, **rules) -> dict[str, DataFrame]:
    """The whole profile, as DataFrames by name. Nothing is changed.

    The candidates are computed once, for their count and their review.
    """
    games, tags, game_tags = tables
    candidates = write_through(cleaning.non_game_appids(games, game_tags, tags, **rules), "non_games")
    return {
        "audit_summary": audits.audit_summary(games),
        "audit_price_range": audits.audit_price_range(games),
        "audit_date_values": audits.top_values(games, "release_date"),
        "zero_engagement_count": audits.zero_engagement_count(games),
        "zero_engagement_sample": audits.zero_engagement_sample(games),
        "non_game_candidates": candidates,
        "non_game_count": audits.non_game_count(candidates),
        "non_game_review": audits.non_game_review(games, game_tags, tags, candidates),
    }


def clean_games(games: DataFrame) -> DataFrame:
    """Prices in range, dates parsed, dead entries gone: narrow steps in one pass."""
    priced = cleaning.null_out_of_range(games, "price_usd")
    return cleaning.drop_zero_engagement(cleaning.parse_dates(priced))


def clean(tables: Tables, assume_unique: bool = False, report: dict | None = None) -> Tables:
    """Clean the games, and bring bridge and tags in line, whether non-games are removed later or not."""
    cleaned = tables._replace(games=clean_games(tables.games))
    _count_clean(cleaned, report)
    return _in_line(cleaned, assume_unique)


def remove_non_games(
    tables: Tables, max_rows: int | None = fv.MAX_NON_GAME_ROWS, assume_unique: bool = False, report: dict | None = None,
    **rules,
) -> Tables:
    """Remove the non-game candidates everywhere, unless there are more than `max_rows` of them (None: no limit). Their
    number goes into `report`.

    The candidates are computed once. Their written size tells the planner whether to broadcast them.
    """
    candidates = write_through(
        cleaning.non_game_appids(tables.games, tables.game_tags, tables.tags, **rules), "non_games"
    )
    n = cleaning.guard_max_rows(candidates, max_rows)
    if report is not None:
        report["non_game_rows"] = n
    return _in_line(tables._replace(games=cleaning.anti(tables.games, candidates, "appid")), assume_unique)


def clean_and_remove(
    tables: Tables, max_rows: int | None = fv.MAX_NON_GAME_ROWS, assume_unique: bool = False, report: dict | None = None,
    **rules,
) -> Tables:
    """`clean` and `remove_non_games` in one: a verdict on a game needs only its own bridge rows, so
    the bridge is brought in line once, at the end."""
    cleaned = tables._replace(games=clean_games(tables.games))
    _count_clean(cleaned, report)
    return remove_non_games(cleaned, max_rows, assume_unique, report, **rules)


def _count_clean(cleaned: Tables, report: dict | None) -> None:
    """The rows that are left after cleaning, before any removal, go into `report`: a pass over the few columns that decide."""
    if report is not None:
        report["clean_rows"] = cleaned.games.count()


def _in_line(tables: Tables, assume_unique: bool) -> Tables:
    """Bridge rows of the games that are there, tags in use with their number of games.

    This is also what removes the bridge rows of deleted games. The bridge is written once, as the
    tags are counted on it.
    """
    pruned = write_through(cleaning.prune_orphan_bridge(tables.game_tags, tables.games), "game_tags")
    return Tables(tables.games, cleaning.refresh_tags(tables.tags, pruned, assume_unique), pruned)


def violations(tables: Tables) -> dict[str, DataFrame]:
    """The integrity checks; each DataFrame is empty if all is well.

    Besides the keys, tag names must be unique: a KPI per tag is one per tag_id.
    """
    found = {
        f"primary key of {name}": quality.check_pk(getattr(tables, name), columns)
        for name, columns in PRIMARY_KEYS.items()
    }
    found["tags.tag_name"] = quality.check_pk(tables.tags, ["tag_name"])
    found["game_tags.appid"] = quality.check_fk(tables.game_tags, tables.games, "appid")
    found["game_tags.tag_id"] = quality.check_fk(tables.game_tags, tables.tags, "tag_id")
    return found


def validate(tables: Tables) -> Tables:
    """Fail with the first five violations, by key, of every check that does not hold. All checks are one job."""
    checks = {what: (df, [c for c in df.columns if c != "n_rows"]) for what, df in violations(tables).items()}
    found = {r["what"]: [json.loads(text) for text in r["violations"]] for r in quality.first_violations(checks).collect()}
    if found:
        raise ValueError("; ".join(f"{what}: {found[what]}" for what in checks if what in found))
    return tables


def kpis(tables: Tables, as_of=None, assume_unique: bool = False, shared: bool = False) -> dict[str, DataFrame]:
    """The six KPIs; `shared` reads the bridge once for all of them (see `kpi_views`)."""
    return kpi_views(tables, as_of, assume_unique, shared)


def refresh(
    spark: SparkSession,
    path,
    root: str,
    layout: str = "ndjson",
    remove: bool = True,
    max_rows: int | None = fv.MAX_NON_GAME_ROWS,
    buckets: int | None = None,
    report: dict | None = None,
    clustered: bool = False,
    analyze: bool = False,
) -> str:
    """A full reload: load, clean, optionally remove non-games, check and publish. Returns the run id.

    Everything that was written on the way is gone when the run ends or fails; what is published stays. `report` gets
    what was dropped or softened while loading, `clean_rows` after cleaning, `non_game_rows` that were removed, and
    `published_games`, `published_tags` and `published_game_tags`. The loader makes each (appid, tag) once, so games per
    tag are counted as rows. `clustered` and `analyze` are `layout` and `analyze` of `publish`.
    """
    with temporary_steps(spark, "refresh"):
        tables = load(spark, path, layout, report=report)
        tables = clean_and_remove(tables, max_rows, True, report) if remove else clean(tables, True, report)
        return publish(tables, root, validate=validate, buckets=buckets, layout=clustered, analyze=analyze, report=report)
