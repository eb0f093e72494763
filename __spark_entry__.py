"""Entry points: a flagship query, all registered queries, and an independent SQL for each of them.

The queries run on the order tables seen as a game catalogue (`tagshelf.sources.star`) or on the given
tables directly. As in a real run, the catalogue is loaded, cleaned, checked and published once per
session and directory, and the queries read the published tables; the first query that needs a
snapshot pays for it. `bench.py` reports that time on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagshelf import fixed_values as fv
from tagshelf.functions import coerce, numeric, predicates
from tagshelf.operators import audit, clean, kpi, quality, shaping
from tagshelf.plans import pipeline
from tagshelf.sources import star
from tagshelf.sources.layout import having_all
from tagshelf.sources.publish import load_postings, load_tables, publish, write_layout
from tagshelf.sources.shared import dealt, new_folder, write_through
from tagshelf.sources.views import create_views, list_views
from tagshelf.tables import Tables

from tagshelf_oracle import SQL

try:
    import corpus_pipeline
    from tagshelf.llm import queries as corpus
except ModuleNotFoundError as e:  # the corpus operators are an optional part; a broken one is an error
    if e.name not in ("corpus_pipeline", "tagshelf.llm"):
        raise
    corpus = corpus_pipeline = None

AS_OF = "2026-01-01"
RULES = {
    "non_game_tags": star.STAR_NON_GAME_TAGS,
    "game_indicator_tags": star.STAR_GAME_INDICATOR_TAGS,
}
# The safety limit of the removal is there to make a person look; here the candidates are known.
MAX_ROWS = None
# Games with any of these tags are removed to see which tags remain.
REMOVED_TAGS = ["Brand#11", "Brand#21"]

_snapshots: dict[tuple[str, str, str], Tables] = {}


def _snapshot(spark: SparkSession, sf_dir: str, stage: str, make: Callable[[], Tables]) -> Tables:
    """Publish once, then resolve the current snapshot once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, stage)
    if key not in _snapshots:
        root = new_folder(spark, stage)
        publish(make(), root, validate=pipeline.validate)
        _snapshots[key] = load_tables(spark, root)
    return _snapshots[key]


def loaded(spark: SparkSession, sf_dir: str) -> Tables:
    """The catalogue as loaded."""
    return _snapshot(spark, sf_dir, "loaded", lambda: star.star_tables(spark, sf_dir))


def ready(spark: SparkSession, sf_dir: str) -> Tables:
    """The catalogue cleaned, without non-games, checked."""
    return _snapshot(
        spark, sf_dir, "ready",
        lambda: pipeline.clean_and_remove(loaded(spark, sf_dir), MAX_ROWS, assume_unique=True, **RULES),
    )


def on_loaded(f: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(loaded(spark, sf_dir))


def on_ready(f: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(ready(spark, sf_dir))


def _candidates(t: Tables) -> DataFrame:
    return clean.non_game_appids(t.games, t.game_tags, t.tags, **RULES)


# --- KPIs -----------------------------------------------------------------------------------------


def playtime_by_tag_top30(t: Tables) -> DataFrame:
    report = kpi.playtime_by_tag(
        t.games, t.game_tags, t.tags, top=fv.TOP_PLAYTIME_TAGS, style="report", assume_unique=True
    )
    return report.select("tag_name", "game_count", "avg_playtime_hrs", "median_playtime_hrs")


def playtime_achievement_top30(t: Tables) -> DataFrame:
    report = kpi.playtime_by_tag(
        t.games, t.game_tags, t.tags, top=fv.TOP_PLAYTIME_TAGS, style="report", assume_unique=True
    )
    return report.drop("median_playtime_hrs")


def view_read_back(t: Tables) -> DataFrame:
    """A KPI read from the view that was created for it."""
    spark = t.games.sparkSession
    create_views(t, as_of=AS_OF, assume_unique=True)
    names = [r["viewName"] for r in list_views(spark, "v_kpi_review*").collect()]
    return spark.table(names[0])


def label_quality_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review score measure on another pair of tables: labelled quality per document source."""
    documents = star.read(spark, sf_dir, "documents").select("doc_id", "source")
    rows = star.read(spark, sf_dir, "labels").filter(F.col("quality").isNotNull()).join(documents, "doc_id")
    counted = rows.groupBy("source").agg(F.expr("sum(bigint(quality)) AS good"), F.expr("count(*) AS n_labels"))
    return counted.selectExpr(
        "source", "n_labels",
        f"{numeric.rounded_ratio('good * 100', 'n_labels', 1)} AS good_pct",
        f"{numeric.rounded(numeric.wilson_lower_bound('good', 'n_labels'), 2)} AS wilson_score",
    )


# --- cleaning and integrity -----------------------------------------------------------------------


def null_prices(t: Tables) -> DataFrame:
    return clean.null_out_of_range(t.games, "price_usd").select("appid", "price_usd")


def parse_dates(t: Tables) -> DataFrame:
    return clean.parse_dates(t.games).select("appid", "release_date", "release_date_parsed")


def clean_games(t: Tables) -> DataFrame:
    return pipeline.clean_games(t.games).select(
        "appid", "name", "price_usd", "release_date_parsed", "average_playtime_forever"
    )


def removed_games(t: Tables) -> DataFrame:
    return clean.anti(pipeline.clean_games(t.games), _candidates(t), "appid").select("appid", "name")


def pruned_bridge(t: Tables) -> DataFrame:
    survivors = clean.anti(pipeline.clean_games(t.games), _candidates(t), "appid")
    return clean.prune_orphan_bridge(t.game_tags, survivors).select("appid", "tag_id", "votes")


def _without_parts(t: Tables) -> DataFrame:
    """The whole bridge of the games that have no part of two brands: then some tags are used no more, or less."""
    brands = t.tags.filter(F.col("tag_name").isin(REMOVED_TAGS)).select("tag_id")
    removed = clean.semi(t.game_tags, brands, "tag_id").select("appid").distinct()
    return clean.prune_orphan_bridge(t.game_tags, clean.anti(t.games, removed, "appid"))


def pruned_tags(t: Tables) -> DataFrame:
    """Tags that are still in use after a removal of games."""
    return clean.prune_orphan_tags(t.tags, _without_parts(t)).select("tag_id", "tag_name")


def recounted_tags(t: Tables) -> DataFrame:
    return clean.recount_tags(t.tags, _without_parts(t)).select("tag_id", "tag_name", "game_count")


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge rows as loaded against the games that are left after the removal."""
    return quality.check_fk(loaded(spark, sf_dir).game_tags, ready(spark, sf_dir).games, "appid")


def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = (star.read(spark, sf_dir, n) for n in ("orders", "lineitem"))
    return quality.check_fk(orders, lines, "o_orderkey", "l_orderkey").select("o_orderkey", "n_rows")


def cascade_delete(t: Tables) -> DataFrame:
    """Without the tags of part types their bridge rows are gone as well."""
    left = t.tags.filter(F.col("tag_name").startswith("Brand#"))
    return quality.cascade(left, t.game_tags, "tag_id").select("appid", "tag_id", "votes")


def layout_active_games(t: Tables) -> DataFrame:
    """Games written in release date order, read back by date range and activity."""
    spark = t.games.sparkSession
    folder = new_folder(spark, "by-date")
    write_layout(t.games, folder, ["release_date_parsed", "appid"])
    day = F.col("release_date_parsed")
    return spark.read.parquet(folder).filter(
        quality.is_active() & day.between(F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date"))
    ).select("appid", "release_date_parsed", "price_usd")


def non_game_guard(t: Tables) -> DataFrame:
    """How many games a removal would take, and whether the default guard would stop it."""
    counted = audit.non_game_count(_candidates(t)).toDF("n_candidates")
    return counted.select("n_candidates", (F.col("n_candidates") > fv.MAX_NON_GAME_ROWS).alias("stopped"))


def cleaned_tags(t: Tables) -> DataFrame:
    """Tags with their number of games after cleaning without a removal of non-games."""
    return pipeline.clean(t).tags.select("tag_id", "tag_name", "game_count")


def non_game_review(t: Tables) -> DataFrame:
    review = audit.non_game_review(t.games, t.game_tags, t.tags, **RULES)
    return review.withColumn("genres_and_tags", F.array_join("genres_and_tags", "|"))


# --- shaping --------------------------------------------------------------------------------------


def drop_junk(t: Tables) -> DataFrame:
    kept = shaping.drop_junk(t.games, "positive_reviews", "negative_reviews")
    return kept.select("appid", "name")


def drop_test_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test-word rule over whole texts."""
    documents = star.read(spark, sf_dir, "documents")
    return documents.filter(~shaping.is_test_name(F.col("text"))).groupBy("source").agg(
        F.count("*").alias("kept")
    )


def _tag_maps(t: Tables) -> DataFrame:
    """Games with their tags as a map; a game has each tag once, so the map is bounded by the tags."""
    named = dealt(t.game_tags, "appid").join(t.tags.select("tag_id", "tag_name"), "tag_id")
    entries = F.sort_array(F.collect_list(F.struct("tag_name", "votes")))
    return named.groupBy("appid").agg(F.map_from_entries(entries).alias("tags"))


def bridge_build(t: Tables) -> DataFrame:
    """From maps with padded names back to the bridge."""
    padded = _tag_maps(t).withColumn(
        "tags", F.transform_keys("tags", lambda k, _: F.concat(F.lit(" \t"), k, F.lit(" ")))
    )
    return shaping.lookup_tag_ids(shaping.build_bridge(padded), t.tags).select("appid", "tag_id", "votes")


def tag_dim(t: Tables) -> DataFrame:
    return shaping.build_tags(shaping.build_bridge(_tag_maps(t)))


def merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the part name and, in other spellings, again its words, its type and its brand."""
    words = F.split("p_name", " ")
    again = F.concat(F.transform(words, F.upper), F.array(F.lit("  "), F.concat(F.lit(" "), "p_type"), "p_brand"))
    merged = coerce.merge_genres_and_tags(words, again)
    return star.read(spark, sf_dir, "part").select("p_partkey", F.array_join(merged, "|").alias("merged"))


# --- JSON -----------------------------------------------------------------------------------------


def _props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.read(spark, sf_dir, "events")
    return events.select("event_id", "event_type", coerce.coerce_map(F.col("props")).alias("props"))


def json_has_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _props(spark, sf_dir)
    return events.groupBy("event_type").agg(
        F.count_if(predicates.json_has_key(F.col("props"), "k")).alias("with_k"),
        F.count_if(predicates.json_has_key(F.col("props"), "other")).alias("with_other"),
    )


def json_contains_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _props(spark, sf_dir)
    return events.filter(predicates.json_contains_object(F.col("props"), {"k": "42"})).select("event_id")


def json_contains_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = star.read(spark, sf_dir, "part").withColumn(
        "words", F.concat(F.split("p_name", " "), F.array("p_type"))
    )
    return parts.filter(predicates.json_contains_array(F.col("words"), ["red", "PROMO"])).select(
        "p_partkey", "p_name"
    )


def tag_votes_over(t: Tables) -> DataFrame:
    return audit.tag_votes_over(t.games, t.game_tags, t.tags, "PROMO", 100).select("appid", "name")


def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coercion rules over texts made from the event properties: numbers, decimals, junk, lists, maps."""
    k = F.regexp_extract("props", r"\d+", 0)
    n = k.cast("int")
    text = (
        F.when(n % 5 == 0, F.concat(k, F.lit(".7"))).when(n % 5 == 1, F.concat(F.lit(" -"), k, F.lit(".7 ")))
        .when(n % 5 == 2, F.concat(k, F.lit("d"))).when(n % 5 == 3, F.lit("free")).otherwise(k)
    )
    items = F.when(n % 2 == 0, F.concat(F.lit("["), k, F.lit(", \"x\"]"))).otherwise(F.col("props"))
    rows = star.read(spark, sf_dir, "events").select("event_id", text.alias("text"), items.alias("items"))
    keyed = coerce.coerce_key(rows.withColumn("key", F.col("text")), "key")
    return keyed.select(
        "event_id", "key",
        coerce.coerce_double(F.col("text")).alias("as_double"),
        coerce.coerce_long0(F.col("text")).alias("as_long"),
        F.array_join(coerce.coerce_array(F.col("items")), ",").alias("as_list"),
        F.size(coerce.coerce_map(F.col("items"))).alias("map_size"),
    )


def _json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as loosely typed JSON: prices and counts also as text, flags of every kind."""
    t = loaded(spark, sf_dir)
    games = t.games.join(_tag_maps(t), "appid", "left")
    number = lambda c: F.col(c).cast("string")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    every = lambda m, r=0: F.col("appid") % m == r
    price = (
        F.when(F.col("price_usd").isNull(), '"free"').when(every(3), quoted(number("price_usd")))
        .otherwise(number("price_usd"))
    )
    achievements = (
        F.when(every(4), quoted(F.concat(number("achievements"), F.lit(".7")))).when(every(4, 1), "null")
        .when(every(4, 2), F.concat(number("achievements"), F.lit(".2"))).otherwise(number("achievements"))
    )
    windows = F.when(every(3), "true").when(every(3, 1), "null").otherwise('"false"')
    linux = F.when(every(2), F.lit(', "linux": 0')).otherwise("")
    tags = F.when(F.col("tags").isNull(), "[]").otherwise(F.to_json("tags"))
    fields = {
        "name": quoted(F.col("name")), "release_date": quoted(F.col("release_date")), "price": price,
        "achievements": achievements, "positive": number("positive_reviews"),
        "negative": number("negative_reviews"),
        "average_playtime_forever": number("average_playtime_forever"),
        "median_playtime_forever": number("median_playtime_forever"), "peak_ccu": number("peak_ccu"),
        "windows": windows, "categories": F.lit('["Single", "brand#1 "]'),
        "developers": F.when(every(2), '["d", "e"]').otherwise('"d"'), "tags": tags,
    }
    body = F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), v) for k, v in fields.items()])
    return games.select("appid", F.concat(F.lit("{"), body, linux, F.lit("}")).alias("record"))


def _ingested(tables: Tables) -> DataFrame:
    per_game = tables.game_tags.groupBy("appid").agg(
        F.count("*").alias("n_tags"), F.sum("votes").alias("votes")
    )
    return tables.games.join(per_game, "appid", "left").select(
        "appid", "name", "price_usd", "achievements", "average_playtime_forever", "windows", "mac", "linux",
        F.size("developers").alias("n_developers"),
        F.array_join("genres_and_tags", "|").alias("merged"),
        F.coalesce("n_tags", F.lit(0).cast("bigint")).alias("n_tags"),
        F.coalesce("votes", F.lit(0).cast("bigint")).alias("votes"),
    )


def write_ndjson(spark: SparkSession, sf_dir: str, folder: str) -> int:
    """Write the catalogue as one JSON record per line; returns the number of records."""
    key = F.concat(F.lit('{"appid": "'), F.col("appid").cast("string"), F.lit('", '))
    _json_records(spark, sf_dir).select(F.concat(key, F.expr("substring(record, 2)"))).write.text(folder)
    return loaded(spark, sf_dir).games.count()


def ingest_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the catalogue as JSON lines, load it, and look at every game."""
    folder = new_folder(spark, "ndjson")
    write_ndjson(spark, sf_dir, folder)
    return _ingested(pipeline.load(spark, folder, "ndjson"))


def _as_object(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of a task as one JSON object, after an entry whose key is no number."""
    lines = lambda texts: pa.RecordBatch.from_arrays([texts], ["value"])
    yield lines(pa.array(['{"none": null']))
    for batch in batches:
        yield lines(batch.column(0))
    yield lines(pa.array(["}"]))


def write_object(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write the catalogue as files of one JSON object each, keyed by appid: as many as there are tasks, so that no task
    writes the whole of it. An appid has all its entries in one file."""
    text = F.concat(F.lit(', "'), F.col("appid").cast("string"), F.lit('": '), F.col("record"))
    entries = _json_records(spark, sf_dir).select(text.alias("value"))
    entries.mapInArrow(_as_object, "value string").write.text(folder)


def ingest_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files that are one JSON object each, keyed by appid."""
    folder = new_folder(spark, "object")
    write_object(spark, sf_dir, folder)
    return _ingested(pipeline.load(spark, folder, "object"))


def v_playtime_by_tag_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same view over a snapshot whose wide join needs no shuffle."""
    root = new_folder(spark, "bucketed")
    publish(ready(spark, sf_dir), root, buckets=8)
    t = load_tables(spark, root)
    return kpi.playtime_by_tag(t.games, t.game_tags, t.tags, assume_unique=True)


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table of the current snapshot, sums over its keys, and over a hash of all columns of each row."""
    t = ready(spark, sf_dir)
    cents = F.round(F.col("price_usd") * 100).cast("bigint").alias("price_usd")
    games = t.games.withColumns({"price_usd": cents, "genres_and_tags": F.array_join("genres_and_tags", "/")})
    parts = []
    for name, df, key in (("games", games, "appid"), ("tags", t.tags, "tag_id"), ("game_tags", t.game_tags, "appid")):
        columns = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(df.columns)]
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", *columns)), 1, 8), 16, 10).cast("bigint")
        parts.append(df.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.sum(key).alias("key_sum"), F.sum(digest).alias("digest")
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- layouts, statistics, whole runs --------------------------------------------------------------


def laid_out(spark: SparkSession, sf_dir: str) -> tuple[Tables, DataFrame]:
    """The catalogue in a snapshot that is laid out for filters, and the lists of games by genre."""
    key = (spark.sparkContext.applicationId, sf_dir, "laid-out")
    if key not in _snapshots:
        root = new_folder(spark, "laid-out")
        publish(ready(spark, sf_dir), root, layout=True)
        _snapshots[key] = load_tables(spark, root), load_postings(spark, root)
    return _snapshots[key]


def layout_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge rows of one tag, from the ranges that have it."""
    t, _ = laid_out(spark, sf_dir)
    tag_id = t.tags.filter(F.col("tag_name") == "PROMO").first()["tag_id"]
    return t.game_tags.filter(F.col("tag_id") == tag_id).select("appid", "votes")


def layout_filtered(condition: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: laid_out(spark, sf_dir)[0].games.filter(condition).select("appid", *columns)


def layout_by_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games whose list has two values, found through the lists of games by value."""
    t, lists = laid_out(spark, sf_dir)
    return having_all(t.games, lists, ["1-URGENT", "F"], "appid").select("appid", "price_usd")


def column_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls, different values, minimum and maximum of the columns of the current snapshot."""
    t = ready(spark, sf_dir)
    kept = quality.statistics(t).join(quality.exact_distinct(t).withColumnRenamed("n_distinct", "exact"), ["table_name", "column_name"])
    return kept.select("table_name", "column_name", "n_rows", "n_null", F.col("exact").alias("n_distinct"), "min_value", "max_value")


def kpi_rows(t: Tables) -> DataFrame:
    """The names of the views as they are listed, with the number of rows of each, all from one shared join."""
    spark = t.games.sparkSession
    found = pipeline.kpis(t, as_of=AS_OF, assume_unique=True, shared=True)
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    counted = [df.agg(F.lit(name).alias("view_name"), F.count("*").alias("n_rows")) for name, df in found.items()]
    return list_views(spark).withColumnRenamed("viewName", "view_name").join(reduce(DataFrame.unionByName, counted), "view_name")


def audit_rows(t: Tables) -> DataFrame:
    """The whole audit: the number of rows of each of its parts."""
    found = pipeline.audit(t, **RULES)
    counted = [df.agg(F.lit(name).alias("part"), F.count("*").alias("n_rows")) for name, df in found.items()]
    return reduce(DataFrame.unionByName, counted)


def bridge_checked(t: Tables) -> DataFrame:
    """The bridge, after the check that it is not empty."""
    maps = _tag_maps(t)
    bridge = shaping.require_non_empty(write_through(shaping.build_bridge(maps), "bridge"), maps)
    return shaping.lookup_tag_ids(bridge, t.tags).select("appid", "tag_id", "votes")


def entry(spark: SparkSession) -> DataFrame:
    """Playtime per tag on the smallest catalogue."""
    return queries()["v_playtime_by_tag"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries: of the catalogue, and those of the corpus operators where they are installed."""
    if corpus is None:
        return catalogue_queries()
    return catalogue_queries() | corpus.QUERIES | {"pipeline": corpus_pipeline.run}


def catalogue_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    unique = {"assume_unique": True}
    return {
        "playtime_by_tag_top30": on_ready(playtime_by_tag_top30),
        "playtime_achievement_top30": on_ready(playtime_achievement_top30),
        "v_playtime_by_tag": on_ready(lambda t: kpi.playtime_by_tag(t.games, t.game_tags, t.tags, **unique)),
        "releases_top15": on_ready(
            lambda t: kpi.releases_by_year_tag(t.games, t.game_tags, t.tags, as_of=AS_OF, top=fv.TOP_RELEASE_TAGS, **unique)
        ),
        "v_releases_by_year_tag": on_ready(
            lambda t: kpi.releases_by_year_tag(t.games, t.game_tags, t.tags, as_of=AS_OF, **unique)
        ),
        "price_brackets": on_ready(lambda t: kpi.playtime_by_price(t.games, style="report")),
        "v_playtime_by_price": on_ready(lambda t: kpi.playtime_by_price(t.games)),
        "f2p_summary": on_ready(lambda t: kpi.f2p_vs_paid_summary(t.games)),
        "f2p_top20": on_ready(lambda t: kpi.f2p_vs_paid(t.games, t.game_tags, t.tags, top=fv.TOP_MODEL_TAGS, **unique)),
        "v_f2p_vs_paid": on_ready(lambda t: kpi.f2p_vs_paid(t.games, t.game_tags, t.tags, **unique)),
        "review_scores_top30": on_ready(
            lambda t: kpi.review_scores_by_tag(t.games, t.game_tags, t.tags, top=fv.TOP_REVIEW_TAGS, **unique)
        ),
        "v_review_scores": on_ready(lambda t: kpi.review_scores_by_tag(t.games, t.game_tags, t.tags, **unique)),
        "v_playtime_by_tag_unchecked": on_ready(lambda t: kpi.playtime_by_tag(t.games, t.game_tags, t.tags)),
        "v_playtime_by_tag_bucketed": v_playtime_by_tag_bucketed,
        "view_read_back": on_ready(view_read_back),
        "label_quality_by_source": label_quality_by_source,
        "audit_summary": on_loaded(lambda t: audit.audit_summary(t.games)),
        "audit_price_range": on_loaded(lambda t: audit.audit_price_range(t.games)),
        "audit_date_values": on_loaded(lambda t: audit.top_values(t.games, "release_date")),
        "audit_unparsed_dates": on_loaded(
            lambda t: audit.top_values(t.games, "release_date", only_unparsed=True)
        ),
        "date_rejects": on_loaded(lambda t: clean.date_rejects(t.games)),
        "zero_engagement_count": on_loaded(lambda t: audit.zero_engagement_count(t.games)),
        "zero_engagement_sample": on_loaded(lambda t: audit.zero_engagement_sample(t.games)),
        "non_game_candidates": on_loaded(_candidates),
        "non_game_count": on_loaded(lambda t: audit.non_game_count(_candidates(t))),
        "non_game_guard": on_loaded(non_game_guard),
        "cleaned_tags": on_loaded(cleaned_tags),
        "non_game_review": on_loaded(non_game_review),
        "null_prices": on_loaded(null_prices),
        "parse_dates": on_loaded(parse_dates),
        "clean_games": on_loaded(clean_games),
        "removed_games": on_loaded(removed_games),
        "pruned_bridge": on_loaded(pruned_bridge),
        "pruned_tags": on_loaded(pruned_tags),
        "recounted_tags": on_loaded(recounted_tags),
        "ready_tags": on_ready(lambda t: t.tags),
        "pk_violations": lambda spark, sf_dir: quality.check_pk(
            star.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
        ),
        "fk_violations": fk_violations,
        "orders_without_lines": orders_without_lines,
        "cascade_delete": on_loaded(cascade_delete),
        "layout_active_games": on_ready(layout_active_games),
        "layout_by_tag": layout_by_tag,
        "layout_by_date": layout_filtered("release_date_parsed BETWEEN DATE '1997-03-01' AND DATE '1997-04-30'", "release_date_parsed"),
        "layout_by_price": layout_filtered("price_usd BETWEEN 20 AND 25", "price_usd"),
        "layout_by_playtime": layout_filtered("average_playtime_forever > 2000", "average_playtime_forever"),
        "layout_by_genres": layout_by_genres,
        "column_statistics": column_statistics,
        "kpi_rows": on_ready(kpi_rows),
        "audit_rows": on_loaded(audit_rows),
        "bridge_checked": on_loaded(bridge_checked),
        "f2p_summary_ordered": on_ready(lambda t: kpi.f2p_vs_paid_summary(t.games, ordered=True)),
        "drop_junk": on_loaded(drop_junk),
        "drop_test_documents": drop_test_documents,
        "bridge_build": on_loaded(bridge_build),
        "tag_dim": on_loaded(tag_dim),
        "merge_dedup": merge_dedup,
        "json_has_key": json_has_key,
        "json_contains_object": json_contains_object,
        "json_contains_array": json_contains_array,
        "tag_votes_over": on_loaded(tag_votes_over),
        "coerce_types": coerce_types,
        "ingest_ndjson": ingest_ndjson,
        "ingest_object": ingest_object,
        "publish_roundtrip": publish_roundtrip,
    }


def oracle_sql() -> dict[str, str]:
    if corpus is None:
        return dict(SQL)
    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return SQL | corpus.ORACLE_SQL | pipeline_sql
