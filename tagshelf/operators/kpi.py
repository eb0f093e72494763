"""The KPIs: playtime, releases, prices, price models and review scores.

Each function serves the unsorted, unlimited view (the default) and, with its `top` arguments, the
sorted report. KPIs per tag join games to the bridge on appid, aggregate by tag_id, and only then look
up the tag: the dimension meets one row per tag instead of the wide join, and a popular tag is
absorbed by the map-side combine. A KPI counts distinct games; once the keys are checked
(`quality.check_pk`) that is the number of rows, which `assume_unique=True` makes use of. Otherwise the distinct games
come out of the same pass as all other figures. Several KPIs in a row can share one join (`join_once`).

How the dimension is joined, the planner decides from the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagshelf import fixed_values as fv
from tagshelf.functions.numeric import (
    approval, approval_pct, average_hours, exact_ratio, hours, pearson, rounded, rounded_ratio, whole,
    wilson_lower_bound,
)
from tagshelf.operators.summary import summarise
from tagshelf.sources.shared import dealt, write_through

PLAYTIME = "average_playtime_forever"

AVG_HRS = f"{average_hours('total_minutes', 'n')} AS avg_playtime_hrs"
MEDIAN_HRS = f"{hours('median_minutes')} AS median_playtime_hrs"
APPROVAL = f"{approval('positive_reviews', 'negative_reviews')} AS approval"
AVG_APPROVAL = f"{approval_pct('total_approval', 'rated')} AS avg_approval_pct"


def played(games: DataFrame) -> DataFrame:
    return games.filter(f"{PLAYTIME} > 0")


def tagged(games: DataFrame, game_tags: DataFrame, assume_unique: bool = True, model: str | None = None) -> DataFrame:
    """One row per game and tag. No broadcast hint: both sides grow with the catalogue.

    Without `assume_unique` equal rows of a side are one row, and `_weight` tells how many pairs of rows it stands for;
    `_games` is 1 on one row for each game and tag, of each value of `model` if that is given, else 0, so that its sum
    counts distinct games. Both sides are dealt by appid once, for this as for the join.
    """
    pairs = game_tags.select("appid", "tag_id")
    if assume_unique:
        return games.join(pairs, "appid")
    rows = dealt(games, "appid").groupBy(*games.columns).agg(F.expr("count(*) AS _copies"))
    order = model or "_copies"
    place = f"row_number() OVER (PARTITION BY appid ORDER BY {order})"
    before = f"lag({order}) OVER (PARTITION BY appid ORDER BY {order})"
    first = f"CAST({place} = 1{f' OR NOT {order} <=> {before}' if model else ''} AS BIGINT) AS _games"
    pairs = dealt(pairs, "appid").groupBy("appid", "tag_id").agg(F.expr("count(*) AS _pairs_of"))
    return rows.selectExpr("*", first).join(pairs, "appid").selectExpr(
        *games.columns, "tag_id", "_games", "_copies * _pairs_of AS _weight"
    )


# What the KPIs per tag need of a game, besides its appid.
MEASURES = [PLAYTIME, "achievements", "price_usd", "positive_reviews", "negative_reviews", "release_date_parsed"]


def join_once(games: DataFrame, game_tags: DataFrame) -> DataFrame:
    """The wide join with the few columns that any KPI per tag needs, computed once into the shared folder: `joined` of
    the KPIs. Each then reads its own columns of it, and none reads the bridge. For tables whose keys are checked."""
    return write_through(tagged(games.select("appid", *MEASURES), game_tags).select("tag_id", *MEASURES), "joined")


def _rows(
    population: Callable[[DataFrame], DataFrame], columns: list[str], games: DataFrame, game_tags: DataFrame,
    assume_unique: bool, joined: DataFrame | None, model: str | None = None,
) -> DataFrame:
    """`columns` of the games of a population, one row per game and tag, from the shared join if there is one."""
    if joined is None:
        return tagged(population(games).selectExpr("appid", *columns), game_tags, assume_unique, model)
    if not assume_unique:
        raise ValueError("the shared join is for tables whose keys are checked")
    return population(joined).selectExpr("tag_id", *columns)


def top_tags(tags: DataFrame, k: int) -> DataFrame:
    """The k tags with most games, ties by name. A top-k without a global sort."""
    return tags.orderBy(F.expr("game_count").desc_nulls_first(), "tag_name").limit(k)


def _of_top_tags(game_tags: DataFrame | None, tags: DataFrame, k: int | None) -> DataFrame | None:
    if k is None or game_tags is None:
        return game_tags
    return game_tags.join(F.broadcast(top_tags(tags, k).select("tag_id")), "tag_id", "left_semi")


def _counted(totals: dict[str, tuple[str, str]], assume_unique: bool) -> dict:
    """The arguments of `summarise` that add `game_count`, the number of distinct games per group."""
    if assume_unique:
        return {"totals": totals}
    return {"totals": {**totals, "game_count": ("rows", "_games")}, "weight": "_weight"}


def _game_count(assume_unique: bool) -> str:
    return "n AS game_count" if assume_unique else "game_count"


def _named(per_tag: DataFrame, tags: DataFrame, *columns: str) -> DataFrame:
    return per_tag.join(tags.selectExpr("tag_id", "tag_name", *columns), "tag_id")


def model_of(price: str) -> str:
    """SQL for the price model; the caller leaves out missing prices, which would count as paid."""
    return f"CASE WHEN {price} = 0 THEN '{fv.FREE_MODEL}' ELSE '{fv.PAID_MODEL}' END"


def achievement_band(total: str, n: str, style: str = "view") -> str:
    """SQL for the band of the average total / n. It compares whole numbers, so no average is rounded
    into a band."""
    labels = fv.ACHIEVEMENT_BAND_LABELS[style]
    bands = "".join(
        f" WHEN {total} < {whole(n)} * {bound} THEN '{label}'"
        for bound, label in zip(fv.ACHIEVEMENT_BAND_BOUNDS, labels[1:])
    )
    return f"CASE WHEN {total} = 0 THEN '{labels[0]}'{bands} ELSE '{labels[-1]}' END"


def playtime_by_tag(
    games: DataFrame,
    game_tags: DataFrame,
    tags: DataFrame,
    min_games: int = fv.MIN_GAMES_PER_TAG,
    top: int | None = None,
    style: str = "view",
    assume_unique: bool = False,
    joined: DataFrame | None = None,
) -> DataFrame:
    """Playtime per tag, its correlation with the achievement count, and the achievement band."""
    columns = [PLAYTIME, "achievements"]
    rows = _rows(played, columns, games, game_tags, assume_unique, joined)
    totals = {
        "sum_y": ("whole", "achievements"),
        "min_x": ("min", PLAYTIME), "max_x": ("max", PLAYTIME),
        "min_y": ("min", "achievements"), "max_y": ("max", "achievements"),
    }
    stats = summarise(rows, ["tag_id"], PLAYTIME, pair=(PLAYTIME, "achievements"), **_counted(totals, assume_unique))
    correlation = pearson("sxx", "syy", "sxy", "min_x < max_x AND min_y < max_y")
    stats = stats.selectExpr(
        "tag_id", _game_count(assume_unique), AVG_HRS, MEDIAN_HRS,
        f"{rounded_ratio('sum_y', 'n', 0)} AS avg_achievements",
        f"{rounded(correlation, 3)} AS {fv.CORRELATION_COLUMN[style]}",
        f"{achievement_band('sum_y', 'n', style)} AS achievement_band",
    )
    counted = stats.filter(f"game_count >= {min_games}")
    result = _named(counted, tags).select(
        "tag_name", "game_count", "avg_playtime_hrs", "median_playtime_hrs", "avg_achievements",
        fv.CORRELATION_COLUMN[style], "achievement_band",
    )
    if top is None:
        return result
    return result.orderBy(F.expr("avg_playtime_hrs").desc_nulls_first(), "tag_name").limit(top)


def _dated(rows: DataFrame, since: str, today: str) -> DataFrame:
    day = "release_date_parsed"
    return rows.filter(f"{day} >= DATE '{since}' AND {day} < {today}").selectExpr("*", f"year({day}) AS release_year")


def releases_by_year_tag(
    games: DataFrame,
    game_tags: DataFrame,
    tags: DataFrame,
    since: str = fv.RELEASES_SINCE,
    as_of=None,
    top: int | None = None,
    assume_unique: bool = False,
    joined: DataFrame | None = None,
) -> DataFrame:
    """Releases per year and tag from `since` up to the day before `as_of` (today), with running totals.

    The running total is taken over the aggregated rows: one row per year in each window.
    """
    today = "current_date()" if as_of is None else f"DATE '{as_of}'"
    dated = _dated(games, since, today).select("appid", "release_year")
    if joined is None:
        rows = tagged(dated, _of_top_tags(game_tags, tags, top))
    else:
        rows = _of_top_tags(_dated(joined, since, today), tags, top)
    counted = "count(*)" if assume_unique else "count(DISTINCT appid)"
    yearly = rows.groupBy("tag_id", "release_year").agg(F.expr(f"{counted} AS games_released"))
    result = _named(yearly, tags, "game_count").selectExpr(
        "release_year", "tag_name", "game_count AS tag_total_game_count", "games_released",
        "sum(games_released) OVER (PARTITION BY tag_name ORDER BY release_year) AS cumulative_games",
    )
    if top is None:
        return result
    return result.drop("tag_total_game_count").orderBy("tag_name", "release_year")


def price_order(price: str) -> str:
    """SQL for the number of the price bracket."""
    cases = "".join(f" WHEN {price} < {bound} THEN {number}" for number, bound in fv.PRICE_BRACKET_BOUNDS)
    last = fv.PRICE_BRACKET_BOUNDS[-1][0] + 1
    return f"CASE WHEN {price} IS NULL THEN 0 WHEN {price} = 0 THEN 1{cases} ELSE {last} END"


def price_label(order: str, style: str = "view") -> str:
    """SQL for the label of a bracket number."""
    labels = ", ".join(f"'{label}'" for label in fv.PRICE_BRACKET_LABELS[style])
    return f"get(array({labels}), {order})"


def playtime_by_price(games: DataFrame, style: str = "view") -> DataFrame:
    """Playtime and review counts per price bracket; `style="report"` is sorted."""
    rows = played(games).selectExpr(
        f"{price_order('price_usd')} AS sort_order", PLAYTIME,
        "positive_reviews + negative_reviews AS reviews",
    )
    stats = summarise(rows, ["sort_order"], PLAYTIME, {"total_reviews": ("whole", "reviews")})
    result = stats.selectExpr(
        f"{price_label('sort_order', style)} AS price_bracket", "sort_order", "n AS game_count",
        AVG_HRS, MEDIAN_HRS, f"{rounded_ratio('total_reviews', 'n', 0)} AS avg_review_count",
    )
    return result.orderBy("sort_order") if style == "report" else result


def _priced(games: DataFrame) -> DataFrame:
    """Played games with a known price."""
    return played(games).filter("price_usd IS NOT NULL")


def f2p_vs_paid_summary(games: DataFrame, price_cap: float = fv.PRICE_MAX, ordered: bool = False) -> DataFrame:
    """Free against paid games. Hours per dollar is the ratio of the averages, NULL for free games."""
    rows = _priced(games).selectExpr(
        f"{model_of('price_usd')} AS model", PLAYTIME, "price_usd", "achievements", APPROVAL
    )
    stats = summarise(
        rows, ["model"], PLAYTIME,
        {
            "total_price": ("sum", "price_usd"), "total_achievements": ("whole", "achievements"),
            "total_approval": ("sum", "approval"), "rated": ("count", "approval"),
        },
    )
    avg_minutes = f"CAST({exact_ratio('total_minutes', 'n')} AS DOUBLE)"
    capped_price = f"nullif(least(total_price / n, {float(price_cap)}D), 0D)"
    result = stats.selectExpr(
        "model", "n AS game_count", f"{rounded('total_price / n', 2)} AS avg_price_usd", AVG_HRS, MEDIAN_HRS,
        f"{rounded(f'{avg_minutes} / {capped_price} / 60', 1)} AS playtime_hrs_per_dollar",
        f"{rounded_ratio('total_achievements', 'n', 1)} AS avg_achievements", AVG_APPROVAL,
    )
    return result.orderBy("model") if ordered else result


def f2p_vs_paid(
    games: DataFrame,
    game_tags: DataFrame,
    tags: DataFrame,
    min_games: int = fv.MIN_GAMES_PER_TAG_MODEL,
    top: int | None = None,
    assume_unique: bool = False,
    joined: DataFrame | None = None,
) -> DataFrame:
    """Free against paid games per tag. With `top` only the largest tags, sorted, in the report columns."""
    columns = [PLAYTIME, f"{model_of('price_usd')} AS model", APPROVAL]
    rows = _rows(_priced, columns, games, _of_top_tags(game_tags, tags, top), assume_unique, _of_top_tags(joined, tags, top), "model")
    keys = ["tag_id", "model"]
    totals = {"total_approval": ("sum", "approval"), "rated": ("count", "approval")}
    stats = summarise(rows, keys, PLAYTIME, **_counted(totals, assume_unique)).selectExpr(
        *keys, _game_count(assume_unique), AVG_HRS, MEDIAN_HRS, AVG_APPROVAL
    )
    counted = stats.filter(f"game_count >= {min_games}")
    result = _named(counted, tags, "game_count AS tag_total_game_count").select(
        "tag_name", "tag_total_game_count", "model", "game_count", "avg_playtime_hrs",
        "median_playtime_hrs", "avg_approval_pct",
    )
    if top is None:
        return result
    return result.drop("tag_total_game_count", "avg_approval_pct").orderBy("tag_name", "model")


def review_scores_by_tag(
    games: DataFrame,
    game_tags: DataFrame,
    tags: DataFrame,
    min_reviews: int = fv.MIN_REVIEWS_PER_GAME,
    min_games: int = fv.MIN_GAMES_PER_TAG,
    min_total_reviews: int = fv.MIN_REVIEWS_PER_TAG,
    z: float = fv.WILSON_Z,
    top: int | None = None,
    assume_unique: bool = False,
    joined: DataFrame | None = None,
) -> DataFrame:
    """Approval per tag: average over games, pooled over reviews, and the Wilson lower bound."""
    reviewed = lambda df: df.filter(f"positive_reviews + negative_reviews >= {min_reviews}")
    columns = ["positive_reviews AS positive", "positive_reviews + negative_reviews AS reviews", APPROVAL]
    rows = _rows(reviewed, columns, games, game_tags, assume_unique, joined)
    times = "" if assume_unique else " * _weight"
    aggregates = [
        "count(*) AS game_count" if assume_unique else "sum(_games) AS game_count",
        f"sum(positive{times}) AS total_positive", f"sum(reviews{times}) AS total_reviews",
        f"sum(approval{times}) AS total_approval",
        "count(approval) AS rated" if assume_unique else "sum(CASE WHEN approval IS NOT NULL THEN _weight END) AS rated",
    ]
    stats = rows.groupBy("tag_id").agg(*[F.expr(a) for a in aggregates])
    counted = stats.filter(f"game_count >= {min_games} AND total_reviews >= {min_total_reviews}")
    pooled = rounded_ratio(f"{whole('total_positive')} * 100", "total_reviews", 1)
    score = rounded(wilson_lower_bound("total_positive", "total_reviews", z), 2)
    result = _named(counted, tags).selectExpr(
        "tag_name", "game_count", "total_reviews", AVG_APPROVAL,
        f"{pooled} AS pooled_approval_pct", f"{score} AS wilson_score",
    )
    if top is None:
        return result
    return result.orderBy(F.expr("wilson_score").desc_nulls_first(), "tag_name").limit(top)
