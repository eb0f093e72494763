"""Count, exact average and exact median per group, without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagshelf.functions.numeric import whole

# Buckets per doubling of the value, as a power of two.
BUCKET_BITS = 3


def bucket_of(value: str) -> str:
    """SQL for the bucket of a whole number, in the order of the numbers, eight to each doubling.

    Any positive bigint falls into one of 488 buckets, and a bucket is never wider than an eighth of its
    values. Should log2 round up just below a power of two, the bucket number is still the same.
    """
    shift = f"CAST(greatest(floor(log2({value})) - {BUCKET_BITS}, 0) AS INT)"
    return f"({shift} * {1 << BUCKET_BITS} + shiftright({value}, {shift}))"


def _first(name: str, how: str, value: str) -> str:
    """Aggregate over rows. A `whole` total is summed as a decimal that holds any bigint: exact at any size."""
    if how == "whole":
        return f"sum(CAST({value} AS DECIMAL(20,0))) AS {name}"
    return f"{'sum' if how == 'rows' else how}({value}) AS {name}"


def _weighted(name: str, how: str, weight: str) -> str:
    """A first aggregate over rows of one weight, each counted so many times."""
    if how in ("min", "max", "rows"):
        return name
    return f"{name} * CAST({weight} AS DECIMAL(18,0)) AS {name}" if how == "whole" else f"{name} * {weight} AS {name}"


def _moments(pair: tuple[str, str]) -> list[str]:
    """Aggregates over rows: how many pairs there are, their means, and squares and products about the means."""
    x, y = (f"CAST({v} AS DOUBLE)" for v in pair)
    return [
        f"regr_count({y}, {x}) AS _pairs", f"regr_avgx({y}, {x}) AS _mx", f"regr_avgy({y}, {x}) AS _my",
        f"regr_sxx({y}, {x}) AS _sxx", f"regr_syy({y}, {x}) AS _syy", f"regr_sxy({y}, {x}) AS _sxy",
    ]


# The same over the buckets of a group: what is about the buckets' means, and these about the group's mean. No two
# large numbers are ever subtracted, whatever the size of the values.
_MERGED_MOMENTS = [
    "sum(_sxx + _pairs * (_mx - _gx) * (_mx - _gx)) AS sxx",
    "sum(_syy + _pairs * (_my - _gy) * (_my - _gy)) AS syy",
    "sum(_sxy + _pairs * (_mx - _gx) * (_my - _gy)) AS sxy",
]


def _merged(name: str, how: str) -> str:
    """The same aggregate over the buckets of a group; a `whole` total is added up as a decimal."""
    if how == "whole":
        return f"sum({whole(name)}) AS {name}"
    return f"{'sum' if how in ('count', 'rows') else how}({name}) AS {name}"


def summarise(
    rows: DataFrame,
    keys: list[str],
    minutes: str,
    totals: dict[str, tuple[str, str]] | None = None,
    pair: tuple[str, str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row per group: `n`, `total_minutes`, `median_minutes`, and `totals`, given by name as a pair of
    "whole" (a sum of whole numbers), "sum", "rows", "min", "max" or "count" and the SQL it is taken of. With a `pair`
    of numbers also `sxx`, `syy` and `sxy`, their sums of squares and products about the means.

    The median is found in two passes. The first counts rows per (group, bucket): it combines on the
    map side to at most 488 rows per group, carries all the sums, and tells in which one or two buckets
    the middle rows are. The second counts single values, only in those buckets. So however many rows
    and different values a group holds, no task gets more of it than 488 rows and the different minutes
    of two buckets; the built-in exact percentile would hold a map of all its values in one task.

    The rows are needed twice. Where they come from a shuffle join, the exchange of the large side is
    planned once and reused; bucketed tables need none.

    With a `weight`, a column of whole numbers, a row counts so many times, but in a "rows" total, which adds up its
    value as it is. The first pass then has a row for each weight of a bucket: rows of one weight have the moments of
    single rows, so many times over. The planner decides how the second pass looks up the groups' middle buckets.
    """
    totals = {"total_minutes": ("whole", minutes), **(totals or {})}
    by_key = f"PARTITION BY {', '.join(keys)}"
    rows = rows.selectExpr("*", f"{bucket_of(minutes)} AS _bucket")

    weights = [weight] if weight else []
    buckets = rows.groupBy(*keys, "_bucket", *weights).agg(
        F.expr("count(*) AS _n"),
        *[F.expr(_first(name, how, value)) for name, (how, value) in totals.items()],
        *[F.expr(x) for x in (_moments(pair) if pair else [])],
    )
    if weight:
        buckets = buckets.selectExpr(
            *keys, "_bucket", f"_n * {weight} AS _n", *[_weighted(name, how, weight) for name, (how, _) in totals.items()],
            *([f"{x} * {weight} AS {x}" for x in ("_pairs", "_sxx", "_syy", "_sxy")] + ["_mx", "_my"] if pair else []),
        )
    means = [f"sum(_pairs * _m{v}) OVER ({by_key}) / nullif(sum(_pairs) OVER ({by_key}), 0) AS _g{v}" for v in "xy"]
    ranked = buckets.selectExpr(
        "*",
        f"sum(_n) OVER ({by_key} ORDER BY _bucket RANGE UNBOUNDED PRECEDING) AS _upto",
        f"coalesce(sum(_n) OVER ({by_key} ORDER BY _bucket RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _below",
        f"sum(_n) OVER ({by_key}) AS _all",
        *(means if pair else []),
    )
    # The two middle rows are those at the zero-based places (all - 1) div 2 and all div 2.
    groups = ranked.groupBy(*keys).agg(
        F.expr("min(CASE WHEN _upto > (_all - 1) div 2 THEN _bucket END) AS _lower"),
        F.expr("min(CASE WHEN _upto > _all div 2 THEN _bucket END) AS _upper"),
        F.expr("min(CASE WHEN _upto > (_all - 1) div 2 THEN _below END) AS _before"),
        F.expr("sum(_n) AS n"),
        *[F.expr(_merged(name, how)) for name, (how, _) in totals.items()],
        *[F.expr(x) for x in (_MERGED_MOMENTS if pair else [])],
    )
    carried_names = [*totals, *(["sxx", "syy", "sxy"] if pair else [])]
    # The sums travel along as one column, so that the first pass is planned and run only once.
    carried = f"struct(n, _before, {', '.join(carried_names)}) AS _group"
    middle = groups.selectExpr(*keys, "_lower", "_upper", carried)

    values = (
        rows.select(*keys, minutes, "_bucket", *weights)
        .join(middle, keys)
        .filter("_bucket = _lower OR _bucket = _upper")
        .groupBy(*keys, "_group", minutes)
        .agg(F.expr(f"sum({weight}) AS _n" if weight else "count(*) AS _n"))
    )
    # The middle buckets are neighbours among the filled ones, so one running count serves both.
    so_far = f"sum(_n) OVER ({by_key} ORDER BY {minutes} ROWS UNBOUNDED PRECEDING)"
    values = values.selectExpr(*keys, "_group", minutes, f"_group._before + {so_far} AS _upto")
    lower = f"min(CASE WHEN _upto > (_group.n - 1) div 2 THEN {minutes} END)"
    upper = f"min(CASE WHEN _upto > _group.n div 2 THEN {minutes} END)"
    # Same partitioning as the window: no further shuffle.
    medians = values.groupBy(*keys, "_group").agg(
        F.expr(f"(CAST({lower} AS DOUBLE) + CAST({upper} AS DOUBLE)) / 2 AS median_minutes")
    )
    return medians.selectExpr(*keys, "_group.n", *[f"_group.{name}" for name in carried_names], "median_minutes")
