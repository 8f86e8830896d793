"""Measures the marts share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.functions import numbers
from fareflow.operators.distinct import dense_codes, distinct_counts
from fareflow.operators.joins import attach
from fareflow.operators.quantiles import exact_percentiles
from fareflow.plans.intermediate import DAILY_KEYS


def flagged(name: str) -> Column:
    """The column on flagged bookings, NULL on others."""
    return F.when(F.col("any_rule_flag") == 1, F.col(name))


BOOKING_MEASURES = [
    "count(1) AS total_bookings",
    "sum(any_rule_flag) AS flagged_bookings",
    "sum(r1_price_outlier) AS r1_flags",
    "sum(r2_seat_scarcity) AS r2_flags",
    "sum(r3_monopoly_premium) AS r3_flags",
    "sum(total_fare) AS fare_sum",
    "avg(total_fare) AS avg_fare",
    "stddev(total_fare) AS stddev_fare",
    "min(total_fare) AS min_fare",
    "max(total_fare) AS max_fare",
    "coalesce(sum(total_fare) FILTER (WHERE any_rule_flag = 1), 0D) AS flagged_fare_sum",
    "avg(total_fare) FILTER (WHERE any_rule_flag = 1) AS avg_flagged_fare",
    "avg(total_fare) FILTER (WHERE any_rule_flag = 0) AS avg_normal_fare",
]


def summarise_bookings(features: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Counts, flag counts and fare statistics per key; unused ones are pruned by Catalyst.

    All but the distinct counts a caller may add combine before the shuffle, so a hot key
    costs one row per task.
    """
    return features.groupBy(*keys).agg(*map(F.expr, BOOKING_MEASURES), *more)


def with_distinct_counts(
    cells: DataFrame, features: DataFrame, keys: Sequence[str], codes: Mapping[str, DataFrame] | None,
    **counted: str,
) -> DataFrame:
    """``cells`` (unique on ``keys``) with distinct counts of columns of their bookings, 0 where there is no value.

    ``codes`` has the stored numbers of the columns' values; those it lacks are made here.
    """
    codes = dict(codes or {})
    for column in counted.values():
        if column not in codes:
            codes[column] = dense_codes(features, column)
    found = distinct_counts(features, keys, counted, codes)
    return attach(cells, found, keys, match_nulls=True).withColumns({
        name: F.coalesce(F.col(name), F.lit(0)) for name in counted})


def fare_medians(
    features: DataFrame, keys: Sequence[str], weight: Column | None = None, **measures: Column
) -> DataFrame:
    """Exact medians of fare columns per key.

    Where staging has left no decimals, the distinct values of any key are bounded by the dearest fare, and no group
    has to be bounded first.
    """
    whole = features.schema["total_fare"].metadata.get("decimals") == 0
    return exact_percentiles(
        features, keys, {name: (c, 0.5) for name, c in measures.items()}, weight,
        **({"wide_group": None} if whole else {}))


def with_rates(df: DataFrame, names: dict[str, str], digits: int | None = 2) -> DataFrame:
    """Add ``100 * count / total_bookings`` columns, rounded unless ``digits`` is None."""
    def rate(count: str) -> Column:
        share = numbers.percent(F.col(count), F.col("total_bookings"))
        return share if digits is None else numbers.rounded(share, digits)

    return df.withColumns({name: rate(count) for name, count in names.items()})


def route_ends() -> dict[str, Column]:
    """Origin and destination read from the route key."""
    return {
        "origin": F.split_part("route", F.lit("-"), F.lit(1)),
        "destination": F.split_part("route", F.lit("-"), F.lit(2)),
    }


def daily_cells(features: DataFrame, daily: DataFrame) -> DataFrame:
    """Bookings summed per route, carrier, window and flight date, with the cell's median fare.

    The sum of (fare - median) over a cell's flagged bookings is their fare sum less
    their number times the median. So bookings are summed first and two tables that are unique
    on the key are joined; no booking takes part in that join, and a hot key is one row.
    """
    cells = summarise_bookings(
        features, DAILY_KEYS,
        F.sum("trip_dist").alias("miles_sum"),
        F.count("trip_dist").alias("miles_count"),
        F.max("hhi").alias("hhi"),
        F.max("carrier_count").alias("carrier_count"),
    )
    priced = attach(cells, daily.select(*DAILY_KEYS, "median_fare"), DAILY_KEYS)
    over = F.col("flagged_fare_sum") - F.col("flagged_bookings") * F.col("median_fare")
    return priced.withColumn("extra_cost", F.coalesce(over, F.lit(0.0)))
