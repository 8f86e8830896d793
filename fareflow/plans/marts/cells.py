"""Carrier and route cells, the shared grain of the two performance marts.

The marts can be asked for the figures of a many-to-many join in which every booking of a cell
meets every booking of that cell. Those rows are never made: in a cell of n bookings each booking
appears n times, so sums are multiplied by n and a percentile takes n as a frequency.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.functions import numbers
from fareflow.operators.joins import attach
from fareflow.plans.summaries import daily_cells, fare_medians

CELL = ["route", "carrier_code"]
COUNTS = ["total_bookings", "flagged_bookings", "r1_flags", "r2_flags", "r3_flags"]
SUMS = ["fare_sum", "flagged_fare_sum", "miles_sum", "miles_count"]


def carrier_route_cells(features: DataFrame, daily: DataFrame, pairwise: bool) -> DataFrame:
    """Sums per route and carrier, with ``times``, how often each booking counts.

    For the joined figures a flagged booking is compared with each median of its cell: k medians
    that add up to m give k * fare - m.
    """
    days = daily_cells(features, daily)
    has_median = F.col("median_fare").isNotNull()
    cells = days.groupBy(*CELL).agg(
        *[F.sum(c).alias(c) for c in COUNTS + SUMS],
        F.max("hhi").alias("hhi"),
        F.max("carrier_count").alias("carrier_count"),
        F.sum("extra_cost").alias("own_extra_cost"),
        F.coalesce(F.sum(F.when(has_median, F.col("total_bookings"))), F.lit(0)).alias("k"),
        F.coalesce(F.sum(F.col("total_bookings") * F.col("median_fare")), F.lit(0.0)).alias("m"),
    )
    if not pairwise:
        return cells.withColumns({"times": F.lit(1), "total_extra_cost": F.col("own_extra_cost")})
    joins = F.col("route").isNotNull() & F.col("carrier_code").isNotNull()
    over = F.col("flagged_fare_sum") * F.col("k") - F.col("flagged_bookings") * F.col("m")
    return cells.withColumns({
        "times": F.when(joins, F.col("total_bookings")).otherwise(1),
        "total_extra_cost": F.when(joins, over).otherwise(0.0),
    })


def roll_up(cells: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Cells summed to routes or carriers, with the averages derived from the sums."""
    weighted = [F.sum(F.col(c) * F.col("times")).alias(c) for c in COUNTS + SUMS]
    sums = cells.groupBy(*keys).agg(
        *weighted, F.sum("total_extra_cost").alias("total_extra_cost"), *more)
    return sums.withColumns({
        "avg_fare": numbers.ratio(F.col("fare_sum"), F.col("total_bookings")),
        "avg_flagged_fare": numbers.ratio(F.col("flagged_fare_sum"), F.col("flagged_bookings")),
        "avg_distance_miles": numbers.ratio(F.col("miles_sum"), F.col("miles_count")),
    })


def pairwise_medians(features: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Median fare with each booking counted as often as its cell says."""
    fares = features.groupBy(*CELL, "total_fare").agg(F.count(F.lit(1)).alias("n"))
    counted = attach(fares, cells.select(*CELL, "times"), CELL, match_nulls=True)
    return fare_medians(
        counted, keys, weight=F.col("n") * F.col("times"), median_fare=F.col("total_fare"))
