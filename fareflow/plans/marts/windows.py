"""Bookings by booking window, fare bucket and flight date."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from fareflow.functions import bands, numbers
from fareflow.operators.joins import attach
from fareflow.plans.summaries import (
    daily_cells, fare_medians, flagged, summarise_bookings, with_distinct_counts, with_rates,
)

CELL = ["dtf_bucket", "fare_bucket"]


def booking_window_analysis(features: DataFrame, codes: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Volumes, rates and fares per booking window and fare bucket (a NULL bucket is kept)."""
    cells = with_distinct_counts(
        summarise_bookings(features, CELL), features, CELL, codes,
        unique_carriers="carrier_code", unique_routes="route")
    medians = fare_medians(
        features, CELL, median_fare=F.col("total_fare"), median_flagged_fare=flagged("total_fare"))
    full = with_rates(
        attach(cells, medians, CELL, match_nulls=True), {"pct_flagged": "flagged_bookings"}, None)
    return full.select(
        *CELL, "total_bookings", "flagged_bookings", "pct_flagged",
        "r1_flags", "r2_flags", "r3_flags",
        "avg_fare", "median_fare", "stddev_fare", "min_fare", "max_fare",
        "avg_flagged_fare", "median_flagged_fare",
        (F.col("avg_flagged_fare") - F.col("avg_normal_fare")).alias("avg_premium"),
        "unique_carriers", "unique_routes",
    )


def timeseries_metrics(features: DataFrame, daily: DataFrame) -> DataFrame:
    """Volumes, rates, fares and unclipped extra cost per flight date."""
    key = ["flight_date"]
    cost = daily_cells(features, daily).groupBy(*key).agg(
        F.sum("extra_cost").alias("daily_extra_cost"))
    medians = fare_medians(features, key, median_total_fare=F.col("total_fare"))
    days = attach(attach(summarise_bookings(features, key), medians, key), cost, key)
    return with_rates(days, {"pct_flagged": "flagged_bookings"}, None).select(
        "flight_date", "total_bookings", "flagged_bookings", "pct_flagged",
        F.col("avg_fare").alias("avg_total_fare"), "median_total_fare", "avg_flagged_fare",
        "r1_flags", "r2_flags", "r3_flags", "daily_extra_cost",
    )


def crosstab_summary(features: DataFrame, codes: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Booking window by fare bucket, with a row for every combination, empty ones included."""
    known = features.where(F.col("dtf_bucket").isNotNull() & F.col("fare_bucket").isNotNull())
    cells = with_distinct_counts(
        summarise_bookings(known, CELL), known, CELL, codes,
        unique_carriers="carrier_code", unique_routes="route", unique_flight_dates="flight_date")
    shares = (
        known.groupBy(*CELL, "carrier_code").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*CELL).agg(
            F.count("carrier_code").alias("competing_carriers"),
            F.max("n").alias("top_n"), F.sum("n").alias("all_n"))
    )
    medians = fare_medians(known, CELL, median_fare=F.col("total_fare"))
    rates = {
        "dtf_bucket_alert_rate": "flagged_bookings",
        "r1_rate": "r1_flags", "r2_rate": "r2_flags", "r3_rate": "r3_flags",
    }
    measured = with_rates(attach(attach(cells, medians, CELL), shares, CELL), rates)

    def with_zero(name):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    top_share = numbers.rounded(numbers.percent(F.col("top_n"), F.col("all_n")))
    premium = F.col("avg_flagged_fare") - F.col("avg_normal_fare")
    full = attach(_all_cells(features.sparkSession, cells), measured, CELL).select(
        *CELL,
        *[with_zero(c) for c in ["total_bookings", "flagged_bookings", *rates]],
        "avg_fare", "median_fare", "stddev_fare", "min_fare", "max_fare",
        "avg_flagged_fare", "avg_normal_fare",
        F.coalesce(premium, F.lit(0.0)).alias("avg_premium_amount"),
        *[with_zero(c) for c in
          ["unique_carriers", "unique_routes", "unique_flight_dates", "competing_carriers"]],
        F.coalesce(top_share, F.lit(0.0)).alias("top_carrier_share"),
    )
    return full.withColumns({
        "booking_window_category": bands.named(F.col("dtf_bucket"), bands.WINDOW_NAMES),
        "fare_category_display": bands.named(F.col("fare_bucket"), bands.FARE_BUCKET_NAMES),
        "dtf_sort_order": bands.rank_in(F.col("dtf_bucket"), bands.WINDOWS),
        "fare_sort_order": bands.rank_in(F.col("fare_bucket"), bands.FARE_BUCKETS),
        "alert_rate_category": bands.at_least(
            F.col("dtf_bucket_alert_rate"), bands.CELL_ALERTS, "Minimal Alert"),
        "volume_category": bands.at_least(
            F.col("total_bookings"), bands.CELL_VOLUMES, "Minimal Volume"),
        "premium_percentage": F.when(
            F.col("avg_normal_fare") > 0,
            numbers.rounded(numbers.percent(F.col("avg_premium_amount"), F.col("avg_normal_fare"))),
        ).otherwise(0.0),
        "is_dominated_cell": bands.indicator(F.col("top_carrier_share") >= 50),
        "is_low_competition": bands.indicator(F.col("competing_carriers") <= 2),
    })


def _all_cells(spark, cells: DataFrame) -> DataFrame:
    """Every window with every fixed or observed bucket, once.

    The windows are the four fixed labels and the buckets at most a handful, so this is an
    explode of two short lists rather than a join.
    """
    def labels(values):
        return F.explode(F.array(*[F.lit(v) for v in values]))

    fixed = spark.sql("SELECT 1").select(labels(bands.FARE_BUCKETS).alias("fare_bucket"))
    buckets = fixed.union(cells.select("fare_bucket")).distinct()
    return buckets.select(labels(bands.WINDOWS).alias("dtf_bucket"), "fare_bucket")
