"""Bookings by carrier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from fareflow.functions import bands, numbers
from fareflow.operators.joins import attach
from fareflow.params import FareParams
from fareflow.plans.intermediate import dim_carrier
from fareflow.plans.marts.cells import carrier_route_cells, pairwise_medians, roll_up
from fareflow.plans.summaries import (
    fare_medians, summarise_bookings, with_distinct_counts, with_rates,
)

CARRIER = ["carrier_code"]
ROUTE_WINDOW = ["carrier_code", "route", "dtf_bucket"]


def carrier_performance(
    features: DataFrame, daily: DataFrame, carriers: DataFrame, params: FareParams = FareParams(),
    pairwise: bool = False,
) -> DataFrame:
    """Volumes, rates, prices and monopoly routes of the listed carriers.

    ``pairwise`` gives the figures of a many-to-many join of bookings on carrier and route, in
    which ``monopoly_routes_count`` counts rows; otherwise it counts routes.
    """
    listed = features.join(
        F.broadcast(carriers.select(F.col("code").alias("carrier_code"))), "carrier_code",
        "left_semi")
    cells = carrier_route_cells(listed, daily, pairwise)
    monopoly = F.col("route").isNotNull() & (F.col("hhi") >= params.hhi_threshold)
    counted = F.col("total_bookings") * F.col("times") if pairwise else F.lit(1).cast("bigint")
    totals = roll_up(
        cells, CARRIER,
        F.count("route").alias("routes_served"),
        F.sum(F.when(monopoly, counted).otherwise(0)).alias("monopoly_routes_count"),
    )
    medians = (
        pairwise_medians(listed, cells, CARRIER) if pairwise
        else fare_medians(listed, CARRIER, median_fare=F.col("total_fare")))
    rates = {
        "pct_flagged": "flagged_bookings", "pct_r1_outliers": "r1_flags",
        "pct_r2_scarcity": "r2_flags", "pct_r3_monopoly": "r3_flags",
    }
    rated = with_rates(attach(totals, medians, CARRIER), rates, None)
    return rated.join(F.broadcast(dim_carrier(carriers)), "carrier_code").select(
        "carrier_code", "carrier_name", "total_bookings", "flagged_bookings", "pct_flagged",
        F.col("r1_flags").alias("r1_price_outlier_count"),
        F.col("r2_flags").alias("r2_seat_scarcity_count"),
        F.col("r3_flags").alias("r3_monopoly_premium_count"),
        "pct_r1_outliers", "pct_r2_scarcity", "pct_r3_monopoly",
        "avg_fare", "median_fare", "avg_flagged_fare", "total_extra_cost", "routes_served",
        "monopoly_routes_count")


def _route_window_costs(features: DataFrame) -> DataFrame:
    """Per carrier: excess of flagged fares over the median of their route and window.

    Sums per cell and medians per cell meet one to one; a cell with a NULL key has no median.
    """
    cells = summarise_bookings(features, ROUTE_WINDOW)
    medians = fare_medians(features, ROUTE_WINDOW, route_median_fare=F.col("total_fare"))
    joined = attach(cells, medians, ROUTE_WINDOW)
    known = F.col("route_median_fare").isNotNull()
    over = F.col("flagged_fare_sum") - F.col("flagged_bookings") * F.col("route_median_fare")
    return joined.groupBy(*CARRIER).agg(
        F.coalesce(F.sum(over), F.lit(0.0)).alias("total_extra_cost"),
        F.coalesce(
            numbers.ratio(F.sum(over), F.sum(F.when(known, F.col("flagged_bookings")))), F.lit(0.0),
        ).alias("avg_extra_cost_per_violation"),
    )


def carrier_summary(
    features: DataFrame, carriers: DataFrame, codes: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Every carrier, listed or not, with rates, shares, ranks and categories."""
    bucket_counts = []
    for short, bucket in zip(("prem", "full", "disc"), bands.FARE_BUCKETS):
        mine = F.col("fare_bucket") == bucket
        bucket_counts += [
            F.count(F.when(mine, 1)).alias(f"{short}_n"),
            F.sum(F.when(mine, F.col("any_rule_flag")).otherwise(0)).alias(f"{short}_flagged"),
        ]
    totals = summarise_bookings(
        features, CARRIER,
        F.avg("hhi").alias("avg_route_concentration"),
        F.count(F.when(F.col("hhi") >= 0.8, 1)).alias("monopoly_route_bookings"),
        *bucket_counts,
    )
    totals = with_distinct_counts(
        totals, features, CARRIER, codes, routes_served="route", unique_flight_dates="flight_date")
    medians = fare_medians(features, CARRIER, median_fare=F.col("total_fare"))
    named = attach(totals, medians, CARRIER, match_nulls=True).join(
        F.broadcast(dim_carrier(carriers)), "carrier_code", "left")
    rated = with_rates(named, {
        "violation_rate": "flagged_bookings", "r1_violation_rate": "r1_flags",
        "r2_violation_rate": "r2_flags", "r3_violation_rate": "r3_flags",
    })
    rated = with_rates(rated, {"pct_monopoly_bookings": "monopoly_route_bookings"}, None)
    # Bookings without a carrier match nothing by carrier, so they get no cost and no bucket rates.
    costed = attach(rated, _route_window_costs(features), CARRIER).withColumns({
        c: F.coalesce(F.col(c), F.lit(0.0))
        for c in ("total_extra_cost", "avg_extra_cost_per_violation")
    })
    has_code = F.col("carrier_code").isNotNull()
    costed = costed.withColumns({
        f"{short}_violation_rate": F.when(has_code, numbers.rounded(
            numbers.percent(F.col(f"{short}_flagged"), F.col(f"{short}_n"))))
        for short in ("prem", "full", "disc")
    })
    return _ranked(costed)


def _ranked(carriers: DataFrame) -> DataFrame:
    """Shares and ranks over all carriers.

    These windows hold one row per carrier code, a two-character code space, so one task is enough
    whatever the number of bookings.
    """
    everyone = Window.partitionBy(F.lit(0))

    def share(column):
        return numbers.percent(F.col(column), F.sum(column).over(everyone))

    def place(column):
        return F.rank().over(everyone.orderBy(F.desc(column)))

    n = F.col("total_bookings")
    full = carriers.withColumns({
        "market_share_bookings": share("total_bookings"),
        "market_share_revenue": share("fare_sum"),
        "violation_rate_rank": place("violation_rate"),
        "revenue_rank": place("fare_sum"),
        "volume_rank": place("total_bookings"),
        "extra_cost_rank": place("total_extra_cost"),
    })
    return full.select(
        "carrier_code", "carrier_name", "total_bookings", "flagged_bookings", "routes_served",
        "unique_flight_dates", "violation_rate", "r1_violation_rate", "r2_violation_rate",
        "r3_violation_rate", F.col("r1_flags").alias("r1_violations"),
        F.col("r2_flags").alias("r2_violations"), F.col("r3_flags").alias("r3_violations"),
        F.col("fare_sum").alias("total_revenue"), "avg_fare", "median_fare", "avg_flagged_fare",
        "market_share_bookings", "market_share_revenue", "avg_route_concentration",
        "monopoly_route_bookings", "pct_monopoly_bookings", "total_extra_cost",
        "avg_extra_cost_per_violation", "prem_violation_rate", "full_violation_rate",
        "disc_violation_rate", "violation_rate_rank", "revenue_rank", "volume_rank",
        "extra_cost_rank",
        bands.at_least(F.col("market_share_bookings"), bands.CARRIER_SIZES, "Small Carrier")
        .alias("carrier_size_category"),
        bands.at_least(F.col("violation_rate"), bands.VIOLATION_LEVELS, "Low Violation")
        .alias("violation_category"),
        bands.at_least(
            F.col("avg_route_concentration"), bands.CARRIER_HHI_LEVELS, "Low Concentration")
        .alias("concentration_category"),
        numbers.ratio(F.col("total_extra_cost"), n).alias("extra_cost_per_booking"),
        bands.indicator(F.col("market_share_bookings") >= 20).alias("is_market_leader"),
        bands.indicator(F.col("violation_rate") >= 30).alias("is_high_violator"),
        numbers.ratio(F.col("fare_sum"), n).alias("revenue_per_booking"),
        (numbers.ratio(F.col("routes_served"), n) * 1000).alias("route_diversity_index"),
    )
