"""Bookings by route."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fareflow.functions import bands, numbers
from fareflow.operators.aggregates import list_text
from fareflow.operators.joins import attach
from fareflow.params import FareParams
from fareflow.plans.marts.cells import carrier_route_cells, pairwise_medians, roll_up
from fareflow.plans.staging import with_airports
from fareflow.plans.summaries import fare_medians, route_ends, summarise_bookings, with_rates

ROUTE = ["route"]
COORDINATES = ["origin_lat", "origin_lon", "destination_lat", "destination_lon"]


def _located(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """Routes with the coordinates of both ends; others are left out."""
    return with_airports(routes, airports, "origin", "destination").dropna(subset=COORDINATES)


def route_map_data(features: DataFrame, competition: DataFrame, airports: DataFrame) -> DataFrame:
    """Located routes with their flag rate (one decimal) and concentration."""
    routes = summarise_bookings(features, ROUTE).withColumns(route_ends())
    rated = with_rates(routes, {"pct_flagged": "flagged_bookings"}, 1)
    joined = attach(_located(rated, airports), competition.select("route", "hhi"), ROUTE)
    return joined.select(
        "route", "origin", "destination", "total_bookings", "flagged_bookings", "pct_flagged",
        "hhi", bands.concentration_level(F.col("hhi")).alias("concentration_level"), *COORDINATES)


def _with_route_extra_cost(features: DataFrame, routes: DataFrame) -> DataFrame:
    """Add ``median_fare`` and the unclipped excess of flagged fares over it."""
    medians = fare_medians(features, ROUTE, median_fare=F.col("total_fare"))
    over = F.col("flagged_fare_sum") - F.col("flagged_bookings") * F.col("median_fare")
    return attach(routes, medians, ROUTE).withColumn("total_extra_cost", over)


def route_geographic(
    features: DataFrame, coordinates: DataFrame, params: FareParams = FareParams()
) -> DataFrame:
    """Located routes with enough bookings. ``coordinates`` has airport_lat and airport_lon."""
    places = coordinates.select(
        "iata_code", F.col("airport_lat").alias("lat_deg"), F.col("airport_lon").alias("lon_deg"))
    routes = summarise_bookings(features, ROUTE).withColumns(route_ends()).where(
        F.col("total_bookings") >= params.min_route_bookings)
    rated = with_rates(_located(routes, places), {"pct_flagged": "flagged_bookings"}, None)
    return _with_route_extra_cost(features, rated).select(
        "route", "origin", "destination", "total_bookings", "flagged_bookings", "pct_flagged",
        "avg_fare", "total_extra_cost", *COORDINATES)


def route_performance(
    features: DataFrame, daily: DataFrame, airports: DataFrame, pairwise: bool = False
) -> DataFrame:
    """Route volumes, rates, prices, carriers and excess over daily medians.

    ``pairwise`` gives the figures of a many-to-many join of bookings on carrier and route, in
    which a cell of n bookings counts n * n times.
    """
    known = features.where(F.col("route").isNotNull())
    cells = carrier_route_cells(known, daily, pairwise)
    routes = roll_up(
        cells, ROUTE,
        F.max("carrier_count").alias("carrier_count"),
        F.max("hhi").alias("hhi"),
        F.array_sort(F.collect_set("carrier_code")).alias("serving_carriers"),
    )
    medians = (
        pairwise_medians(known, cells, ROUTE) if pairwise
        else fare_medians(known, ROUTE, median_fare=F.col("total_fare")))
    rated = with_rates(
        attach(routes, medians, ROUTE).withColumns(route_ends()),
        {"pct_flagged": "flagged_bookings"}, None)
    return with_airports(rated, airports, "origin", "destination").select(
        "route", "origin", "destination", *COORDINATES, "total_bookings", "flagged_bookings",
        "pct_flagged", "r1_flags", "r2_flags", "r3_flags", "carrier_count", "hhi",
        bands.concentration_level(F.col("hhi")).alias("concentration_level"),
        "avg_fare", "median_fare", "avg_flagged_fare", "avg_distance_miles", "total_extra_cost",
        "serving_carriers")


def route_summary(features: DataFrame, airports: DataFrame) -> DataFrame:
    """Located routes with rates, revenue, categories and distance from the market's average rate."""
    routes = summarise_bookings(
        features, ROUTE,
        F.countDistinct("carrier_code").alias("unique_carriers_actual"),
        # Constant within a route, so any aggregate that ignores NULL returns the value itself.
        F.max("hhi").alias("hhi"),
        F.max("carrier_count").cast("double").alias("carrier_count"),
        F.avg("trip_dist").alias("avg_distance_miles"),
        list_text(F.col("carrier_code"), ",", distinct=True).alias("serving_carriers"),
    ).withColumns(route_ends())
    rates = {
        "route_alert_rate": "flagged_bookings",
        "r1_rate": "r1_flags", "r2_rate": "r2_flags", "r3_rate": "r3_flags",
    }
    located = with_rates(_located(routes, airports), rates)
    # A one-row scalar instead of a window over all routes, which would run as one task.
    market = located.agg(F.avg("route_alert_rate")).scalar()
    return _with_route_extra_cost(features, located).select(
        "route", "origin", "destination", "total_bookings", "flagged_bookings",
        "unique_carriers_actual", *rates, "hhi", "carrier_count", "avg_fare", "median_fare",
        "avg_flagged_fare", F.col("fare_sum").alias("total_revenue"), "avg_distance_miles",
        "serving_carriers", *COORDINATES,
        F.coalesce("total_extra_cost", F.lit(0.0)).alias("total_extra_cost"),
        bands.concentration_level(F.col("hhi")).alias("concentration_level"),
        bands.indicator(F.col("hhi") >= 0.8).alias("is_monopoly_route"),
        bands.indicator(F.col("carrier_count") == 1).alias("is_single_carrier"),
        bands.at_least(F.col("total_bookings"), bands.ROUTE_VOLUMES, "Low Volume")
        .alias("volume_category"),
        bands.at_least(F.col("route_alert_rate"), bands.ROUTE_ALERTS, "Low Alert")
        .alias("alert_category"),
        bands.at_least(F.col("avg_distance_miles"), bands.HAULS, "Short Haul")
        .alias("distance_category"),
        numbers.ratio(F.col("fare_sum"), F.col("avg_distance_miles")).alias("revenue_per_mile"),
        (F.col("route_alert_rate") - market).alias("alert_rate_vs_avg"),
    )
