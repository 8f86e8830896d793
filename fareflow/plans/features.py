"""The booking-level hub: every booking with its features, benchmarks and rule flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fareflow.functions import bands, numbers, text
from fareflow.operators.joins import lookup
from fareflow.params import FareParams
from fareflow.plans.intermediate import (
    PERCENTILE_COLUMNS, monopoly_premium, price_outlier, seat_scarcity,
)
from fareflow.plans.staging import endpoint_miles, with_airports

FLAGS = ["r1_price_outlier", "r2_seat_scarcity", "r3_monopoly_premium", "any_rule_flag"]


def pricing_features(
    staged: DataFrame, benchmarks: DataFrame, competition: DataFrame,
    airports: DataFrame | None = None, params: FareParams = FareParams(), sizes: DataFrame | None = None,
) -> DataFrame:
    """One row per booking. With per-route tables small enough to broadcast, no booking is shuffled.

    ``sizes`` (route, fare_bucket, n_bookings) tells larger tables which keys to spread, also those they lack.

    ``airports`` is a longer coordinate list than staging had: it gives a distance to bookings still
    without one. Staging's own list would find nothing more, so it need not be joined again.
    """
    bookings = staged.select(
        "legid", "origin", "destination", "route", "search_date", "flight_date", "days_to_flight",
        bands.booking_window(F.col("days_to_flight")).alias("dtf_bucket"),
        "total_fare", "base_fare",
        numbers.ratio(F.col("total_fare"), F.col("base_fare")).alias("total_base_ratio"),
        text.count_segments(F.col("segmentsdepartureairportcode")).alias("segment_count"),
        text.first_segment(F.col("segmentsairlinecode")).alias("carrier_code"),
        "seats_flag", "fare_bucket", "is_nonstop", "is_basic_econ",
        F.col("total_miles").alias("staging_trip_dist"),
        F.col("usd_per_mi").alias("staging_usd_per_mi"),
    )
    if airports is None:
        placed = bookings.withColumn("trip_dist", F.col("staging_trip_dist"))
    else:
        placed = with_airports(bookings, airports, "origin", "destination").withColumn(
            "trip_dist", F.coalesce("staging_trip_dist", endpoint_miles(params))
        ).drop("origin_lat", "origin_lon", "destination_lat", "destination_lon")
    priced = placed.withColumn(
        "usd_per_mi", numbers.ratio(F.col("total_fare"), F.col("trip_dist")))
    limits = {"broadcast_bytes": params.broadcast_bytes, "hot_rows": params.hot_rows}
    found = lookup(
        priced, benchmarks, ["route", "fare_bucket"], [*PERCENTILE_COLUMNS, "r2_usd_per_mi"],
        "legs_sampled", **limits, sizes=None if sizes is None else sizes.withColumnRenamed("n_bookings", "legs_sampled"))
    by_route = None if sizes is None else sizes.groupBy("route").agg(F.sum("n_bookings").alias("route_bookings"))
    compared = lookup(
        found, competition, ["route"], ["carrier_count", "hhi"], "route_bookings", **limits, sizes=by_route,
    ).withColumn("hhi", numbers.clamp(F.col("hhi"), 0.0, 1.0))
    return compared.withColumns({
        "r1_price_outlier": price_outlier(params),
        "r2_seat_scarcity": seat_scarcity(),
        "r3_monopoly_premium": monopoly_premium(params),
    }).drop("r2_usd_per_mi").withColumn(
        "any_rule_flag",
        F.greatest("r1_price_outlier", "r2_seat_scarcity", "r3_monopoly_premium"))
