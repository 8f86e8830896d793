"""Legs, competition, daily prices and booking-level scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.functions import bands, numbers, text
from fareflow.operators.joins import lookup
from fareflow.operators.quantiles import percentiles_of_small_groups
from fareflow.params import STANDARD_PERCENTILES, FareParams
from fareflow.sources.tables import plan_bytes

DAILY_KEYS = ["route", "carrier_code", "dtf_bucket", "flight_date"]
PERCENTILE_COLUMNS = list(STANDARD_PERCENTILES)


def dim_carrier(carriers: DataFrame) -> DataFrame:
    return carriers.select(F.col("code").alias("carrier_code"), F.col("name").alias("carrier_name"))


def int_fare_legs(staged: DataFrame) -> DataFrame:
    """One row per flight leg, numbered from 1; bookings without departure segments have none."""
    departures = text.split_segments(F.col("segmentsdepartureairportcode"))
    lists = {
        "arrival_airport": "segmentsarrivalairportcode",
        "operating_carrier": "segmentsairlinecode",
        "leg_distance": "segmentsdistance",
        "leg_duration_sec": "segmentsdurationinseconds",
    }
    legs = staged.select(
        "legid",
        *[text.split_segments(F.col(source)).alias(name) for name, source in lists.items()],
        F.posexplode(departures).alias("_at", "_departure"),
    )

    def element(name: str) -> Column:
        return text.clean_segment(F.get(F.col(name), F.col("_at")))

    def number(name: str) -> Column:
        whole = text.safe_cast(element(name), "decimal(38,0)")
        return text.safe_cast(whole, "bigint").alias(name)

    return legs.select(
        "legid", (F.col("_at") + 1).alias("leg_number"),
        text.clean_segment(F.col("_departure")).alias("departure_airport"),
        element("arrival_airport").alias("arrival_airport"),
        element("operating_carrier").alias("operating_carrier"),
        number("leg_distance"), number("leg_duration_sec"),
    )


def route_competition(staged: DataFrame) -> DataFrame:
    """Carriers, bookings and Herfindahl index (sum of squared booking shares) per route."""
    per_carrier = (
        staged.where(F.col("marketing_carrier").isNotNull())
        .groupBy("route", "marketing_carrier")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    return per_carrier.groupBy("route").agg(
        F.count("marketing_carrier").alias("carrier_count"),
        (F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("hhi"),
        F.sum("n").cast("bigint").alias("route_bookings"),
    )


def int_route_competition(competition: DataFrame) -> DataFrame:
    return competition.drop("route_bookings")


def int_route_daily_prices(staged: DataFrame, carriers: DataFrame) -> DataFrame:
    """Median and 95th percentile of fare and of fare to base fare, per route, carrier, window, day."""
    fare, ratio = F.col("total_fare"), F.col("_ratio")
    prices = percentiles_of_small_groups(
        staged.select(
            "route", F.col("marketing_carrier").alias("carrier_code"),
            bands.booking_window(F.col("days_to_flight")).alias("dtf_bucket"), "flight_date",
            "total_fare", numbers.ratio(fare, F.col("base_fare")).alias("_ratio"),
        ),
        DAILY_KEYS,
        {
            "median_fare": (fare, 0.50), "p95_fare": (fare, 0.95),
            "median_ratio": (ratio, 0.50), "p95_ratio": (ratio, 0.95),
        },
        counted={"obs": fare},
        stored_bytes=plan_bytes(staged),
    )
    named = prices.join(F.broadcast(dim_carrier(carriers)), "carrier_code", "left")
    return named.select(
        "route", "carrier_code", "carrier_name", "dtf_bucket", "flight_date", "obs",
        "median_fare", "p95_fare", "median_ratio", "p95_ratio")


def with_daily_median(bookings: DataFrame, daily: DataFrame) -> DataFrame:
    """Bookings with the median fare of their route, carrier, window and flight date."""
    return lookup(bookings, daily, DAILY_KEYS, ["median_fare"], "obs")


def int_route_fare_per_mi_stats(staged: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Priced bookings with their benchmarks and z-score; a NULL fare bucket has no benchmark."""
    facts = staged.where(F.col("usd_per_mi").isNotNull()).select(
        "legid", "search_date", "flight_date", "days_to_flight", "route", "origin", "destination",
        "fare_bucket", "total_miles", "usd_per_mi", "total_fare", "base_fare", "seats_flag",
        "is_nonstop", "is_basic_econ", "is_refundable")
    price = F.col("usd_per_mi")
    scored = lookup(
        facts, benchmarks, ["route", "fare_bucket"],
        [*PERCENTILE_COLUMNS, "max_usd_per_mi", "legs_sampled"], "legs_sampled")
    return scored.withColumns({
        "legs_sampled": F.coalesce("legs_sampled", F.lit(0)),
        "usd_per_mi_z": numbers.z_score(price, F.col("p50_usd_per_mi"), F.col("p95_usd_per_mi")),
        "is_above_p95": bands.indicator(price >= F.col("p95_usd_per_mi")),
        "is_above_p97": bands.indicator(price >= F.col("p97_usd_per_mi")),
    })


def price_outlier(params: FareParams) -> Column:
    """Rule 1: the robust z-score of $/mile reaches the threshold."""
    z = numbers.z_score(F.col("usd_per_mi"), F.col("p50_usd_per_mi"), F.col("p95_usd_per_mi"))
    return bands.indicator(z >= params.z_threshold)


def seat_scarcity() -> Column:
    """Rule 2: few seats left and $/mile at or above the rule's percentile."""
    scarce = F.col("seats_flag").isin("sold_out", "scarce")
    return bands.indicator(scarce & (F.col("usd_per_mi") >= F.col("r2_usd_per_mi")))


def monopoly_premium(params: FareParams) -> Column:
    """Rule 3: a concentrated route and $/mile at or above the 95th percentile."""
    return bands.indicator(
        (F.col("hhi") >= params.hhi_threshold) & (F.col("usd_per_mi") >= F.col("p95_usd_per_mi")))


def int_rules(
    staged: DataFrame, benchmarks: DataFrame, competition: DataFrame, params: FareParams = FareParams()
) -> DataFrame:
    """The three rules with rule 2's percentile taken over all bookings of route and fare bucket.

    That percentile also exists for a NULL bucket, so the look-up matches NULLs; the other
    benchmarks are then blanked where a key is NULL.
    """
    facts = staged.select(
        "legid", "route", "flight_date", "search_date", "days_to_flight", "fare_bucket",
        "usd_per_mi", "seats_flag")
    limits = {"broadcast_bytes": params.broadcast_bytes, "hot_rows": params.hot_rows}
    found = lookup(
        facts, benchmarks, ["route", "fare_bucket"], [*PERCENTILE_COLUMNS, "r2_usd_per_mi"],
        "legs_sampled", match_nulls=True, **limits)
    keyed = F.col("route").isNotNull() & F.col("fare_bucket").isNotNull()
    found = found.withColumns({c: F.when(keyed, F.col(c)) for c in PERCENTILE_COLUMNS})
    ruled = lookup(
        found, competition, ["route"], ["carrier_count", "hhi"], "route_bookings", **limits
    ).withColumns({
        "r1_price_outlier_flag": price_outlier(params),
        "r2_seat_scarcity_flag": seat_scarcity(),
        "r3_monopoly_premium_flag": monopoly_premium(params),
    }).drop("r2_usd_per_mi")
    return ruled.withColumn("any_rule_flag", F.greatest(
        "r1_price_outlier_flag", "r2_seat_scarcity_flag", "r3_monopoly_premium_flag"))
