"""Clean bookings and the price-per-mile benchmarks of route and fare bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.functions import bands, geo, numbers, text
from fareflow.operators.quantiles import exact_percentiles
from fareflow.params import FareParams

SEGMENT_COLUMNS = (
    "segmentsdepartureairportcode", "segmentsarrivalairportcode", "segmentsairlinecode",
    "segmentsdistance", "segmentsdurationinseconds", "segmentsequipmentdescription",
    "segmentscabincode",
)


def with_airports(df: DataFrame, airports: DataFrame, origin: str, destination: str) -> DataFrame:
    """Left-join the coordinates of both ends as ``origin_lat/_lon``, ``destination_lat/_lon``."""
    for side, code in (("origin", origin), ("destination", destination)):
        place = F.broadcast(airports.select(
            F.col("iata_code").alias("_code"),
            F.col("lat_deg").alias(f"{side}_lat"),
            F.col("lon_deg").alias(f"{side}_lon"),
        ))
        df = df.join(place, F.col(code) == F.col("_code"), "left").drop("_code")
    return df


def endpoint_miles(params: FareParams) -> Column:
    """Padded great-circle miles between the joined coordinates."""
    return geo.great_circle_miles(
        F.col("origin_lat"), F.col("origin_lon"), F.col("destination_lat"),
        F.col("destination_lon"), params.earth_radius_m, params.routing_pad)


def chosen_miles(raw: Column, great_circle: Column) -> Column:
    """The stated miles if at most twice the great circle, else the great circle, else as stated."""
    plausible = F.when(raw <= 2 * great_circle, raw)
    return F.coalesce(plausible, great_circle, raw)


def stg_fare_searches(
    raw: DataFrame, airports: DataFrame, fare_classes: DataFrame, params: FareParams = FareParams()
) -> DataFrame:
    """One row per usable searched fare. Narrow: only the fixed lists are joined, by broadcast.

    Rows need both dates (parsed, in order) and a fare; NaN is none. Amounts are rounded to ``fare_scale``.
    """
    usable = raw.where(F.col("totalfare").isNotNull() & ~F.isnan("totalfare")).withColumns({
        "search_date": F.try_to_date("searchdate"),
        "flight_date": F.try_to_date("flightdate"),
    }).where(F.col("flight_date") >= F.col("search_date"))

    named = usable.select(
        "legid", "search_date", "flight_date",
        F.date_diff("flight_date", "search_date").alias("days_to_flight"),
        text.first_segment(F.col("segmentsdepartureairportcode")).alias("origin"),
        text.last_segment(F.col("segmentsarrivalairportcode")).alias("destination"),
        text.first_segment(F.col("segmentsairlinecode")).alias("marketing_carrier"),
        numbers.whole(F.col("totalfare"), params.fare_scale).alias("total_fare", metadata={"decimals": params.fare_scale}),
        numbers.whole(F.col("basefare"), params.fare_scale).alias("base_fare"),
        numbers.whole(F.col("totaltraveldistance"), params.fare_scale).alias("_raw_miles"),
        F.col("isnonstop").alias("is_nonstop"),
        F.col("isbasiceconomy").alias("is_basic_econ"),
        F.col("isrefundable").alias("is_refundable"),
        F.trim("farebasiscode").alias("farebasiscode"),
        numbers.whole(F.col("seatsremaining")).cast("int").alias("seats_remaining"),
        "travelduration", *SEGMENT_COLUMNS,
    )
    measured = with_airports(named, airports, "origin", "destination").withColumn(
        "total_miles", chosen_miles(F.col("_raw_miles"), endpoint_miles(params)))
    letters = F.broadcast(fare_classes)
    first_letter = F.upper(F.left("farebasiscode", F.lit(1)))
    classed = measured.join(letters, first_letter == F.col("first_letter"), "left")
    return classed.select(
        "legid", "search_date", "flight_date", "days_to_flight", "origin", "destination",
        text.concat_text(F.col("origin"), F.lit("-"), F.col("destination")).alias("route"),
        "marketing_carrier", "total_fare", "base_fare", "total_miles",
        numbers.ratio(F.col("total_fare"), F.col("total_miles")).alias("usd_per_mi"),
        "is_nonstop", "is_basic_econ", "is_refundable", "farebasiscode", "fare_bucket",
        "seats_remaining", bands.seats_band(F.col("seats_remaining")).alias("seats_flag"),
        "travelduration", *SEGMENT_COLUMNS,
    )


def route_benchmarks(staged: DataFrame, params: FareParams = FareParams()) -> DataFrame:
    """Route and fare bucket (NULL included): percentiles, maximum and count of $/mile.

    Everything comes from one pass over the value counts; the maximum is the 100th percentile.
    ``r2_usd_per_mi`` is the percentile rule 2 compares with.
    """
    price = F.col("usd_per_mi")
    measures = {name: (price, p) for name, p in params.benchmark_percentiles.items()}
    measures["max_usd_per_mi"] = (price, 1.0)
    return exact_percentiles(
        staged, ["route", "fare_bucket"], measures, counted={"legs_sampled": price})


def stg_route_stats(benchmarks: DataFrame) -> DataFrame:
    return benchmarks.drop("r2_usd_per_mi")
