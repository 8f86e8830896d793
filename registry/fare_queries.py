"""Fare tables over the order tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareflow import FareTables
from fareflow.params import FareParams
from fareflow.sources import seeds
from fareflow.sources.fares import ORDER_AIRPORTS, fares_from_folder, read_fares
from fareflow.sources.tables import RunFolder
from registry.compare import comparable

NAMES = (
    "stg_fare_searches", "stg_route_stats", "int_fare_legs", "int_route_competition",
    "int_route_daily_prices", "int_route_fare_per_mi_stats", "int_rules", "pricing_features",
    "flagged_extra_costs", "pricing_alerts", "extra_cost_summary", "dashboard_kpis",
    "dashboard_kpis_pairwise", "booking_window_analysis", "timeseries_metrics", "route_map_data",
    "route_geographic", "carrier_performance", "route_performance", "crosstab_summary",
    "carrier_summary", "route_summary", "booking_sample",
)

# Booking ids are digits, half of each stored table; this codec takes a third less for them than the default.
CODEC = "zstd"

_built: dict[tuple, FareTables] = {}


def fare_tables(spark: SparkSession, folder: str) -> FareTables:
    """The tables of a folder; their shared parts are written once per application.

    The fares are stored first, as a source table would be: staging then reads columns from
    files, and its generated code is not fused with that of the joins that make the fares.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _built:
        run = RunFolder(spark, compression=CODEC)
        run.write("raw_fares", fares_from_folder(spark, folder))
        _built[key] = FareTables(read_fares(spark, run.path("raw_fares")), folder=run)
    return _built[key]


def gapped_tables(spark: SparkSession, folder: str) -> FareTables:
    """Fares some of which have no destination, so no route either, with look-ups that are never broadcast.

    The most frequent routes count as hot.
    """
    key = (spark.sparkContext.applicationId, folder, "gaps")
    if key not in _built:
        run = RunFolder(spark, compression=CODEC)
        order = F.split_part("legid", F.lit("-"), F.lit(1)).cast("bigint")
        fares = fares_from_folder(spark, folder).withColumn("segmentsarrivalairportcode", F.when(
            order % 3 != 0, F.col("segmentsarrivalairportcode")))
        run.write("raw_fares", fares)
        _built[key] = FareTables(
            read_fares(spark, run.path("raw_fares")), FareParams(broadcast_bytes=0, hot_rows=200), folder=run)
    return _built[key]


def pricing_features_split(spark: SparkSession, folder: str) -> DataFrame:
    """Two chained look-ups by shuffle, with hot, cold, absent and NULL routes."""
    return comparable(
        gapped_tables(spark, folder).pricing_features(), whole=("total_fare", "base_fare", "staging_trip_dist", "trip_dist"),
        ratios=("total_base_ratio", "staging_usd_per_mi", "usd_per_mi"))


def listed_tables(spark: SparkSession, folder: str) -> FareTables:
    """The fare tables with reference lists from CSV files, and a second list of coordinates.

    The second list has points of its own for the nations' airports: one that the first lacks, and others that differ.
    """
    key = (spark.sparkContext.applicationId, folder, "lists")
    if key not in _built:
        run = RunFolder(spark, compression=CODEC)
        for name, df in (("carriers", seeds.carriers(spark)), ("airports", seeds.airports(spark)),
                         ("classes", seeds.fare_classes(spark))):
            df.write.csv(run.path(name), header=True)
        nations = spark.read.parquet(f"{folder}/nation.parquet")
        codes = F.array(*map(F.lit, ORDER_AIRPORTS))
        nations.select(
            F.lower(F.element_at(codes, (F.col("n_nationkey") % len(ORDER_AIRPORTS) + 1).cast("int"))).alias("iata_code"),
            (F.col("n_nationkey") + 10.5).alias("latitude"), (F.col("n_nationkey") - 90.25).alias("longitude"),
        ).write.csv(run.path("coordinates"), header=True, sep=";")
        _built[key] = FareTables(
            fare_tables(spark, folder).raw, carriers=seeds.read_list(spark, run.path("carriers"), seeds.CARRIER_SCHEMA),
            airports=seeds.read_list(spark, run.path("airports"), seeds.AIRPORT_SCHEMA),
            fare_classes=seeds.read_list(spark, run.path("classes"), seeds.FARE_CLASS_SCHEMA),
            coordinates=seeds.airport_coordinates(spark, run.path("coordinates")), folder=run)
    return _built[key]


def route_geographic_two_lists(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(listed_tables(spark, folder).route_geographic())


def merged_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(listed_tables(spark, folder).coordinates)


def stg_fare_searches_csv_lists(spark: SparkSession, folder: str) -> DataFrame:
    return comparable(listed_tables(spark, folder).stg_fare_searches())


def dim_carrier(spark: SparkSession, folder: str) -> DataFrame:
    """The carriers, with the number of bookings of each in the fares."""
    tables = fare_tables(spark, folder)
    bookings = tables.staged.groupBy(F.col("marketing_carrier").alias("carrier_code")).agg(F.count(F.lit(1)).alias("n_bookings"))
    return tables.dim_carrier().join(bookings, "carrier_code", "left")


def _in_order(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        """A mart in its reading order, a row for each combination of a few labels, with the place of each row."""
        rows = fare_tables(spark, folder).presented(name).coalesce(1)
        return rows.select(F.monotonically_increasing_id().alias("place"), *columns)

    return run


def _named(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(getattr(fare_tables(spark, folder), name)())

    return run


def _pairwise(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(getattr(fare_tables(spark, folder), name)(pairwise=True))

    return run


def fare_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: _named(name) for name in NAMES}
    for name in ("carrier_performance", "route_performance"):
        found[f"{name}_pairwise"] = _pairwise(name)
    found |= {f.__name__: f for f in (
        pricing_features_split, route_geographic_two_lists, merged_coordinates, stg_fare_searches_csv_lists, dim_carrier)}
    found["crosstab_in_order"] = _in_order("crosstab_summary", "dtf_bucket", "fare_bucket", "total_bookings")
    found["booking_windows_in_order"] = _in_order("booking_window_analysis", "dtf_bucket", "fare_bucket", "total_bookings")
    return found
