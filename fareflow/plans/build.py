"""All fare tables of one raw source, the heavily reused ones written once."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.operators import checks
from fareflow.operators.distinct import dense_codes
from fareflow.params import FareParams
from fareflow.plans import features as hub
from fareflow.plans import intermediate, staging
from fareflow.functions import bands
from fareflow.plans.marts import alerts, carriers, routes, sample, windows
from fareflow.sources import seeds
from fareflow.sources.tables import RunFolder, plan_bytes


# The order tables are read in; their content does not depend on it.
READING_ORDER = {
    "booking_window_analysis": lambda: [
        bands.rank_in(F.col("dtf_bucket"), bands.WINDOWS), F.col("fare_bucket")],
    "timeseries_metrics": lambda: [F.col("flight_date")],
    "crosstab_summary": lambda: [F.col("dtf_sort_order"), F.col("fare_sort_order")],
    "carrier_summary": lambda: [F.desc("violation_rate"), F.desc("total_bookings")],
    "route_summary": lambda: [F.desc("total_bookings")],
}


class FareTables:
    """Builds the tables on demand.

    Staging, benchmarks, competition, daily prices and features feed many tables. Each is written to
    the shared folder when a table that reads it is first asked for, and read back from there;
    the other tables are plain lazy DataFrames. The ``*_plan`` methods give the shared tables as
    lazy DataFrames too.
    """

    def __init__(
        self, raw: DataFrame, params: FareParams = FareParams(), carriers: DataFrame | None = None,
        airports: DataFrame | None = None, fare_classes: DataFrame | None = None,
        coordinates: DataFrame | None = None, folder: RunFolder | None = None,
    ):
        spark = raw.sparkSession
        self.raw = raw
        self.params = params
        self.carriers = seeds.carriers(spark) if carriers is None else carriers
        self.airports = seeds.airports(spark) if airports is None else airports
        self.fare_classes = seeds.fare_classes(spark) if fare_classes is None else fare_classes
        self.coordinates = seeds.merged_coordinates(
            self.airports,
            seeds.airport_coordinates(spark) if coordinates is None else coordinates)
        self.folder = folder or RunFolder(spark)

    # Shared tables.

    def staged_plan(self) -> DataFrame:
        return staging.stg_fare_searches(self.raw, self.airports, self.fare_classes, self.params)

    def benchmarks_plan(self) -> DataFrame:
        return staging.route_benchmarks(self.staged, self.params)

    def competition_plan(self) -> DataFrame:
        return intermediate.route_competition(self.staged)

    def daily_plan(self) -> DataFrame:
        return intermediate.int_route_daily_prices(self.staged, self.carriers)

    def features_plan(self) -> DataFrame:
        split = plan_bytes(self.benchmarks) > self.params.broadcast_bytes
        return hub.pricing_features(
            self.staged, self.benchmarks, self.competition, params=self.params,
            sizes=self.route_sizes if split else None)

    @cached_property
    def staged(self) -> DataFrame:
        return self.folder.write("stg_fare_searches", self.staged_plan())

    @cached_property
    def benchmarks(self) -> DataFrame:
        return self.folder.write("route_benchmarks", self.benchmarks_plan())

    @cached_property
    def route_sizes(self) -> DataFrame:
        """Bookings per route and fare bucket, priced or not."""
        return self.folder.write("route_sizes", self.staged.groupBy("route", "fare_bucket").agg(
            F.count(F.lit(1)).alias("n_bookings")))

    @cached_property
    def competition(self) -> DataFrame:
        return self.folder.write("route_competition", self.competition_plan())

    @cached_property
    def daily(self) -> DataFrame:
        return self.folder.write("int_route_daily_prices", self.daily_plan())

    @cached_property
    def features(self) -> DataFrame:
        return self.folder.write("pricing_features", self.features_plan())

    @cached_property
    def codes(self) -> dict[str, DataFrame]:
        """Numbers of the values that several marts count."""
        return {c: dense_codes(self.features, c, self.folder) for c in ("carrier_code", "route", "flight_date")}

    # Tables under their published names.

    def stg_fare_searches(self) -> DataFrame:
        return self.staged_plan()

    def stg_route_stats(self) -> DataFrame:
        return staging.stg_route_stats(self.benchmarks_plan())

    def dim_carrier(self) -> DataFrame:
        return intermediate.dim_carrier(self.carriers)

    def int_fare_legs(self) -> DataFrame:
        return intermediate.int_fare_legs(self.staged)

    def int_route_competition(self) -> DataFrame:
        return intermediate.int_route_competition(self.competition_plan())

    def int_route_daily_prices(self) -> DataFrame:
        return self.daily_plan()

    def int_route_fare_per_mi_stats(self) -> DataFrame:
        return intermediate.int_route_fare_per_mi_stats(self.staged, self.benchmarks)

    def int_rules(self) -> DataFrame:
        return intermediate.int_rules(self.staged, self.benchmarks, self.competition, self.params)

    def pricing_features(self) -> DataFrame:
        return self.features_plan()

    def flagged_extra_costs(self) -> DataFrame:
        return alerts.flagged_extra_costs(self.features, self.daily)

    def pricing_alerts(self) -> DataFrame:
        return alerts.pricing_alerts(self.features, self.carriers)

    def extra_cost_summary(self) -> DataFrame:
        return alerts.extra_cost_summary(self.flagged_extra_costs())

    def dashboard_kpis(self) -> DataFrame:
        return alerts.dashboard_kpis(self.features, self.flagged_extra_costs())

    def dashboard_kpis_pairwise(self) -> DataFrame:
        return alerts.dashboard_kpis_pairwise(
            self.staged, self.features, self.flagged_extra_costs())

    def booking_window_analysis(self) -> DataFrame:
        return windows.booking_window_analysis(self.features, self.codes)

    def timeseries_metrics(self) -> DataFrame:
        return windows.timeseries_metrics(self.features, self.daily)

    def crosstab_summary(self) -> DataFrame:
        return windows.crosstab_summary(self.features, self.codes)

    def route_map_data(self) -> DataFrame:
        return routes.route_map_data(self.features, self.competition, self.airports)

    def route_geographic(self) -> DataFrame:
        return routes.route_geographic(self.features, self.coordinates, self.params)

    def route_performance(self, pairwise: bool = False) -> DataFrame:
        return routes.route_performance(self.features, self.daily, self.airports, pairwise)

    def route_summary(self) -> DataFrame:
        return routes.route_summary(self.features, self.airports)

    def carrier_performance(self, pairwise: bool = False) -> DataFrame:
        return carriers.carrier_performance(
            self.features, self.daily, self.carriers, self.params, pairwise)

    def carrier_summary(self) -> DataFrame:
        return carriers.carrier_summary(self.features, self.carriers, self.codes)

    def booking_sample(self) -> DataFrame:
        return sample.booking_sample(self.features, self.params)

    def presented(self, name: str) -> DataFrame:
        """A published table in its reading order, where it has one."""
        table = getattr(self, name)()
        order = READING_ORDER.get(name)
        return table.orderBy(*order()) if order else table

    # Checks on the tables.

    def table_checks(self) -> list[checks.Outcome]:
        """The declared column checks of staging, benchmarks and the reference lists.

        Staging is compared with the number of usable raw rows rather than with itself.
        """
        found: list[checks.Outcome] = []

        def add(check: str, relation: str, rows: DataFrame, failures: Column | None = None) -> None:
            found.append(checks.Outcome(check, relation, rows, failures))

        stg, stats = self.staged, self.benchmarks
        usable = self.raw.where(F.col("totalfare").isNotNull()).where(
            F.try_to_date("flightdate") >= F.try_to_date("searchdate"))
        add("equal_rowcount", "stg_fare_searches", checks.equal_rowcount(stg, usable),
            F.sum("diff_count"))
        for column in ("legid", "total_miles", "usd_per_mi"):
            add(f"not_null_{column}", "stg_fare_searches", checks.not_null(stg, column))
        add("unique_legid", "stg_fare_searches", checks.unique(stg, "legid"))
        add("accepted_values_seats_flag", "stg_fare_searches",
            checks.accepted_values(stg, "seats_flag", bands.SEAT_BANDS))
        for column in ("route", "fare_bucket"):
            add(f"not_null_{column}", "stg_route_stats", checks.not_null(stats, column))
        lists = {
            "carrier_mapping": (self.carriers, "code", ["name"]),
            "airport_geo": (self.airports, "iata_code", ["lat_deg", "lon_deg"]),
            "fare_bucket_map": (self.fare_classes, "first_letter", ["fare_bucket"]),
        }
        for relation, (df, key, others) in lists.items():
            add(f"unique_{key}", relation, checks.unique(df, key))
            for column in [key, *others]:
                add(f"not_null_{column}", relation, checks.not_null(df, column))
        add("accepted_values_fare_bucket", "fare_bucket_map",
            checks.accepted_values(self.fare_classes, "fare_bucket", bands.FARE_BUCKETS))
        return found

    def table_check_summary(self) -> DataFrame:
        return checks.summarise(self.table_checks())
