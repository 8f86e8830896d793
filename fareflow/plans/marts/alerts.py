"""Flagged bookings, what they cost above the usual price, and the headline numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fareflow.functions import arrays, numbers
from fareflow.operators.aggregates import sum_where
from fareflow.plans.features import FLAGS
from fareflow.plans.intermediate import dim_carrier, with_daily_median

# Rule names by flag column.
RULE_NAMES = {
    "r1_price_outlier": "price_outlier",
    "r2_seat_scarcity": "seat_scarcity",
    "r3_monopoly_premium": "monopoly_premium",
}


def flagged_extra_costs(features: DataFrame, daily: DataFrame) -> DataFrame:
    """Flagged bookings with their excess over the daily median fare, never below 0.

    Only flagged rows and these columns reach the look-up.
    """
    bookings = features.where("any_rule_flag = 1").select(
        "legid", "route", "carrier_code", "dtf_bucket", "flight_date", "total_fare",
        F.col("r1_price_outlier").alias("is_r1"),
        F.col("r2_seat_scarcity").alias("is_r2"),
        F.col("r3_monopoly_premium").alias("is_r3"),
    )
    excess = F.col("total_fare") - F.col("median_fare")
    return (
        with_daily_median(bookings, daily)
        .withColumn("extra_cost", F.when(excess > 0, excess).otherwise(0.0))
        .withColumnRenamed("carrier_code", "marketing_carrier")
    )


def pricing_alerts(features: DataFrame, carriers: DataFrame) -> DataFrame:
    """One row per flagged booking with the carrier's name and the list of rules it broke."""
    broken = arrays.present_only(*[
        F.when(F.col(flag) == 1, F.lit(name)) for flag, name in RULE_NAMES.items()])
    alerts = features.where("any_rule_flag = 1").join(
        F.broadcast(dim_carrier(carriers)), "carrier_code", "left")
    return alerts.select(
        "legid", "route", "flight_date", "carrier_code", "carrier_name", "total_fare", "trip_dist",
        F.col("r1_price_outlier").alias("flag_price_outlier"),
        F.col("r2_seat_scarcity").alias("flag_seat_scarcity"),
        F.col("r3_monopoly_premium").alias("flag_monopoly"),
        broken.alias("flag_list"),
    )


def extra_cost_summary(extra_costs: DataFrame) -> DataFrame:
    """One row: overage of all flagged bookings, on average, and by rule."""
    cost = F.col("extra_cost")
    return extra_costs.agg(
        F.count(F.lit(1)).alias("num_flagged_bookings"),
        F.sum(cost).alias("total_extra_cost"),
        numbers.ratio(F.sum(cost), F.count(F.lit(1))).alias("avg_extra_per_booking"),
        *[sum_where(F.col(f"is_r{i}") == 1, cost).alias(f"total_extra_r{i}") for i in (1, 2, 3)],
    )


def dashboard_kpis(features: DataFrame, extra_costs: DataFrame) -> DataFrame:
    """One row of headline numbers at booking grain: two aggregates, no join by booking key."""
    totals = features.agg(
        F.count(F.lit(1)).alias("total_bookings"),
        *[F.coalesce(F.sum(flag), F.lit(0)).alias(flag) for flag in FLAGS],
    )
    overage = extra_costs.agg(F.coalesce(F.sum("extra_cost"), F.lit(0.0)).alias("c"))
    return _kpis(totals.withColumn("extra_cost", overage.scalar()))


def dashboard_kpis_pairwise(
    staged: DataFrame, features: DataFrame, extra_costs: DataFrame
) -> DataFrame:
    """The same numbers as a three-way left join on ``legid`` gives them.

    A ``legid`` that repeats multiplies there. The product is taken from counts per ``legid``
    instead of from joined rows. Equal to :func:`dashboard_kpis` when ``legid`` is unique.
    """
    zero = F.lit(0)
    stacked = (
        staged.select("legid", F.lit(1).alias("s"), zero.alias("f"), zero.alias("e"),
                      *[zero.alias(flag) for flag in FLAGS], F.lit(0.0).alias("extra_cost"))
        .unionByName(features.select("legid", zero.alias("s"), F.lit(1).alias("f"), zero.alias("e"),
                                     *FLAGS, F.lit(0.0).alias("extra_cost")))
        .unionByName(extra_costs.select("legid", zero.alias("s"), zero.alias("f"),
                                        F.lit(1).alias("e"), *[zero.alias(x) for x in FLAGS],
                                        "extra_cost"))
    )
    # A NULL legid matches nothing, so its staged rows stand alone.
    matched = F.col("legid").isNotNull()
    sums = stacked.where(matched | (F.col("s") == 1)).groupBy("legid").agg(
        *[F.sum(c).alias(c) for c in ["s", "f", "e", *FLAGS, "extra_cost"]])
    by_feature = F.col("s") * F.greatest(F.col("f"), F.lit(1))
    by_extra = F.col("s") * F.greatest(F.col("e"), F.lit(1))
    totals = sums.where("s > 0").agg(
        F.sum(by_feature * F.greatest(F.col("e"), F.lit(1))).alias("total_bookings"),
        *[F.coalesce(F.sum(by_extra * F.col(x)), zero).alias(x) for x in FLAGS],
        F.coalesce(F.sum(by_feature * F.col("extra_cost")), F.lit(0.0)).alias("extra_cost"),
    )
    return _kpis(totals)


def _kpis(totals: DataFrame) -> DataFrame:
    n = F.col("total_bookings")

    def share(flag):
        return numbers.rounded(numbers.percent(F.col(flag), n))

    return totals.select(
        n,
        F.col("any_rule_flag").alias("total_any_alerts"),
        F.col("r1_price_outlier").alias("total_r1_alerts"),
        F.col("r2_seat_scarcity").alias("total_r2_alerts"),
        F.col("r3_monopoly_premium").alias("total_r3_alerts"),
        share("any_rule_flag").alias("pct_any_alerts"),
        share("r1_price_outlier").alias("pct_r1_outliers"),
        share("r2_seat_scarcity").alias("pct_r2_scarcity"),
        share("r3_monopoly_premium").alias("pct_r3_monopoly"),
        F.col("extra_cost").alias("total_extra_cost_usd"),
        numbers.rounded(numbers.ratio(F.col("extra_cost"), F.col("any_rule_flag")))
        .alias("avg_extra_per_alert"),
    )
