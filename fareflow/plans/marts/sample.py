"""A reproducible stratified sample of bookings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fareflow.functions import bands, numbers
from fareflow.operators.joins import attach
from fareflow.operators.sampling import stratified_sample
from fareflow.params import FareParams
from fareflow.plans.summaries import fare_medians

STRATA = ["route", "carrier_code", "dtf_bucket", "fare_bucket", "any_rule_flag"]
MEDIAN_KEYS = ["route", "carrier_code", "dtf_bucket"]
KEPT = [
    "legid", "route", "origin", "destination", "carrier_code", "dtf_bucket", "fare_bucket",
    "flight_date", "search_date", "total_fare", "base_fare", "trip_dist", "usd_per_mi",
    "any_rule_flag", "r1_price_outlier", "r2_seat_scarcity", "r3_monopoly_premium", "seats_flag",
    "is_nonstop", "is_basic_econ", "p50_usd_per_mi", "p95_usd_per_mi", "hhi", "carrier_count",
]


def booking_sample(features: DataFrame, params: FareParams = FareParams()) -> DataFrame:
    """Sampled bookings with weights and their premium over the median of route, carrier, window."""
    sample = stratified_sample(
        features.select(*KEPT), STRATA, "legid", params.sample_rate, params.sample_min,
        params.sample_max, params.sample_seed)
    medians = fare_medians(features, MEDIAN_KEYS, route_median_fare=F.col("total_fare"))
    median = F.col("route_median_fare")
    over = F.col("total_fare") - median
    return attach(sample, medians, MEDIAN_KEYS).withColumns({
        "cost_premium": F.when(F.col("any_rule_flag") == 1, over).otherwise(0.0),
        "price_premium_pct": F.when(
            median > 0, numbers.ratio(over, median) * 100).otherwise(0.0),
        "concentration_level": bands.concentration_level(F.col("hhi")),
        "dtf_sort_order": bands.rank_in(F.col("dtf_bucket"), bands.WINDOWS),
    })
