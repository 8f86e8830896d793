"""The physical plans: what is shuffled, pushed down and trimmed."""

import os
import re

import pytest

from registry.fare_queries import fare_tables
from registry.table_queries import table_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def tables(spark):
    return fare_tables(spark, FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def test_booking_level_tables_are_not_shuffled(tables):
    for df in (tables.stg_fare_searches(), tables.pricing_features(), tables.int_rules(),
               tables.int_fare_legs(), tables.flagged_extra_costs(), tables.pricing_alerts()):
        assert "Exchange hashpartitioning" not in plan(df)
        assert "SortMergeJoin" not in plan(df)


def test_a_larger_lookup_table_is_split_not_broadcast(tables):
    from fareflow.operators.joins import lookup
    from fareflow.plans.intermediate import DAILY_KEYS

    spark = tables.raw.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(lookup(tables.features, tables.daily, DAILY_KEYS, ["median_fare"], "obs",
                           broadcast_bytes=0, hot_rows=1000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The hot keys are broadcast, the rest meet in a shuffle.
    assert "SortMergeJoin" in text and text.count("BroadcastHashJoin") == 2
    assert "(obs#" in text and "> 1000)" in text


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(tables.stg_fare_searches())
    assert "IsNotNull(totalfare)" in text and "IsNotNull(flightdate)" in text
    assert len(scans(plan(tables.int_route_competition()))[0].split(",")) == 2
    assert "IsNotNull(marketing_carrier)" in plan(tables.int_route_competition())
    alerts = plan(tables.flagged_extra_costs())
    assert "EqualTo(any_rule_flag,1)" in alerts and "usd_per_mi" not in alerts


def test_aggregates_combine_before_the_shuffle(tables):
    for df in (tables.booking_window_analysis(), tables.timeseries_metrics(), tables.carrier_summary()):
        assert "partial_sum" in plan(df) and "partial_count" in plan(df)


def test_no_booking_is_copied_for_distinct_counts(tables):
    for df in (tables.booking_window_analysis(), tables.crosstab_summary(), tables.carrier_summary()):
        assert "Expand" not in plan(df) and "bitmap_construct_agg" in plan(df)


def test_a_split_look_up_reads_facts_once(spark):
    from registry.fare_queries import gapped_tables

    text = plan(gapped_tables(spark, FOLDER).pricing_features())
    assert text.count("segmentsairlinecode") and len(re.findall(r"ReadSchema: struct<[^>]*legid", text)) == 1
    # Two chained look-ups: each meets the facts in one shuffle, by key and salt, or at run time by broadcast.
    assert "_salt" in text


def test_samples_and_deduplication_are_trimmed_before_the_shuffle(spark, tables):
    queries = table_queries()
    for df in (tables.booking_sample(), queries["dedup_latest_order_per_customer"](spark, FOLDER),
               queries["listagg_types_per_brand"](spark, FOLDER)):
        assert re.search(r"WindowGroupLimit .*Partial", plan(df))


def test_no_cartesian_products_and_no_python(spark):
    from __spark_entry__ import queries
    for name, query in queries().items():
        text = plan(query(spark, FOLDER))
        assert "CartesianProduct" not in text, name
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|InPandas", text), name
