"""The reusable operators and checks over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareflow.functions import arrays, dates, geo, numbers, text
from fareflow.operators import aggregates, checks, relations, reshape
from fareflow.operators.quantiles import exact_percentiles, with_overall_percentile
from fareflow.plans.staging import with_airports
from fareflow.sources.periods import load_by_period
from fareflow.sources.tables import RunFolder
from registry.compare import comparable
from registry.fare_queries import fare_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(build(spark, folder))

    QUERIES[build.__name__] = run
    return build


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Reshaping.

@registered
def pivot_orders_by_priority(spark, folder):
    orders = read(spark, folder, "orders")
    priorities = reshape.column_values(orders, "o_orderpriority")
    return orders.groupBy("o_orderstatus").agg(
        *reshape.pivot(F.col("o_orderpriority"), priorities),
        *reshape.pivot(F.col("o_orderpriority"), priorities, suffix="_total",
                       then=F.col("o_totalprice"), otherwise=0.0))


@registered
def unpivot_part_attributes(spark, folder):
    return reshape.unpivot(
        read(spark, folder, "part"), keep=["p_partkey"], remove=["p_name"],
        field_name="attribute", value_name="content")


def _parties(spark, folder) -> dict[str, DataFrame]:
    customer = read(spark, folder, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    supplier = read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return {"customer": customer, "supplier": supplier}


@registered
def union_relations_parties(spark, folder):
    return reshape.union_relations(
        _parties(spark, folder), column_types={"party_key": "string"}, where="balance > 0")


@registered
def union_tables_by_prefix(spark, folder):
    names = []
    for label, df in _parties(spark, folder).items():
        names.append(f"fareflow_party_{label}")
        df.createOrReplaceTempView(names[-1])
    found = relations.tables_with_prefix(spark, "", "FAREFLOW_party_", exclude="%ignored")
    union = reshape.union_relations(found, exclude=["segment", "nation"])
    for name in names:
        spark.catalog.dropTempView(name)
    return union


@registered
def dedup_latest_order_per_customer(spark, folder):
    return reshape.deduplicate(
        read(spark, folder, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")])


@registered
def column_values_by_frequency(spark, folder):
    return reshape.column_value_counts(
        read(spark, folder, "events"), "event_type", where="value >= 10")


@registered
def column_values_of_tables(spark, folder):
    """The values of a named table, and the default for a table that is not there, beside each status's orders."""
    orders = read(spark, folder, "orders")
    orders.createOrReplaceTempView("fareflow_orders")
    here = reshape.table_column_values(spark, "fareflow_orders", "o_orderstatus", default=["none"])
    absent = reshape.table_column_values(spark, "fareflow_absent_orders", "o_orderstatus", default=["F", "none"])
    spark.catalog.dropTempView("fareflow_orders")
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders")).select(
        "o_orderstatus", "n_orders", F.col("o_orderstatus").isin(here).alias("listed"),
        F.col("o_orderstatus").isin(absent).alias("in_default"))


@registered
def date_spine_daily_orders(spark, folder):
    """From the first to the last day of the table."""
    orders = read(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    first, end = orders.agg(F.min(day).cast("string"), F.date_add(F.max(day), 1).cast("string")).first()
    spine = reshape.date_spine(spark, "day", first, end)
    per_day = orders.groupBy(
        F.col("o_orderdate").cast("date").alias("date_day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    return spine.join(per_day, "date_day", "left").select(
        "date_day", F.coalesce("n", F.lit(0)).alias("n_orders"),
        F.coalesce("total", F.lit(0.0)).alias("total_price"))


@registered
def series_line_numbers(spark, folder):
    """From 1 to three above the largest number of the table."""
    lineitem = read(spark, folder, "lineitem")
    series = reshape.generate_series(spark, lineitem.agg(F.max("l_linenumber")).first()[0] + 3)
    lines = lineitem.groupBy(
        F.col("l_linenumber").cast("bigint").alias("generated_number")).agg(
        F.count(F.lit(1)).alias("n_lines"))
    return series.join(lines, "generated_number", "left")


@registered
def star_except_customer(spark, folder):
    return reshape.star(
        read(spark, folder, "customer"), ["C_ACCTBAL", "c_name"], prefix="the_", suffix="_x")


@registered
def nullcheck_customer(spark, folder):
    blanked = read(spark, folder, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(
            F.col("c_mktsegment")))
    return reshape.blanks_to_null(blanked)


@registered
def except_intersect_nations(spark, folder):
    """Nations with thousands of account balance, of all customers and all suppliers."""
    buyers = read(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 1000).alias("thousands"))
    sellers = read(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 1000).alias("thousands"))
    return reshape.without_rows(buyers, sellers).withColumn("part", F.lit("buyers only")).union(
        reshape.common_rows(buyers, sellers).withColumn("part", F.lit("both")))


@registered
def group_by_first_columns(spark, folder):
    lines = read(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return aggregates.group_by_first(lines, 2).agg(F.sum("l_quantity").alias("quantity"))


# Aggregates.

@registered
def listagg_types_per_brand(spark, folder):
    part = read(spark, folder, "part")
    by_brand = part.groupBy("p_brand").agg(
        aggregates.list_text(F.col("p_type"), ",", distinct=True).alias("types"))
    first = aggregates.first_list_text(part, ["p_brand"], "p_type", ["p_partkey"], 3, "first_types", "_|_")
    cheapest = aggregates.first_list_text(
        part, ["p_brand"], "p_name", ["p_retailprice", "p_partkey"], 4, "cheapest", "; ")
    return by_brand.join(first, "p_brand").join(cheapest, "p_brand")


@registered
def any_value_bool_or_events(spark, folder):
    events = read(spark, folder, "events")
    return events.groupBy("user_id").agg(
        aggregates.any_value(F.concat(F.lit("user "), F.col("user_id"))).alias("label"),
        aggregates.bool_or((F.col("event_type") == "purchase") & (F.col("value") > 50))
        .alias("big_buyer"),
        aggregates.sum_where(F.col("event_type") == "error", F.lit(1)).alias("n_errors"),
        aggregates.mean_where(F.col("event_type") == "view", F.col("value")).alias("mean_view"))


@registered
def global_percentile_price(spark, folder):
    """One group holding every row; past 10,000 distinct prices it is ranked bin by bin."""
    price = F.col("l_extendedprice")
    fractions = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p97": 0.97, "top": 1.0}
    return exact_percentiles(
        read(spark, folder, "lineitem"), [], {n: (price, p) for n, p in fractions.items()},
        wide_group=10_000, counted={"n_prices": price})


@registered
def percentiles_by_flag(spark, folder):
    """Two measures in one pass; groups past 1,000 distinct values are ranked bin by bin."""
    price, net = F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return exact_percentiles(
        read(spark, folder, "lineitem"), ["l_returnflag", "l_suppkey"],
        {"median_price": (price, 0.5), "p95_price": (price, 0.95), "median_net": (net, 0.5)},
        wide_group=1_000)


@registered
def dear_orders(spark, folder):
    """Orders above the 97th percentile of all order prices."""
    orders = with_overall_percentile(read(spark, folder, "orders"), "o_totalprice", 0.97, "p97")
    return orders.where("o_totalprice > p97").select("o_orderkey", "o_totalprice", "p97")


# Column functions.

@registered
def width_bucket_prices(spark, folder):
    bucket = numbers.width_bucket(F.col("l_extendedprice"), 10000, 90000, 8)
    return read(spark, folder, "lineitem").groupBy(bucket.cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_lines"))


@registered
def surrogate_key_orders(spark, folder):
    flagged = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return read(spark, folder, "orders").select(
        "o_orderkey", text.surrogate_key(F.col("o_orderkey")).alias("one_field"),
        text.surrogate_key(F.col("o_custkey"), flagged, F.col("o_orderpriority"))
        .alias("three_fields"))


@registered
def safe_add_lineitem(spark, folder):
    discount = F.nullif(F.col("l_discount"), F.lit(0.0))
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    return read(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.sum(numbers.safe_add(discount, tax, F.col("l_quantity"))).alias("safe_total"),
        F.count(discount + tax).alias("both_present"))


@registered
def url_breakdown_pages(spark, folder):
    url = F.col("url")
    return read(spark, folder, "pages").select(
        "page_id", text.url_host(url).alias("host"), text.url_path(url).alias("path"),
        text.url_parameter(url, "page").alias("page"), text.url_parameter(url, "ref").alias("ref"))


@registered
def text_functions_events(spark, folder):
    props = F.col("props")
    number = text.split_part(text.split_part(props, F.lit(": "), 2), F.lit("}"), 1)
    return read(spark, folder, "events").select(
        "event_id", F.length("event_type").alias("type_length"),
        text.position_of(F.lit("r"), F.col("event_type")).alias("r_at"),
        F.replace("event_type", F.lit("e"), F.lit("")).alias("no_e"),
        text.right_text(props, F.lit(4)).alias("props_end"),
        text.safe_cast(number, "int").alias("k"),
        text.safe_cast(F.col("event_type"), "int").alias("not_a_number"),
        text.bool_text(F.col("value") > 50).alias("is_large"),
        text.concat_text(F.col("event_type"), F.lit("#"), F.nullif(F.col("user_id"), F.lit(8)))
        .alias("label"),
        text.md5_text(F.col("event_id")).alias("hashed"))


@registered
def array_functions_embeddings(spark, folder):
    pair = arrays.array_of(F.col("vec_id"), F.col("label").cast("bigint"))
    return read(spark, folder, "embeddings").select(
        "vec_id", arrays.array_text(pair).alias("pair"),
        arrays.array_text(arrays.array_with(pair, F.col("vec_id") + 1)).alias("appended"),
        arrays.array_text(arrays.arrays_joined(pair, pair)).alias("joined"),
        F.size(arrays.present_only(F.nullif(F.col("label"), F.lit(0)), F.col("label")))
        .alias("n_present"))


@registered
def datediff_boundaries_orders(spark, folder):
    start = F.col("o_orderdate")
    end = dates.add_interval("minute", (F.col("o_orderkey") * 37) % 900000 - 200000, start)
    return read(spark, folder, "orders").withColumn("later", end).select(
        "o_orderkey",
        *[dates.boundaries_between(start, F.col("later"), part).alias(f"{part}s")
          for part in dates.PARTS])


@registered
def date_parts_events(spark, folder):
    ts = F.col("ts")
    return read(spark, folder, "events").select(
        "event_id",
        *[dates.truncate(part, ts).alias(f"{part}_start")
          for part in ("year", "quarter", "month", "week", "day", "hour", "minute")],
        dates.add_interval("month", F.lit(1), ts).alias("next_month"),
        dates.add_interval("hour", F.lit(-5), ts).alias("earlier"))


@registered
def last_day_orders(spark, folder):
    day = F.col("o_orderdate")
    return read(spark, folder, "orders").select("o_orderkey", *[
        dates.last_day_of(day, part).alias(f"{part}_end") for part in ("month", "quarter", "year")])


@registered
def haversine_routes(spark, folder):
    tables = fare_tables(spark, folder)
    routes = tables.staged.groupBy("origin", "destination").agg(
        F.count(F.lit(1)).alias("n_bookings"))
    ends = [F.col(c) for c in ("origin_lat", "origin_lon", "destination_lat", "destination_lon")]
    return with_airports(routes, tables.airports, "origin", "destination").select(
        "origin", "destination", "n_bookings",
        geo.haversine_distance(*ends).alias("miles"),
        geo.haversine_distance(*ends, unit="km").alias("km"))


@registered
def period_load_events(spark, folder):
    """Three loads into a new table: each goes on from where the one before stopped, the last finds nothing new."""
    events = read(spark, folder, "events").select("event_id", "ts", "event_type")
    target = RunFolder(spark).path("events_by_week")
    load_by_period(events, target, "ts", "week", "2024-01-03", "2024-01-15 12:00:00")
    load_by_period(events, target, "ts", "week", "2024-01-03", "2024-01-25")
    return load_by_period(events, target, "ts", "week", "2024-01-03", "2024-01-25")


# Checks; each returns what it finds.

@registered
def dq_not_null(spark, folder):
    return checks.not_null(fare_tables(spark, folder).staged, "usd_per_mi").select(
        "legid", "route", "total_miles")


@registered
def dq_unique(spark, folder):
    return checks.unique(read(spark, folder, "orders"), "o_custkey", "o_orderstatus <> 'P'")


@registered
def dq_unique_combination(spark, folder):
    return checks.unique_combination_of_columns(
        read(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@registered
def dq_accepted_values(spark, folder):
    return checks.accepted_values(read(spark, folder, "orders"), "o_orderstatus", ["O", "F"])


@registered
def dq_not_accepted_values(spark, folder):
    return checks.not_accepted_values(
        read(spark, folder, "events"), "event_type", ["error", "refund"])


@registered
def dq_accepted_range(spark, folder):
    return checks.accepted_range(
        read(spark, folder, "lineitem"), "l_discount", 0.0, 0.1, inclusive=False
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")


@registered
def dq_expression_is_true(spark, folder):
    return checks.expression_is_true(
        read(spark, folder, "orders"), "> 50000", column="o_totalprice", where="o_orderstatus = 'F'"
    ).select("o_orderkey", "o_totalprice")


@registered
def dq_at_least_one(spark, folder):
    return checks.at_least_one(
        read(spark, folder, "events").withColumn("refund", F.nullif("value", "value")), "refund")


@registered
def dq_not_constant(spark, folder):
    return checks.not_constant(
        read(spark, folder, "embeddings").select(F.size("embedding").alias("width")), "width")


@registered
def dq_not_null_proportion(spark, folder):
    return checks.not_null_proportion(fare_tables(spark, folder).staged, "usd_per_mi", 0.99)


@registered
def dq_recency(spark, folder):
    now = F.lit("2024-02-15 00:00:00").cast("timestamp_ntz")
    return checks.recency(read(spark, folder, "events"), "ts", "day", 7, now=now)


@registered
def dq_equal_rowcount(spark, folder):
    return checks.equal_rowcount(read(spark, folder, "orders"), read(spark, folder, "lineitem"))


@registered
def dq_fewer_rows_than(spark, folder):
    return checks.fewer_rows_than(read(spark, folder, "lineitem"), read(spark, folder, "orders"))


@registered
def dq_equality(spark, folder):
    customer = read(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"), (F.col("c_acctbal") > 0).alias("in_credit"))
    supplier = read(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation"), (F.col("s_acctbal") > 0).alias("in_credit"))
    return checks.equality(customer, supplier)


@registered
def dq_equality_strict(spark, folder):
    """Rows whose number differs count, too."""
    customer = read(spark, folder, "customer").select(F.col("c_nationkey").alias("nation"))
    supplier = read(spark, folder, "supplier").select(F.col("s_nationkey").alias("nation"))
    return checks.equality(customer, supplier, strict=True)


@registered
def dq_helpers(spark, folder):
    """Empty texts, unequal columns and differing sets of column names, counted by check."""
    blanked = read(spark, folder, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment")))
    lines = read(spark, folder, "lineitem").withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.02)))
    missing, excess = checks.columns_match_set(blanked, ["C_CUSTKEY", "c_name", "c_phone"])
    names = [("missing", n) for n in sorted(missing)] + [("excess", n) for n in sorted(excess)]
    rows = read(spark, folder, "customer").agg(F.count(F.lit(1)).alias("n_rows"))
    return checks.summarise([
        checks.Outcome("not_empty_string", "customer", checks.not_empty_string(blanked, "c_mktsegment")),
        checks.Outcome("columns_equal", "lineitem", checks.columns_equal(lines, "l_discount", "l_tax")),
    ]).unionByName(rows.select(F.explode(F.array(*[
        F.struct(F.lit(f"{side}_column").alias("check"), F.lit(name).alias("relation"), F.col("n_rows").alias("failures"))
        for side, name in names])).alias("x")).select("x.*"))


@registered
def dq_recency_now(spark, folder):
    """Against the current time: the events are older than a day, and not from the future."""
    found = checks.recency(read(spark, folder, "events"), "ts", "day", 1)
    return found.select("most_recent", (F.col("threshold") > F.lit("2025-01-01").cast("timestamp_ntz")).alias("is_current"))


@registered
def dq_cardinality_equality(spark, folder):
    return checks.cardinality_equality(
        read(spark, folder, "customer"), "c_nationkey",
        read(spark, folder, "supplier"), "s_nationkey")


@registered
def dq_relationships_where(spark, folder):
    return checks.relationships_where(
        read(spark, folder, "orders"), "o_custkey", read(spark, folder, "supplier"), "s_suppkey",
        from_condition="o_totalprice > 100000", to_condition="s_acctbal > 0")


@registered
def dq_sequential_values(spark, folder):
    days = read(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return checks.sequential_values(days, "day", 1, "day")


@registered
def dq_sequential_numbers(spark, folder):
    return checks.sequential_values(read(spark, folder, "lineitem"), "l_suppkey", 1)


@registered
def dq_mutually_exclusive_ranges(spark, folder):
    return checks.mutually_exclusive_ranges(
        read(spark, folder, "orders").select(
            "o_custkey", F.col("o_orderdate").cast("date").alias("opened"),
            F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 90).cast("int"))
            .alias("closed")),
        "opened", "closed", partition_by="o_custkey", gaps="allowed")


@registered
def dq_mutually_exclusive_ranges_unpartitioned(spark, folder):
    return checks.mutually_exclusive_ranges(
        read(spark, folder, "orders"), "o_orderkey", "o_orderkey + o_custkey % 3",
        gaps="not_allowed", zero_length_range_allowed=True)


@registered
def dq_fare_tables(spark, folder):
    return fare_tables(spark, folder).table_check_summary()


def table_queries() -> dict[str, Query]:
    return dict(QUERIES)
