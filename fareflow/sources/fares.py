"""Raw searched fares: the declared schema, its reader, and the same columns from order tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareflow.functions import numbers
from fareflow.operators.joins import BROADCAST_BYTES
from fareflow.sources.tables import WIDENED_PART_BYTES, dealt, plan_bytes

RAW_FARE_SCHEMA = """
    legid string, searchdate string, flightdate string,
    totalfare double, basefare double, seatsremaining double,
    isnonstop boolean, isbasiceconomy boolean, isrefundable boolean,
    farebasiscode string, totaltraveldistance double, travelduration string,
    segmentsdepartureairportcode string, segmentsarrivalairportcode string,
    segmentsairlinecode string, segmentsdistance string, segmentsdurationinseconds string,
    segmentsequipmentdescription string, segmentscabincode string
"""


def read_fares(spark: SparkSession, path: str) -> DataFrame:
    """The raw fares from Parquet, with the declared schema (no inference)."""
    return spark.read.schema(RAW_FARE_SCHEMA).parquet(path)


# The airports and carriers order rows are mapped to. ZZZ and QQ are unknown
# on purpose, so that look-ups which find nothing are exercised.
ORDER_AIRPORTS = ("LAX", "DFW", "MIA", "SEA", "PHL", "DTW", "SLC", "ZZZ")
ORDER_CARRIERS = ("AA", "DL", "UA", "B6", "QQ")
CONNECTION = "BDL"
# Searches are spread over these days, and flights over days around a search; a key below 0 counts backwards.
FIRST_SEARCH, SEARCH_DAYS, FLIGHT_DAYS, FLIGHTS_FROM = date(2022, 4, 16), 14, 64, -4


def _pick(codes, index):
    return F.element_at(F.array(*[F.lit(c) for c in codes]), (index + 1).cast("int"))


def _day_text(offset, least, most):
    """The text of the first search day moved by ``offset`` days, from a list of all such texts; writing a date is slower."""
    days = [str(FIRST_SEARCH + timedelta(days=i)) for i in range(least, most + 1)]
    return F.when(offset.isNotNull(), _pick(days, offset - least))


def fares_from_orders(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, supplier: DataFrame
) -> DataFrame:
    """Searched fares in the raw schema, one per order line.

    Suppliers play the origin and customers the destination. Each side is narrowed to the
    columns used before it is joined; sizes decide how Spark joins them.
    """
    buyers = orders.select("o_orderkey", "o_custkey").join(
        customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "c_nationkey")
    sellers = supplier.select("s_suppkey", "s_nationkey")
    if plan_bytes(sellers) <= BROADCAST_BYTES:
        sellers = F.broadcast(sellers)
    lines = (
        lineitem.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumns({
            "a": F.col("s_nationkey") % 8,
            "b": F.col("c_nationkey") % 8,
        })
        .withColumns({
            "org": _pick(ORDER_AIRPORTS, F.col("a")),
            "dst": _pick(ORDER_AIRPORTS, F.col("b")),
            "car": _pick(
                ORDER_CARRIERS,
                F.when((F.col("a") + F.col("b")) % 5 == 0, 0).otherwise(F.col("l_suppkey") % 5),
            ),
            "two": F.col("l_linenumber") % 3 == 0,
            "search": F.col("l_orderkey") % SEARCH_DAYS,
        })
    )

    def legs(first, second, single):
        return F.when(F.col("two"), F.concat(first, F.lit("||"), second)).otherwise(single)

    def quoted(code):
        return F.when(F.col("l_suppkey") % 7 == 0, F.concat(F.lit('"'), code, F.lit('"'))) \
            .otherwise(code)

    def per_leg(value):
        text = F.when(F.col("l_orderkey") % 53 == 0, "None").otherwise(value.cast("string"))
        return legs(text, text, text)

    last_search = 1 - SEARCH_DAYS, SEARCH_DAYS - 1
    org, dst, car, hub = F.col("org"), F.col("dst"), F.col("car"), F.lit(CONNECTION)
    second_carrier = _pick(ORDER_CARRIERS, F.col("l_partkey") % 5)
    letter = F.when(F.col("l_partkey") % 28 >= 26, "1").otherwise(
        F.char((F.lit(65) + F.col("l_partkey") % 28).cast("int")))
    return lines.select(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_shipdate").cast("date").cast("string"),
            numbers.whole(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
        ).alias("legid"),
        _day_text(F.col("search"), *last_search).alias("searchdate"),
        _day_text(
            F.col("search") + F.col("l_partkey") % FLIGHT_DAYS + FLIGHTS_FROM,
            last_search[0] + FLIGHTS_FROM - FLIGHT_DAYS + 1, last_search[1] + FLIGHTS_FROM + FLIGHT_DAYS - 1,
        ).alias("flightdate"),
        (F.col("l_extendedprice") / 100 * (1 + F.col("l_tax"))).alias("totalfare"),
        F.when(F.col("l_orderkey") % 97 == 0, 0.0)
        .otherwise(F.col("l_extendedprice") / 100).alias("basefare"),
        F.when(F.col("l_orderkey") % 89 != 0, F.floor("l_quantity") % 11)
        .cast("double").alias("seatsremaining"),
        (~F.col("two")).alias("isnonstop"),
        (F.col("l_returnflag") == "R").alias("isbasiceconomy"),
        (F.col("l_linestatus") == "F").alias("isrefundable"),
        F.concat(letter, F.lit("A0AHEN")).alias("farebasiscode"),
        F.when(F.col("l_partkey") % 10 != 0, 200 + F.col("l_suppkey") * 37 % 2500)
        .cast("double").alias("totaltraveldistance"),
        F.lit("PT3H").alias("travelduration"),
        legs(org, hub, org).alias("segmentsdepartureairportcode"),
        legs(hub, dst, dst).alias("segmentsarrivalairportcode"),
        legs(quoted(car), quoted(second_carrier), quoted(car)).alias("segmentsairlinecode"),
        per_leg(F.col("l_partkey") % 900 + 100).alias("segmentsdistance"),
        per_leg((F.col("l_partkey") % 300 + 60) * 60).alias("segmentsdurationinseconds"),
        F.lit("Jet").alias("segmentsequipmentdescription"),
        F.lit("coach").alias("segmentscabincode"),
    )


def fares_from_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The order tables of one folder as raw fares."""
    def table(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    # The table is one row group here, which one task would read; it is spread whatever its size. The key is that of
    # the join with the orders, which then moves no line again.
    lines = table("lineitem")
    lines = dealt(lines, plan_bytes(lines), "l_orderkey", part_bytes=WIDENED_PART_BYTES, exactly=True)
    return fares_from_orders(lines, table("orders"), table("customer"), table("supplier"))
