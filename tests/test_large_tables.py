"""What the shared build moves, stores and deals out where the tables are large."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from fareflow.sources import fares, tables
from fareflow.sources.fares import fares_from_folder
from fareflow.sources.tables import RunFolder, dealt, plan_bytes


def write_orders(spark, path):
    spark.sql("""SELECT id DIV 3 AS l_orderkey, id AS l_partkey, id % 4 AS l_suppkey, cast(id % 3 AS int) AS l_linenumber, 5D AS l_quantity,
        100D AS l_extendedprice, 0.1D AS l_tax, 'R' AS l_returnflag, 'F' AS l_linestatus,
        timestamp_ntz'2020-01-01' AS l_shipdate FROM range(30)""").write.parquet(f"{path}/lineitem.parquet")
    spark.sql("SELECT id AS o_orderkey, id % 5 AS o_custkey FROM range(10)").write.parquet(f"{path}/orders.parquet")
    spark.sql("SELECT id AS c_custkey, id AS c_nationkey FROM range(5)").write.parquet(f"{path}/customer.parquet")
    spark.sql("SELECT id AS s_suppkey, id AS s_nationkey FROM range(4)").write.parquet(f"{path}/supplier.parquet")


def test_a_line_moves_once_also_where_no_table_is_broadcast_by_size(spark, tmp_path):
    write_orders(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fares = fares_from_folder(spark, str(tmp_path))
        text = fares._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning(l_") == 1
        assert fares.count() == 30 and fares.select("legid").distinct().count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_a_large_table_go_to_more_tasks(spark):
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(1000).withColumn("k", F.col("id") % 100)

    def tasks(stored):
        return dealt(df, stored, "k").rdd.getNumPartitions()

    assert tasks(0) <= session
    assert tasks(tables.PART_BYTES * (session + 3)) == session + 3
    assert sorted(dealt(df, tables.PART_BYTES * 9, "k").collect()) == sorted(df.collect())


def test_stored_tables_keep_their_rows_under_another_codec(spark, tmp_path):
    df = spark.range(20_000).selectExpr("concat_ws('-', id, id * 7919 % 20011, id * 104729 % 2000003) AS legid")
    plain = RunFolder(spark, str(tmp_path / "a")).write("t", df)
    small = RunFolder(spark, str(tmp_path / "b"), compression="zstd").write("t", df)
    assert sorted(small.collect()) == sorted(plain.collect())
    assert tables.plan_bytes(small) < 0.8 * tables.plan_bytes(plain)


def test_fares_are_built_by_as_many_tasks_as_asked_for(spark, tmp_path, monkeypatch):
    write_orders(spark, str(tmp_path))
    stored = plan_bytes(spark.read.parquet(f"{tmp_path}/lineitem.parquet"))
    asked = spark.sparkContext.defaultParallelism + 3
    monkeypatch.setattr(fares, "WIDENED_PART_BYTES", -(-stored // asked))
    # Up to the session's number Spark would merge parts; here the lines must be what the tables are joined to.
    options = {"spark.sql.shuffle.partitions": str(asked), "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        built = fares_from_folder(spark, str(tmp_path))
        assert built.count() == 30 and built.rdd.getNumPartitions() == asked
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_dates_and_cents_of_fares(spark):
    """All remainders of both keys, also of keys below 0 and null ones, and prices on half a cent."""
    orders = spark.sql("SELECT id AS o_orderkey, 0L AS o_custkey FROM range(-13, 14)")
    lines = orders.selectExpr(
        "o_orderkey AS l_orderkey", "explode(array_append(sequence(-63L, 63L), NULL)) AS l_partkey", "0L AS l_suppkey",
        "1 AS l_linenumber", "5D AS l_quantity", "IF(l_partkey < 0, -1, 1) * 0.125D AS l_extendedprice", "0D AS l_tax",
        "'R' AS l_returnflag", "'F' AS l_linestatus", "timestamp_ntz'2020-01-01' AS l_shipdate")
    got = fares.fares_from_orders(
        lines, orders, spark.sql("SELECT 0L AS c_custkey, 1 AS c_nationkey"), spark.sql("SELECT 0L AS s_suppkey, 1 AS s_nationkey"))
    assert "date_add" not in got._jdf.queryExecution().executedPlan().toString()
    found = {r[:2]: r[2:] for r in got.selectExpr(
        "regexp_extract(legid, '^(-?[0-9]+)-', 1)", "regexp_extract(legid, '^-?[0-9]+-1-(.+)-0-2020', 1)",
        "searchdate", "flightdate", "regexp_extract(legid, '2020-01-01-(.+)$', 1)").collect()}
    assert len(found) == 27 * 128
    for (order, part), (search, flight, cents) in found.items():
        day = date(2022, 4, 16) + timedelta(days=int(order))
        assert search == str(day)
        if part:
            assert flight == str(day + timedelta(days=int(part) - 4))
            assert cents == ("-13" if int(part) < 0 else "13")
        else:
            assert flight is None
