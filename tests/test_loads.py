import datetime as dt

import pytest

from fareflow.sources import seeds, tables
from fareflow.sources.fares import RAW_FARE_SCHEMA, read_fares
from fareflow.sources.periods import load_by_period


@pytest.fixture
def source(spark):
    months = [(2017, 12)] + [(2018, m) for m in range(1, 9)]
    return spark.createDataFrame(
        [(i, dt.datetime(y, m, 2)) for i, (y, m) in enumerate(months, start=1)],
        "id int, created_at timestamp_ntz")


def test_period_load(spark, source, rows, tmp_path):
    target = str(tmp_path / "t")
    got = load_by_period(source, target, "created_at", "month", "2018-01-01", "2018-06-01")
    assert rows(got, "id") == [(2,), (3,), (4,), (5,), (6,)] and got.columns == source.columns
    # Nothing new up to the same end; then on from where it stopped.
    load_by_period(source, target, "created_at", "month", "2018-01-01", "2018-06-01")
    again = load_by_period(source, target, "created_at", "month", "2018-01-01", "2018-08-02")
    assert rows(again, "id") == [(i,) for i in range(2, 9)]


def test_bounds_are_exclusive(spark, source, rows, tmp_path):
    got = load_by_period(source, str(tmp_path / "t"), "created_at", "week", "2018-01-02", "2018-03-02")
    assert rows(got, "id") == [(3,)]


def test_a_load_that_breaks_off_leaves_nothing_visible(spark, source, rows, tmp_path, monkeypatch):
    from fareflow.sources import periods

    target = str(tmp_path / "t")
    load_by_period(source, target, "created_at", "quarter", "2018-01-01", "2018-02-15")
    # The second load has written its rows, wrong ones among them, when it ends before its log row.
    wrong = source.withColumn("id", source["id"] + 100)
    with monkeypatch.context() as broken:
        broken.setattr(periods, "LOG_SCHEMA", "no schema at all")
        broken.setattr(periods, "last_mark", lambda *a: periods.Mark(1, "2018-02-02 00:00:00"))
        with pytest.raises(Exception):
            load_by_period(wrong, target, "created_at", "quarter", "2018-01-01", "2018-06-01")
    assert rows(periods.loaded_rows(source, target), "id") == [(2,), (3,)]
    got = load_by_period(source, target, "created_at", "quarter", "2018-01-01", "2018-06-01")
    assert rows(got, "id") == [(i,) for i in range(2, 7)]
    log = rows(periods.read_log(spark, target))
    assert [(r[0], r[4]) for r in log] == [(1, 2), (2, 3)] and log[1][1] == "2018-02-02 00:00:00"


def test_late_rows_and_loads_without_rows(spark, source, rows, tmp_path):
    from fareflow.sources import periods

    target = str(tmp_path / "t")
    load_by_period(source, target, "created_at", "month", "2018-01-01", "2018-04-01")
    late = source.unionByName(spark.createDataFrame([(50, dt.datetime(2018, 2, 20))], source.schema))
    for stop in ("2018-04-01", "2018-05-01", "2018-05-01"):
        got = load_by_period(late, target, "created_at", "month", "2018-01-01", stop)
    assert rows(got, "id") == [(i,) for i in range(2, 6)]
    assert [(r[0], r[4]) for r in rows(periods.read_log(spark, target))] == [(1, 3), (2, 0), (3, 1), (4, 0)]
    # The log alone tells where to go on.
    assert periods.last_mark(spark, target) == (4, "2018-04-02 00:00:00")


def test_a_load_reads_no_loaded_rows(spark, source, tmp_path):
    from fareflow.sources import periods

    target = str(tmp_path / "t")
    got = load_by_period(source, target, "created_at", "month", "2018-01-01", "2018-04-01")
    assert "log" in str(periods.read_log(spark, target).inputFiles()[0])
    assert "PartitionFilters: [isnotnull(load_number" in got._jdf.queryExecution().executedPlan().toString()


def test_tables(spark, source, rows, tmp_path):
    folder = tables.RunFolder(spark, str(tmp_path))
    assert folder.folder != tables.RunFolder(spark, str(tmp_path)).folder
    back = folder.write("t", source, partition_by=["id"])
    assert rows(back) == rows(source)
    assert tables.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_lists(spark, rows, tmp_path):
    assert seeds.carriers(spark).count() == 14 and seeds.airports(spark).count() == 24
    assert seeds.fare_classes(spark).count() == 26
    path = tmp_path / "places.csv"
    path.write_text("iata_code;latitude;longitude\nlax;34.5;-118.0\nJFK;40.6;-73.8\n;1;1\nXXX;;5\n")
    merged = seeds.merged_coordinates(
        seeds.airports(spark), seeds.airport_coordinates(spark, str(path)))
    by_code = {r[0]: r[1:] for r in rows(merged)}
    # A place is taken whole from one list, the own one first.
    own = {r.iata_code: (r.lat_deg, r.lon_deg) for r in seeds.airports(spark).collect()}
    assert by_code["LAX"] == own["LAX"] and by_code["JFK"] == (40.6, -73.8)
    assert len(by_code) == 25
    assert seeds.airport_coordinates(spark).count() == 0


def test_raw_fares_have_a_declared_schema(spark, tmp_path):
    spark.createDataFrame([("L1", "x")], "legid string, more string").write.parquet(str(tmp_path / "r"))
    got = read_fares(spark, str(tmp_path / "r"))
    assert len(got.columns) == RAW_FARE_SCHEMA.count(",") + 1
    assert got.first()["totalfare"] is None
