"""Staging, benchmarks, rules and marts on hand-made bookings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareflow import FareParams, FareTables
from fareflow.plans.marts import alerts, routes
from fareflow.sources.fares import RAW_FARE_SCHEMA
from fareflow.sources.tables import RunFolder


def fare(legid, org="LAX", dst="SEA", carrier="AA", fare=200.0, miles=1000.0, **other):
    row = dict(
        legid=legid, searchdate="2022-04-16", flightdate="2022-04-20", totalfare=fare,
        basefare=fare - 20 if fare else None, seatsremaining=5.0, isnonstop=True,
        isbasiceconomy=False, isrefundable=False, farebasiscode="YA0", totaltraveldistance=miles,
        travelduration="PT3H", segmentsdepartureairportcode=org, segmentsarrivalairportcode=dst,
        segmentsairlinecode=carrier, segmentsdistance="954", segmentsdurationinseconds="9000",
        segmentsequipmentdescription="Jet", segmentscabincode="coach")
    return {**row, **other}


def raw(spark, fares):
    names = [f.split()[0] for f in RAW_FARE_SCHEMA.replace("\n", " ").strip().split(",")]
    return spark.createDataFrame([tuple(f[n] for n in names) for f in fares], RAW_FARE_SCHEMA)


@pytest.fixture(scope="module")
def build(spark, tmp_path_factory):
    def make(fares, **options):
        folder = RunFolder(spark, str(tmp_path_factory.mktemp("t")))
        return FareTables(raw(spark, fares), folder=folder, **options)
    return make


def staged(tables, legid):
    return tables.stg_fare_searches().where(F.col("legid") == legid).first()


def test_hand_worked_bookings(build):
    tables = build([
        fare("ok", fare=199.5, miles=1000.4),
        fare("far", miles=5000.0),
        fare("none", miles=None),
        fare("unknown", dst="ZZZ", miles=700.0),
        fare("lost", dst="ZZZ", miles=None),
        fare("loop", dst="LAX"),
        fare("quoted", org='"LAX"||"BDL"', dst='"BDL"||"SEA"', carrier='"AA"||"DL"'),
        fare("no origin", org=None),
        fare("late", flightdate="2022-04-15"),
        fare("bad date", flightdate="soon"),
        fare("no fare", fare=None),
        fare("no date", searchdate=None),
        fare("seats", seatsremaining=None, farebasiscode="1X"),
        fare("sold out", seatsremaining=0.0, farebasiscode=" qx"),
        fare("same day", flightdate="2022-04-16"),
    ])
    got = {r["legid"]: r for r in tables.stg_fare_searches().collect()}
    assert set(got) == {"ok", "far", "none", "unknown", "lost", "loop", "quoted", "no origin",
                        "seats", "sold out", "same day"}
    ok = got["ok"]
    # Half a unit rounds up; miles up to twice the great circle are believed.
    assert (ok["total_fare"], ok["base_fare"], ok["total_miles"]) == (200.0, 180.0, 1000.0)
    assert ok["usd_per_mi"] == pytest.approx(0.2) and ok["days_to_flight"] == 4
    assert (ok["route"], ok["fare_bucket"], ok["seats_flag"]) == ("LAX-SEA", "full_mid_econ", "scarce")
    great_circle = got["none"]["total_miles"]
    assert great_circle == pytest.approx(954 * 1.02, rel=0.01) and got["far"]["total_miles"] == great_circle
    assert got["unknown"]["total_miles"] == 700.0
    assert got["lost"]["total_miles"] is None and got["lost"]["usd_per_mi"] is None
    assert got["loop"]["total_miles"] == 0.0 and got["loop"]["usd_per_mi"] is None
    quoted = got["quoted"]
    assert (quoted["origin"], quoted["destination"], quoted["marketing_carrier"]) == ("LAX", "SEA", "AA")
    assert got["no origin"]["route"] is None
    assert (got["seats"]["seats_flag"], got["seats"]["fare_bucket"]) == ("9plus", None)
    assert (got["sold out"]["seats_flag"], got["sold out"]["fare_bucket"]) == ("sold_out", "full_mid_econ")
    assert got["same day"]["days_to_flight"] == 0


def test_cents_can_be_kept(build):
    tables = build([fare("a", fare=199.456)], params=FareParams(fare_scale=2))
    assert staged(tables, "a")["total_fare"] == 199.46


def test_legs(build, rows):
    tables = build([
        fare("two", org="LAX||BDL", dst="BDL||SEA", carrier='"AA"||"DL"', segmentsdistance="100||None",
             segmentsdurationinseconds="60"),
        fare("none", org=None), fare("one"),
    ])
    assert rows(tables.int_fare_legs()) == [
        ("one", 1, "LAX", "SEA", "AA", 954, 9000),
        ("two", 1, "LAX", "BDL", "AA", 100, 60), ("two", 2, "BDL", "SEA", "DL", None, None)]


def test_competition(build, rows):
    fares = [fare(f"a{i}") for i in range(3)] + [fare("d", carrier="DL")]
    fares += [fare("m", dst="MIA", carrier="UA"), fare("x", dst="PHL", carrier=None)]
    got = rows(build(fares).int_route_competition())
    assert got == [("LAX-MIA", 1, 1.0), ("LAX-SEA", 2, (9 + 1) / 16)]


def _market(n=40):
    """A monopoly route with rising prices, a shared one, and bookings without a bucket."""
    fares = [fare(f"m{i}", dst="MIA", carrier="AA", fare=100.0 + i, miles=2000.0) for i in range(n)]
    fares += [fare(f"s{i}", carrier="AA" if i % 2 else "DL", fare=150.0 + 3 * i,
                   seatsremaining=float(i % 10), flightdate=f"2022-04-{16 + i % 9}") for i in range(n)]
    fares += [fare(f"n{i}", farebasiscode="1", fare=90.0 + i) for i in range(10)]
    fares += [fare("q", carrier="QQ", fare=999.0), fare("z", carrier=None, fare=500.0),
              fare("o", org=None, fare=700.0), fare("f", dst="ZZZ", miles=None)]
    return fares


@pytest.fixture(scope="module")
def market(build):
    return build(_market(), params=FareParams(min_route_bookings=5))


def test_rules(market):
    hub = {r["legid"]: r for r in market.pricing_features().collect()}
    assert len(hub) == len(_market())
    top = hub["m39"]
    assert (top["r1_price_outlier"], top["r2_seat_scarcity"], top["r3_monopoly_premium"]) == (1, 1, 1)
    assert hub["s39"]["r3_monopoly_premium"] == 0 and hub["m20"]["any_rule_flag"] == 0
    # No bucket, no benchmark, no rule; an unknown distance has no price per mile.
    assert hub["n9"]["p50_usd_per_mi"] is None and hub["n9"]["any_rule_flag"] == 0
    assert hub["f"]["usd_per_mi"] is None and hub["f"]["any_rule_flag"] == 0
    assert hub["o"]["hhi"] is None and hub["o"]["route"] is None
    for r in hub.values():
        flags = [r["r1_price_outlier"], r["r2_seat_scarcity"], r["r3_monopoly_premium"]]
        assert set(flags) <= {0, 1} and r["any_rule_flag"] == max(flags)
        if r["hhi"] is not None:
            assert 1 / r["carrier_count"] <= r["hhi"] + 1e-12 <= 1 + 1e-9
        if r["p50_usd_per_mi"] is not None:
            assert (r["p50_usd_per_mi"] <= r["p90_usd_per_mi"] <= r["p95_usd_per_mi"]
                    <= r["p97_usd_per_mi"])


def test_a_longer_airport_list_adds_distances(market, spark):
    from fareflow.plans.features import pricing_features
    longer = market.airports.union(spark.sql("SELECT 'ZZZ', 40.0D, -80.0D"))
    hub = pricing_features(market.staged, market.benchmarks, market.competition, longer)
    assert hub.where("legid = 'f'").first()["trip_dist"] > 1500
    same = pricing_features(market.staged, market.benchmarks, market.competition, market.airports)
    assert same.exceptAll(market.features).count() == 0


def test_reading_order(market):
    assert [r["dtf_sort_order"] for r in market.presented("crosstab_summary").collect()] == [
        i for i in (1, 2, 3, 4) for _ in range(3)]
    days = [r["flight_date"] for r in market.presented("timeseries_metrics").collect()]
    assert days == sorted(days)
    assert market.presented("route_map_data").count() == 2


def test_windowed_rules_agree_where_a_bucket_is_known(market):
    hub = {r["legid"]: r for r in market.pricing_features().collect()}
    ruled = market.int_rules().collect()
    assert len(ruled) == len(hub)
    for r in ruled:
        if r["fare_bucket"] is not None and r["route"] is not None:
            assert r["r2_seat_scarcity_flag"] == hub[r["legid"]]["r2_seat_scarcity"]
            assert r["any_rule_flag"] == hub[r["legid"]]["any_rule_flag"]
    # The NULL bucket has a percentile of its own there, but no other benchmark.
    unbucketed = {r["legid"]: r for r in ruled if r["fare_bucket"] is None}
    assert unbucketed["n9"]["r2_seat_scarcity_flag"] == 1 and unbucketed["n9"]["p90_usd_per_mi"] is None


def test_any_percentile_can_be_asked_for(build):
    loose = build(_market(), params=FareParams(r2_percentile=0.25))
    strict = build(_market(), params=FareParams(r2_percentile=0.99))

    def flagged(t):
        return t.pricing_features().agg(F.sum("r2_seat_scarcity")).first()[0]

    assert flagged(loose) > flagged(strict) > 0
    assert "r2_usd_per_mi" not in loose.stg_route_stats().columns


def test_totals_agree(market):
    n = len(_market())
    for table in (market.booking_window_analysis(), market.timeseries_metrics(), market.carrier_summary()):
        assert table.agg(F.sum("total_bookings")).first()[0] == n
    kpis = market.dashboard_kpis().first()
    assert kpis["total_bookings"] == n
    alerts_ = market.pricing_alerts().collect()
    assert len(alerts_) == kpis["total_any_alerts"] == market.flagged_extra_costs().count()
    for a in alerts_:
        assert a["flag_list"] and len(a["flag_list"]) == (
            a["flag_price_outlier"] + a["flag_seat_scarcity"] + a["flag_monopoly"])
    summary = market.extra_cost_summary().first()
    assert summary["total_extra_cost"] == kpis["total_extra_cost_usd"] >= 0


def test_crosstab_is_complete(market, build):
    got = market.crosstab_summary().collect()
    cells = [(r["dtf_bucket"], r["fare_bucket"]) for r in got]
    assert len(cells) == len(set(cells)) == 12
    empty = [r for r in got if r["total_bookings"] == 0]
    assert empty and all(r["avg_fare"] is None and r["top_carrier_share"] == 0.0
                         and r["volume_category"] == "Minimal Volume" for r in empty)
    assert sum(r["total_bookings"] for r in got) == len([f for f in _market() if f["farebasiscode"] != "1"])


def test_carriers_without_code_or_name(market):
    got = {r["carrier_code"]: r for r in market.carrier_summary().collect()}
    assert set(got) == {"AA", "DL", "QQ", None}
    assert got["QQ"]["carrier_name"] is None
    assert got[None]["total_extra_cost"] == 0.0 and got[None]["full_violation_rate"] is None
    assert sum(r["market_share_bookings"] for r in got.values()) == pytest.approx(100)
    assert {r["carrier_code"] for r in market.carrier_performance().collect()} == {"AA", "DL"}


def test_concentration_labels(spark, rows):
    from fareflow.functions.bands import concentration_level
    df = spark.createDataFrame([(0.9,), (0.6,), (0.2,), (None,)], "h double")
    assert {r[0]: r[1] for r in rows(df.select("h", concentration_level(F.col("h"))))} == {
        0.9: "High Concentration", 0.6: "Moderate Concentration", 0.2: "Low Concentration",
        None: "Low Concentration"}


def _literal_join(market, key, drop_null_route):
    """The many-to-many join the pairwise figures stand for, with all its rows."""
    hub = market.features
    keys = ["route", "carrier_code", "dtf_bucket", "flight_date"]
    medians = hub.select(*keys).join(market.daily.select(*keys, "median_fare"), keys, "left").select(
        F.col("route").alias("r"), F.col("carrier_code").alias("c"), "median_fare")
    joined = hub.join(medians, (F.col("route") == F.col("r")) & (F.col("carrier_code") == F.col("c")), "left")
    if drop_null_route:
        joined = joined.where("route IS NOT NULL")
    return {r[key]: r for r in joined.groupBy(key).agg(
        F.count("*").alias("total_bookings"), F.sum("any_rule_flag").alias("flagged_bookings"),
        F.avg("total_fare").alias("avg_fare"), F.median("total_fare").alias("median_fare"),
        F.expr("sum(CASE WHEN any_rule_flag = 1 AND median_fare IS NOT NULL "
               "THEN total_fare - median_fare ELSE 0 END)").alias("total_extra_cost"),
    ).collect()}


@pytest.mark.parametrize("table,key", [("route_performance", "route"),
                                       ("carrier_performance", "carrier_code")])
def test_pairwise_equals_the_literal_join(market, table, key):
    expected = _literal_join(market, key, key == "route")
    got = getattr(market, table)(pairwise=True).collect()
    assert got
    for r in got:
        e = expected[r[key]]
        for c in ("total_bookings", "flagged_bookings", "avg_fare", "median_fare", "total_extra_cost"):
            assert r[c] == pytest.approx(e[c]), (r[key], c)


def test_route_tables(market):
    by_route = {r["route"]: r for r in market.route_performance().collect()}
    assert by_route["LAX-SEA"]["serving_carriers"] == ["AA", "DL", "QQ"]
    assert by_route["LAX-ZZZ"]["destination_lat"] is None and None not in by_route
    assert {r["route"] for r in market.route_geographic().collect()} == {"LAX-MIA", "LAX-SEA"}
    summary = {r["route"]: r for r in market.route_summary().collect()}
    assert set(summary) == {"LAX-MIA", "LAX-SEA"}
    assert summary["LAX-MIA"]["is_monopoly_route"] == 1 and summary["LAX-SEA"]["serving_carriers"] == "AA,DL,QQ"
    assert sum(r["alert_rate_vs_avg"] for r in summary.values()) == pytest.approx(0)
    few = routes.route_geographic(market.features, market.coordinates, FareParams(min_route_bookings=45))
    assert [r["route"] for r in few.collect()] == ["LAX-SEA"]


def test_kpis_with_repeated_ids(build):
    tables = build(_market() + [fare("m39", dst="MIA", carrier="AA", fare=180.0, miles=2000.0),
                                fare(None), fare(None)])
    stg, hub, extra = tables.staged, tables.features, tables.flagged_extra_costs()
    literal = stg.select("legid").join(hub.select("legid", "any_rule_flag"), "legid", "left").join(
        extra.select("legid", "extra_cost"), "legid", "left").agg(
        F.count("*").alias("n"), F.sum("any_rule_flag").alias("a"), F.sum("extra_cost").alias("c")).first()
    got = alerts.dashboard_kpis_pairwise(stg, hub, extra).first()
    assert (got["total_bookings"], got["total_any_alerts"], got["total_extra_cost_usd"]) == (
        literal["n"], literal["a"], literal["c"])
    assert tables.dashboard_kpis().first()["total_bookings"] == len(_market()) + 3


def test_table_checks(market):
    got = {(r["check"], r["relation"]): r["failures"] for r in market.table_check_summary().collect()}
    assert len(got) == 19
    assert got["unique_legid", "stg_fare_searches"] == 0
    assert got["not_null_usd_per_mi", "stg_fare_searches"] == 1
    assert got["not_null_fare_bucket", "stg_route_stats"] == 1
    assert got["equal_rowcount", "stg_fare_searches"] == 0


def test_shared_tables_are_written_once(market):
    assert market.features is market.features
    assert market.features.inputFiles()[0].startswith("file:" + market.folder.folder) or \
        market.folder.folder in market.features.inputFiles()[0]
    assert isinstance(market.dim_carrier().first()["carrier_name"], str)
    assert staged(market, "m0")["search_date"] == dt.date(2022, 4, 16)
