import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareflow.functions import arrays, bands, dates, geo, numbers, text
from registry.compare import comparable


def one(spark, expression, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    data = [tuple(v for _, v in values.values())] if values else [(1,)]
    return spark.createDataFrame(data, schema).select(expression.alias("r")).first()["r"]


STRINGS = [
    ("md5", lambda: text.md5_text(F.col("a")), {"a": "ab"}, "187ef4436122d1cc2f40dc2b92f0eba0"),
    ("md5 empty", lambda: text.md5_text(F.col("a")), {"a": ""}, "d41d8cd98f00b204e9800998ecf8427e"),
    ("concat", lambda: text.concat_text(F.col("a"), F.col("b")), {"a": "a", "b": "b"}, "ab"),
    ("concat null", lambda: text.concat_text(F.col("a"), F.col("b")), {"a": "a", "b": None}, None),
    ("position", lambda: text.position_of(F.col("a"), F.col("b")), {"a": "town", "b": "fishtown"}, 5),
    ("no position", lambda: text.position_of(F.col("a"), F.col("b")), {"a": "land", "b": "earth"}, 0),
    ("right", lambda: text.right_text(F.col("a"), F.lit(4)), {"a": "fishtown"}, "town"),
    ("right none", lambda: text.right_text(F.col("a"), F.lit(0)), {"a": "december"}, ""),
    ("part", lambda: text.split_part(F.col("a"), F.lit("|"), 2), {"a": "a|b|c"}, "b"),
    ("cast", lambda: text.safe_cast(F.col("a"), "int"), {"a": "123"}, 123),
    ("no cast", lambda: text.safe_cast(F.col("a"), "int"), {"a": "abc"}, None),
    ("clean", lambda: text.clean_segment(F.col("a")), {"a": ' "AA" '}, "AA"),
    ("first", lambda: text.first_segment(F.col("a")), {"a": '"AA"||"DL"'}, "AA"),
    ("last", lambda: text.last_segment(F.col("a")), {"a": "BDL||SEA"}, "SEA"),
    ("last none", lambda: text.last_segment(F.col("a")), {"a": None}, None),
]


@pytest.mark.parametrize("name,build,values,expected", STRINGS, ids=[s[0] for s in STRINGS])
def test_text(spark, name, build, values, expected):
    assert one(spark, build(), **{k: ("string", v) for k, v in values.items()}) == expected


@pytest.mark.parametrize("fields,expected", [
    (("a", "b", "c"), "7b193b3d33184464106f41ddf733783b"),
    (("a", None, "c"), "c5fd1b92380c6222ab0ef67839208624"),
    ((None, None, "c"), "267743defab4558f1940311b66274e26"),
    ((None, None, None), "cfab1ba8c67c7c838db98d666f02a132"),
])
def test_surrogate_key(spark, fields, expected):
    values = {n: ("string", v) for n, v in zip("abc", fields)}
    assert one(spark, text.surrogate_key(F.col("a"), F.col("b"), F.col("c")), **values) == expected


QUERY = "utm_source=google&utm_medium=cpc&utm_campaign=spring-summer"
TIP = "2018/01/tips-tricks-how-run-half-marathon-first-time/"


@pytest.mark.parametrize("url,host,path", [
    (f"www.google.co.uk?{QUERY}", "www.google.co.uk", ""),
    (f"http://witanddelight.com/{TIP}", "witanddelight.com", TIP),
    (f"http://witanddelight.com/{TIP}?{QUERY}", "witanddelight.com", TIP),
    ("https://www.nytimes.com/2018/01/01/blog", "www.nytimes.com", "2018/01/01/blog"),
    ("https://m.facebook.com/", "m.facebook.com", ""),
])
def test_url_parts(spark, url, host, path):
    assert one(spark, text.url_host(F.col("u")), u=("string", url)) == host
    assert one(spark, text.url_path(F.col("u")), u=("string", url)) == path


def test_url_app_host_and_parameters(spark):
    assert one(spark, text.url_host(F.lit("android-app://m.facebook.com/"))) == "m.facebook.com"
    url = F.lit("http://drewbanin.com/milky?utm_medium=organic&utm_source=github")
    assert one(spark, text.url_parameter(url, "utm_medium")) == "organic"
    assert one(spark, text.url_parameter(url, "utm_source")) == "github"
    assert one(spark, text.url_parameter(url, "utm_term")) is None


@pytest.mark.parametrize("start,end,part,expected", [
    ("2018-01-01 01:00:00", "2018-01-02 01:00:00", "day", 1),
    ("2018-01-01 01:00:00", "2018-02-01 01:00:00", "month", 1),
    ("2018-01-31 01:00:00", "2018-02-01 00:00:00", "month", 1),
    ("2018-01-01 01:00:00", "2019-01-01 01:00:00", "year", 1),
    ("2018-03-31 01:00:00", "2018-04-01 00:00:00", "quarter", 1),
    ("2018-01-01 01:00:00", "2018-01-01 02:00:00", "hour", 1),
    ("2018-01-01 01:00:00", "2018-01-01 02:01:00", "minute", 61),
    ("2018-01-01 01:00:00", "2018-01-01 02:00:01", "second", 3601),
    ("2019-12-31 00:00:00", "2019-12-27 00:00:00", "week", -1),
    ("2019-12-31 00:00:00", "2019-12-30 00:00:00", "week", 0),
    ("2019-12-31 00:00:00", "2020-01-02 00:00:00", "week", 0),
    ("2019-12-31 00:00:00", "2020-01-06 02:00:00", "week", 1),
    # The clock change of the session's zone must not matter.
    ("2018-03-11 00:00:00", "2018-03-11 04:00:00", "hour", 4),
    (None, "2018-01-01 02:00:00", "hour", None),
    ("2018-01-01 02:00:00", None, "hour", None),
])
def test_boundaries_between(spark, start, end, part, expected):
    a, b = (F.lit(v).cast("timestamp_ntz") for v in (start, end))
    assert one(spark, dates.boundaries_between(a, b, part)) == expected


@pytest.mark.parametrize("amount,part,expected", [
    (1, "day", dt.datetime(2018, 1, 2, 1)), (1, "month", dt.datetime(2018, 2, 1, 1)),
    (1, "year", dt.datetime(2019, 1, 1, 1)), (1, "hour", dt.datetime(2018, 1, 1, 2)),
])
def test_add_interval(spark, amount, part, expected):
    ts = F.lit("2018-01-01 01:00:00").cast("timestamp_ntz")
    assert one(spark, dates.add_interval(part, F.lit(amount), ts)) == expected


def test_truncate_and_last_day(spark):
    ts = F.lit("2018-01-05 12:00:00").cast("timestamp_ntz")
    assert one(spark, dates.truncate("day", ts)) == dt.datetime(2018, 1, 5)
    assert one(spark, dates.truncate("month", ts)) == dt.datetime(2018, 1, 1)
    day = F.lit("2018-01-02").cast("date")
    ends = {"month": dt.date(2018, 1, 31), "quarter": dt.date(2018, 3, 31),
            "year": dt.date(2018, 12, 31)}
    for part, end in ends.items():
        assert one(spark, dates.last_day_of(day, part)) == end
    assert one(spark, dates.last_day_of(F.lit(None).cast("date"))) is None
    with pytest.raises(ValueError):
        dates.truncate("fortnight", ts)


def test_numbers(spark):
    assert one(spark, numbers.safe_add(F.col("a"), F.col("b")), a=("int", 1), b=("int", None)) == 1
    assert one(spark, numbers.safe_add(F.col("a"), F.col("b")), a=("int", None), b=("int", None)) == 0
    assert one(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert [one(spark, numbers.whole(F.lit(x))) for x in (0.5, 1.5, 2.5, -2.5)] == [1, 2, 3, -3]
    assert one(spark, numbers.whole(F.lit(0.49999999999999994))) == 0
    assert one(spark, numbers.whole(F.lit(None).cast("double"))) is None
    assert one(spark, numbers.whole(F.lit(1.235), 2)) == 1.24
    assert one(spark, numbers.rounded(F.lit(1.005))) == 1.01
    assert one(spark, numbers.clamp(F.lit(None).cast("double"), 0.0, 1.0)) is None
    assert one(spark, numbers.clamp(F.lit(1.5), 0.0, 1.0)) == 1.0


@pytest.mark.parametrize("amount,bucket", [
    (190000.0, 0), (290000.0, 1), (320000.0, 2), (399999.99, 2), (400000.0, 3), (470000.0, 3),
    (510000.0, 4), (610000.0, 5),
])
def test_width_bucket(spark, amount, bucket):
    assert one(spark, numbers.width_bucket(F.lit(amount), 200000.0, 600000.0, 4)) == bucket


def test_distances(spark):
    paris_amsterdam = [F.lit(x) for x in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert round(one(spark, geo.haversine_distance(*paris_amsterdam))) == 267
    assert round(one(spark, geo.haversine_distance(*paris_amsterdam, unit="km"))) == 430
    unknown = [F.lit(None).cast("double"), *paris_amsterdam[1:]]
    assert one(spark, geo.haversine_distance(*unknown)) is None
    assert one(spark, geo.great_circle_miles(*unknown, radius_m=6371000.0)) is None
    with pytest.raises(ValueError):
        geo.haversine_distance(*paris_amsterdam, unit="nm")


def test_arrays(spark):
    numbers_ = arrays.array_of(F.lit(1), F.lit(2), F.lit(3))
    assert one(spark, arrays.array_text(numbers_)) == "[1,2,3]"
    assert one(spark, arrays.array_text(arrays.array_with(numbers_, F.lit(4)))) == "[1,2,3,4]"
    more = arrays.array_of(F.lit(4), F.lit(5))
    assert one(spark, arrays.array_text(arrays.arrays_joined(numbers_, more))) == "[1,2,3,4,5]"
    assert one(spark, arrays.present_only(F.lit("a"), F.lit(None).cast("string"))) == ["a"]


def test_bands_where_nothing_matches(spark):
    nothing = F.lit(None).cast("int")
    assert one(spark, bands.booking_window(nothing)) == "30+"
    assert one(spark, bands.booking_window(F.lit(-1))) == "30+"
    assert [one(spark, bands.booking_window(F.lit(d))) for d in (0, 3, 4, 7, 8, 29, 30)] == [
        "00-03", "00-03", "04-07", "04-07", "08-29", "08-29", "30+"]
    assert one(spark, bands.seats_band(nothing)) == "9plus"
    assert [one(spark, bands.seats_band(F.lit(s))) for s in (0, 1, 8, 9)] == [
        "sold_out", "scarce", "scarce", "9plus"]
    assert one(spark, bands.concentration_level(F.lit(None).cast("double"))) == "Low Concentration"
    assert [one(spark, bands.concentration_level(F.lit(h))) for h in (0.8, 0.5, 0.49)] == [
        "High Concentration", "Moderate Concentration", "Low Concentration"]
    assert one(spark, bands.indicator(nothing > 1)) == 0


def test_segments_are_counted_without_a_regular_expression(spark):
    texts = ["a", "a||b", "", None, "||", "|||", "||||x", " a||b|| ", "|||a||||"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", text.count_segments(F.col("t")).alias("n"), F.size(text.split_segments(F.col("t"))).alias("wanted"))
    assert dict(df.dtypes)["n"] == "int" and df.where("n IS DISTINCT FROM wanted").count() == 0
    counted = df.select("t", "n")
    assert "[|]" not in counted._jdf.queryExecution().executedPlan().toString()


def test_quick_roundings_give_the_same_values(spark):
    """Whole numbers, halves of the last digit and values just beside them, signs of zero, large numbers and NULL."""
    df = spark.sql("""
        SELECT explode(array(sign * i, sign * (i + 0.5D) / 1e4D, sign * (i + 0.5D) / 1e4D * (1 + 1e-11D), sign * (i + 0.5D) / 1e4D * (1 - 1e-11D),
            sign * (i + 0.49999996D) / 1e4D, sign * i * 7919 / 613D, sign * i * 1e5D / 3, sign * i * 1e15D)) AS x
        FROM (SELECT id * 37D AS i FROM range(3000)) CROSS JOIN VALUES (1D), (-1D) t(sign)
        UNION ALL SELECT * FROM VALUES (-0.0D), (CAST(NULL AS DOUBLE)), (99999.99995D), (1e15D - 1), (-0.00005D)""")
    plain = comparable(df.selectExpr("x", "x AS whole", "x AS ratio")).toDF("plain", "w", "r")
    quick = comparable(df.selectExpr("x", "x AS whole", "x AS ratio"), whole=["whole"], ratios=["ratio"])
    assert plain.where("NOT (string(w) <=> string(plain) AND string(r) <=> string(plain))").count() == 0
    assert quick.where("NOT (string(whole) <=> string(x) AND string(ratio) <=> string(x))").count() == 0
    assert quick.count() == 48_005 and quick.where("x IS NULL").count() == 1
