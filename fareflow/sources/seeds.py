"""Reference lists: carriers, airport coordinates, fare classes.

Each list is available as a small in-plan relation (Catalyst knows its size and broadcasts
it) and as a CSV reader for a caller's own, longer list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CARRIER_SCHEMA = "code string, name string"
AIRPORT_SCHEMA = "iata_code string, lat_deg double, lon_deg double"
FARE_CLASS_SCHEMA = "first_letter string, fare_bucket string"
COORDINATE_SCHEMA = "iata_code string, latitude double, longitude double"

# Carrier code and name.
CARRIERS = [
    ("AA", "American Airlines"),
    ("DL", "Delta Air Lines"),
    ("UA", "United Airlines"),
    ("B6", "JetBlue Airways"),
    ("NK", "Spirit Airlines"),
    ("AS", "Alaska Airlines"),
    ("F9", "Frontier Airlines"),
    ("SY", "Sun Country Airlines"),
    ("9X", "Republic Airways"),
    ("9K", "PenAir"),
    ("KG", "Kingfisher Airlines"),
    ("4B", "Bora Airways"),
    ("LF", "Lan Perú"),
    ("HA", "Hawaiian Airlines"),
]

# Airport, latitude, longitude in degrees.
AIRPORTS = [
    ("BDL", 41.9389, -72.6816),
    ("BOG", 4.7016, -74.1469),
    ("CLE", 41.4075, -81.8513),
    ("CUN", 21.0404, -86.8715),
    ("DFW", 32.8998, -97.0403),
    ("DTW", 42.2124, -83.3534),
    ("FLL", 26.0742, -80.1506),
    ("GYE", -2.1574, -79.8835),
    ("IAH", 29.9844, -95.3414),
    ("LAX", 33.9416, -118.4085),
    ("MEM", 35.0421, -89.9792),
    ("MIA", 25.7932, -80.2906),
    ("MSY", 29.9934, -90.2580),
    ("MYR", 33.6797, -78.9283),
    ("PBI", 26.6832, -80.0956),
    ("PHL", 39.8729, -75.2437),
    ("PHX", 33.4352, -112.0101),
    ("PIT", 40.4915, -80.2329),
    ("SAN", 32.7338, -117.1933),
    ("SEA", 47.4502, -122.3088),
    ("SJU", 18.4392, -66.0018),
    ("SLC", 40.7899, -111.9791),
    ("SMF", 38.6955, -121.5895),
    ("SNA", 33.6762, -117.8676),
]

# Fare bucket by the first letter of the fare basis code, A to Z.
FARE_CLASSES = [
    ("A", "prem_cabin"),
    ("B", "full_mid_econ"),
    ("C", "prem_cabin"),
    ("D", "prem_cabin"),
    ("E", "deep_disc_econ"),
    ("F", "prem_cabin"),
    ("G", "full_mid_econ"),
    ("H", "full_mid_econ"),
    ("I", "prem_cabin"),
    ("J", "prem_cabin"),
    ("K", "full_mid_econ"),
    ("L", "full_mid_econ"),
    ("M", "full_mid_econ"),
    ("N", "full_mid_econ"),
    ("O", "deep_disc_econ"),
    ("P", "prem_cabin"),
    ("Q", "full_mid_econ"),
    ("R", "deep_disc_econ"),
    ("S", "full_mid_econ"),
    ("T", "full_mid_econ"),
    ("U", "full_mid_econ"),
    ("V", "full_mid_econ"),
    ("W", "deep_disc_econ"),
    ("X", "deep_disc_econ"),
    ("Y", "full_mid_econ"),
    ("Z", "prem_cabin"),
]


def values_sql(rows, columns: str) -> str:
    """``VALUES`` text for a fixed list; doubles are written as exact literals."""
    def literal(v):
        return f"cast({v!r} as double)" if isinstance(v, float) else "'" + v + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS seed({columns})"


def _relation(spark: SparkSession, rows, columns: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {values_sql(rows, columns)}")


def carriers(spark: SparkSession) -> DataFrame:
    return _relation(spark, CARRIERS, "code, name")


def airports(spark: SparkSession) -> DataFrame:
    return _relation(spark, AIRPORTS, "iata_code, lat_deg, lon_deg")


def fare_classes(spark: SparkSession) -> DataFrame:
    return _relation(spark, FARE_CLASSES, "first_letter, fare_bucket")


def read_list(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A caller's own list from CSV with a header and a declared schema."""
    return spark.read.csv(path, schema=schema, sep=sep, header=True)


def airport_coordinates(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The optional full coordinate list (``;``-delimited); empty when there is no file."""
    if path is None:
        return spark.createDataFrame([], COORDINATE_SCHEMA)
    return read_list(spark, path, COORDINATE_SCHEMA, sep=";")


def merged_coordinates(airports: DataFrame, extra: DataFrame) -> DataFrame:
    """Both coordinate lists as one row per upper-cased code; a place is taken whole, from ``airports`` if it is there."""
    def points(df, latitude, longitude, priority):
        return df.dropna(subset=["iata_code", latitude, longitude]).select(
            F.upper("iata_code").alias("iata_code"), F.lit(priority).alias("priority"),
            F.struct(F.col(latitude).alias("lat"), F.col(longitude).alias("lon")).alias("at"))

    both = points(airports, "lat_deg", "lon_deg", 1).union(points(extra, "latitude", "longitude", 0))
    best = both.groupBy("iata_code").agg(F.max(F.struct("priority", "at")).alias("best"))
    return best.select("iata_code", F.col("best.at.lat").alias("airport_lat"), F.col("best.at.lon").alias("airport_lon"))
