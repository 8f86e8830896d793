"""Period-by-period loading as idempotent batches with a log of what is loaded.

A target is a folder with two tables. ``data`` has the rows, one partition for each load and period. ``log`` has one row
for each finished load: its number, the bounds it was given, the largest timestamp it wrote (the mark) and the number
of its rows. The log is written last, and rows of a load that it does not list are not read. So a load that
breaks off leaves nothing visible, and the next one has the same number and replaces what is there. The log
is as long as there are loads; it tells where to go on, so the loaded rows themselves are never read for that.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from fareflow.functions import dates

PERIOD_COLUMN = "load_period"
LOAD_COLUMN = "load_number"
LOG_SCHEMA = f"{LOAD_COLUMN} int, after string, until string, mark string, n_rows long"


class Mark(NamedTuple):
    """The number of the last finished load and the largest timestamp loaded so far, as text."""

    load: int
    loaded_up_to: str | None


def read_log(spark: SparkSession, target: str) -> DataFrame:
    """The finished loads of a target, none where there is no log yet."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{target}/log")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def last_mark(spark: SparkSession, target: str) -> Mark:
    last = read_log(spark, target).agg(F.max(LOAD_COLUMN).alias("load"), F.max(F.col("mark").cast("timestamp_ntz")).cast(
        "string").alias("mark")).first()
    return Mark(last["load"] or 0, last["mark"])


def load_by_period(
    source: DataFrame, target: str, ts: str, period: str, start: str, stop: str
) -> DataFrame:
    """Append the rows with ``mark < ts < stop`` to the table at ``target``, one folder per load and period.

    ``mark`` is the largest timestamp already loaded, or ``start`` for a new table, so a row
    exactly at ``start`` is left out, and so is a row that arrives late, at or before the mark. All periods are
    written in one distributed job, which also counts the rows; the log row follows. A load without rows is
    logged, too, and keeps the mark.
    """
    spark, last = source.sparkSession, last_mark(source.sparkSession, target)
    after, load = last.loaded_up_to or start, last.load + 1
    moment = F.col(ts).cast("timestamp_ntz")
    written = Observation(f"load {load}")
    fresh = source.where(
        (moment > F.lit(after).cast("timestamp_ntz")) & (moment < F.lit(stop).cast("timestamp_ntz"))
    ).observe(written, F.count(F.lit(1)).alias("n_rows"), F.max(moment).cast("string").alias("mark"))
    (
        fresh.withColumns({PERIOD_COLUMN: dates.truncate(period, moment).cast("date"), LOAD_COLUMN: F.lit(load)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_COLUMN, PERIOD_COLUMN)
        .parquet(f"{target}/data")
    )
    found = written.get
    log_row = (load, after, stop, found["mark"] or last.loaded_up_to, found["n_rows"])
    spark.createDataFrame([log_row], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{target}/log")
    return loaded_rows(source, target)


def loaded_rows(source: DataFrame, target: str) -> DataFrame:
    """The rows of all finished loads with the source's columns; loads are numbered without gaps."""
    spark = source.sparkSession
    stored = f"{LOAD_COLUMN} int, {PERIOD_COLUMN} date"
    schema = ", ".join(f"`{n}` {t}" for n, t in source.dtypes)
    table = spark.read.schema(f"{schema}, {stored}").parquet(f"{target}/data")
    return table.where(F.col(LOAD_COLUMN) <= last_mark(spark, target).load).select(*source.columns)
