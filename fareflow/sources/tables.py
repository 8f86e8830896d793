"""Tables a run writes once and reads many times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Stored bytes of a table that one task of a shuffle sorts in memory, and the most tasks asked for.
PART_BYTES = 16 * 1024 * 1024
# The same where the rows are stored wider than they were read.
WIDENED_PART_BYTES = PART_BYTES // 4
MOST_PARTS = 10_000


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size of a relation; for a stored table, the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def dealt(df: DataFrame, stored_bytes: int, *keys: str, part_bytes: int = PART_BYTES, exactly: bool = False) -> DataFrame:
    """``df`` shuffled by ``keys``, over more tasks than the session's number where its rows come from a large table.

    ``stored_bytes`` is the size of that table, so that what a task sorts does not grow with the input. A number up to
    the session's is left to Spark, which merges small parts into some of 64 MB. Rows that cost much each, as those written
    out, are then too few tasks to keep all cores busy: ``exactly`` asks for the number as soon as it exceeds the cores
    (a join with the result may raise it to the session's).
    """
    spark = df.sparkSession
    parts = min(-(-stored_bytes // part_bytes), MOST_PARTS)
    least = spark.sparkContext.defaultParallelism if exactly else int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys) if parts > least else df.repartition(*keys)


def write_table(df: DataFrame, path: str, partition_by=(), compression: str | None = None) -> DataFrame:
    """Create or replace the Parquet table at ``path`` and return it."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where that is unset, a local session gets a temporary folder; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="fareflow-")


class RunFolder:
    """Parquet tables of one run, under a fresh name in the shared folder.

    Reading a table back cuts the lineage: a lost executor re-reads files rather than
    repeating the joins, and file sizes give Catalyst true sizes for its join choice.
    ``compression`` names a Parquet codec other than the session's.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, compression: str | None = None):
        self.spark = spark
        self.compression = compression
        self.folder = f"{folder or shared_folder(spark)}/fareflow-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, name: str, df: DataFrame, partition_by=()) -> DataFrame:
        return write_table(df, self.path(name), partition_by, self.compression)
