"""Several distinct counts of one table by bitmaps.

Counting the distinct values of several columns in one aggregate makes Spark copy every row once for each column, with all
other columns that are aggregated. Here each distinct value gets a number first, numbers being dense, and a group's
values become bits of a bitmap that is combined before the shuffle: a task sends one bitmap of 4 KB for a
group, column and run of 32,768 numbers, however many rows and values it has seen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from fareflow.operators.joins import lookup
from fareflow.sources.tables import RunFolder


def dense_codes(df: DataFrame, column: str, run: RunFolder | None = None) -> DataFrame:
    """``column``, code (1, 2, ... in the order of the values) and n_rows for each non-NULL value; a stored table.

    Values are numbered inside ranges and the ranges' sizes are run through, one row a range.
    """
    run = run or RunFolder(df.sparkSession)
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    ranged = run.write(f"ranges_of_{column}", values.repartitionByRange(column).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_here")).select(
        "_range", F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    return run.write(f"codes_of_{column}", ranged.withColumn("_at", inside).join(F.broadcast(starts), "_range").select(
        column, (F.col("_start") + F.col("_at")).alias("code"), "n_rows"))


def distinct_counts(
    df: DataFrame, keys: Sequence[str], counted: Mapping[str, str], codes: Mapping[str, DataFrame],
) -> DataFrame:
    """``keys`` and, for each name in ``counted``, the number of distinct non-NULL values of the column it stands for.

    ``codes`` has the :func:`dense_codes` of these columns. A group without any value is absent. NULL is a key
    like any other.
    """
    keys, columns = list(keys), list(dict.fromkeys(counted.values()))
    # A counted column may be a key, too.
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *columns)
    for i, column in enumerate(columns):
        rows = lookup(rows, codes[column].withColumnRenamed("code", f"_c{i}"), [column], [f"_c{i}"], "n_rows")
    pairs = F.array(*[F.struct(F.lit(i).alias("_what"), F.col(f"_c{i}").alias("_code")) for i in range(len(columns))])
    own = [f"_k{i}" for i in range(len(keys))]
    bits = rows.select(*own, F.inline(pairs)).where("_code IS NOT NULL").groupBy(
        *own, "_what", F.bitmap_bucket_number("_code").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_code")).alias("_bits"))
    totals = {name: F.sum(F.when(F.col("_what") == columns.index(column), F.bitmap_count("_bits")).otherwise(0)).alias(name)
              for name, column in counted.items()}
    return bits.groupBy(*own).agg(*totals.values()).select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], *totals)
