"""Order-dependent work without putting one ordered group into one task.

A plain ``lag``/``lead`` sorts a whole key in one task. Here rows are range-partitioned by key and value, so
that a key of any size is cut by its values, and stored with the number of their range. Inside a range the
neighbour is that of a window; at a border it is the edge row of the next range that has rows. There is one
edge row a range, so the edges are put in order in one task and sent to all.

``order_bin`` and ``even_bin`` cut a value range into bins that keep the order, by the values alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fareflow.sources.tables import RunFolder

LINEAR_BINS = 4096        # equal-width slices between a key's smallest and largest value
LOG_BINS = 4096           # slices per factor e, for ranges stretched by a few extreme values


def even_bin(value: str, low: str, high: str) -> str:
    """SQL for an equal-width slice number of ``value`` between ``low`` and ``high``."""
    return f"coalesce(floor(({value} - {low}) / nullif({high} - {low}, 0D) * {LINEAR_BINS}), 0)"


def order_bin(value: str, low: str, high: str) -> str:
    """SQL for a bin number that never decreases as ``value`` grows.

    It adds an equal-width and a logarithmic slice number. Both are non-decreasing, so the sum is
    too, and two values share a bin only when they share both slices: evenly spread values are
    split by the first, values squeezed by an outlier by the second. The number of bins of
    a key depends on its value range, not on its row count.
    """
    size = f"floor(log1p(abs({value})) * {LOG_BINS})"
    # Special values have bins of their own, in Spark's order: infinity last but one, NaN last.
    return (f"CASE WHEN isnan({value}) THEN 4000000000000000000 WHEN {value} = double('inf') THEN 3000000000000000000 "
            f"WHEN {value} = double('-inf') THEN -3000000000000000000 "
            f"ELSE {even_bin(value, low, high)} + CASE WHEN {value} < 0 THEN -{size} ELSE {size} END END")


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality on all keys with NULL equal to NULL, for two aliased sides."""
    return F.expr(" AND ".join(f"{left}.`{k}` <=> {right}.`{k}`" for k in keys) or "true")


def with_neighbour(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], step: int, out: str
) -> DataFrame:
    """``df`` with the neighbour of every row among the rows of its key.

    ``out`` is a struct of the ``order`` columns of the row before (``step=-1``) or after (``+1``), NULL where there
    is none. Keys and order columns ascend with NULLs first. Rows should be distinct by both.
    """
    keys, order = list(keys), list(order)
    near, edge = (F.lag, F.max) if step < 0 else (F.lead, F.min)
    ranged = RunFolder(df.sparkSession).write(
        "ranges", df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    # One row a range, however many keys it holds: a key that goes on beyond a border is at the edge.
    edges = ranged.groupBy("_range").agg(edge(F.struct(*keys, *order)).alias("_edge")).select(
        "_range", near("_edge").over(Window.orderBy("_range")).alias("_edge"))
    inside = Window.partitionBy("_range", *keys).orderBy(*order)
    placed = ranged.withColumn("_near", near(F.struct(*order)).over(inside)).join(
        F.broadcast(edges), "_range", "left")
    same_key = F.col("_edge").isNotNull()
    for key in keys:
        same_key = same_key & F.col(key).eqNullSafe(F.col("_edge")[key])
    carried = F.when(same_key, F.struct(*[F.col("_edge")[c].alias(c) for c in order]))
    return placed.withColumn(out, F.coalesce("_near", carried)).select(*df.columns, out)


def with_adjacent(
    df: DataFrame, value: str, keys: Sequence[str] = (), out: str = "adjacent", step: int = -1
) -> DataFrame:
    """Distinct ``(keys, value)`` with the adjacent smaller (``step=-1``) or larger (``+1``) value.

    Adds ``n_rows``, the number of input rows with that value; rows are counted before they move. NULL values are
    left out.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n_rows"))
    return with_neighbour(counts, keys, [value], step, "_found").select(
        *keys, value, "n_rows", F.col("_found")[value].alias(out))
