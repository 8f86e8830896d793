"""Aggregates Spark has no single function for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def list_text(
    value: Column, delimiter: str = ",", order_by: Column | None = None,
    distinct: bool = False,
) -> Column:
    """Join all of the group's values to one text, ordered.

    Without ``order_by`` the values are sorted, so the text does not depend on task order. The
    result is one string per group, so this fits groups whose whole list fits a row; for the
    first values only use :func:`first_list_text`.
    """
    text = value.cast("string")
    if distinct:
        items = F.array_sort(F.collect_set(text))
    elif order_by is None:
        items = F.array_sort(F.collect_list(text))
    else:
        pairs = F.array_sort(F.collect_list(
            F.when(text.isNotNull(), F.struct(order_by.alias("o"), text.alias("v")))))
        items = F.transform(pairs, lambda p: p["v"])
    return F.array_join(items, delimiter)


def first_list_text(
    df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str], limit: int,
    out: str, delimiter: str = ",",
) -> DataFrame:
    """The first ``limit`` values of each group as one text, for groups of any size.

    The row limit is applied before the shuffle (Spark keeps the first ``limit`` rows per key
    and task), so a hot key sends only that many rows from each task.
    """
    order = Window.partitionBy(*keys).orderBy(*order_by, value)
    top = (
        df.where(F.col(value).isNotNull())
        .select(*dict.fromkeys([*keys, value, *order_by]))
        .withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") <= limit)
    )
    items = F.array_sort(F.collect_list(F.struct("_rn", F.col(value).cast("string").alias("_t"))))
    return top.groupBy(*keys).agg(
        F.array_join(F.transform(items, lambda p: p["_t"]), delimiter).alias(out))


def any_value(value: Column) -> Column:
    return F.any_value(value)


def bool_or(condition: Column) -> Column:
    """True when the condition holds for any row of the group; NULL is ignored."""
    return F.bool_or(condition)


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


def mean_where(condition: Column, value: Column) -> Column:
    return F.avg(F.when(condition, value))


def group_by_first(df: DataFrame, n: int):
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])
