"""Pivot, unpivot, column selection, deduplication and generated relations."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fareflow.functions import dates
from fareflow.functions.text import blank_to_null

_COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def columns_except(df: DataFrame, leave_out: Sequence[str] = ()) -> list[str]:
    """The columns of ``df`` but those named, compared without case."""
    dropped = {c.lower() for c in leave_out}
    return [c for c in df.columns if c.lower() not in dropped]


def star(df: DataFrame, leave_out: Sequence[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but ``leave_out``, renamed; all of them when none would remain."""
    kept = columns_except(df, leave_out) or df.columns
    return df.select([F.col(f"`{c}`").alias(f"{prefix}{c}{suffix}") for c in kept])


def plain_name(value) -> str:
    """A value as a column name: letters, digits and ``_`` only."""
    name = re.sub(r"[^a-z0-9_]+", "", re.sub(r"[ -]+", "_", str(value).lower()))
    return f"_{name}" if name[:1].isdigit() else name


def pivot(
    column: Column, values: Sequence, agg: Callable[[Column], Column] = F.sum, cmp: str = "=",
    prefix: str = "", suffix: str = "", then: Column | int = 1, otherwise: Column | int | None = 0,
    quote: bool = True,
) -> list[Column]:
    """One aggregate per value, to be used in ``groupBy(...).agg(*pivot(...))``.

    Absent combinations give ``otherwise`` rather than the NULL of ``groupBy().pivot()``, and
    all values are counted in the same map-side pass.
    """
    compare = _COMPARISONS[cmp]
    result = []
    for v in values:
        name = f"{prefix}{v}{suffix}"
        cell = F.when(compare(column, F.lit(v)), then).otherwise(otherwise)
        result.append(agg(cell).alias(name if quote else plain_name(name)))
    return result


def column_value_counts(df: DataFrame, column: str, where: Column | str | None = None) -> DataFrame:
    """Distinct values (NULL included) with their row counts."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def column_values(
    df: DataFrame, column: str, limit: int | None = None, where: Column | str | None = None,
    order_by: Sequence[Column] | None = None, max_values: int = 1000,
) -> list:
    """All values by falling frequency, as a list to name pivot columns with.

    More than ``max_values`` are an error, since a pivot over a part would leave rows out without a word.
    A ``limit`` is the caller's own wish for the most frequent ones alone.
    """
    order = order_by or [F.desc("n_rows"), F.asc("value")]
    most = max_values + 1 if limit is None else limit
    top = column_value_counts(df, column, where).orderBy(*order).limit(most).collect()
    if limit is None and len(top) > max_values:
        raise ValueError(f"column {column} has more than {max_values} values")
    return [r["value"] for r in top]


def table_column_values(spark: SparkSession, table: str, column: str, default: Sequence = (), **options) -> list:
    """:func:`column_values` of a named table, or ``default`` where there is no such table."""
    if not spark.catalog.tableExists(table):
        return list(default)
    return column_values(spark.table(table), column, **options)


def unpivot(
    df: DataFrame, cast_to: str = "string", keep: Sequence[str] = (), remove: Sequence[str] = (),
    field_name: str = "field_name", value_name: str = "value",
) -> DataFrame:
    """One row per kept row and remaining column; NULL values stay. One scan for all columns."""
    melted = columns_except(df, [*keep, *remove])
    prepared = df.select(*keep, *[F.col(f"`{c}`").cast(cast_to).alias(c) for c in melted])
    return prepared.unpivot(list(keep), melted, field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame], column_types: Mapping[str, str] | None = None,
    include: Sequence[str] = (), exclude: Sequence[str] = (),
    source_column: str | None = "source_relation", where: Column | str | None = None,
) -> DataFrame:
    """Union by name over the columns of all relations, in order of first appearance.

    A column a relation lacks is NULL there; its type is the one first seen unless
    ``column_types`` names another. Each row is tagged with its relation's name.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    types: dict[str, str] = {}
    for df in relations.values():
        for name, kind in df.dtypes:
            if name in exclude or (include and name not in include):
                continue
            types.setdefault(name, kind)
    if not types:
        raise ValueError("no columns left to union")
    types.update({n: t for n, t in (column_types or {}).items() if n in types})

    parts = []
    for label, df in relations.items():
        rows = df if where is None else df.where(where)
        tag = [F.lit(label).alias(source_column)] if source_column else []
        parts.append(rows.select(*tag, *[
            (F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast(t).alias(n)
            for n, t in types.items()
        ]))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def deduplicate(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; NULL keys are a key of their own.

    Spark keeps only the first row per key and task before the shuffle (``WindowGroupLimit``), so a
    key repeated any number of times sends one row from each task.
    """
    if not order_by:
        raise ValueError("order_by is needed: without it the kept row would be arbitrary")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """The whole numbers 1 to ``upper``."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


def date_spine(spark: SparkSession, part: str, start: str, end: str) -> DataFrame:
    """One row per period from ``start`` up to, not including, ``end``.

    As many rows as period boundaries lie between the two, so an empty range is an error.
    """
    begin, stop = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    periods = spark.sql("SELECT 1").select(dates.boundaries_between(begin, stop, part)).first()[0]
    moment = dates.add_interval(part, F.col("generated_number") - 1, begin)
    kind = "date" if part in ("day", "week", "month", "quarter", "year") else "timestamp_ntz"
    return generate_series(spark, periods).select(moment.cast(kind).alias(f"date_{part}")).where(
        F.col(f"date_{part}") <= stop.cast(kind))


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every string column."""
    return df.select([
        blank_to_null(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])


def without_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` not in ``right``; NULLs equal."""
    return left.subtract(right)


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows in both; NULLs equal."""
    return left.intersect(right)
