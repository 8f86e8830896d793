"""Data-quality checks. Each returns the offending rows; a check passes when there are none.

Values that repeat are reported once with ``n_rows``, the number of rows behind them, so
a hot value neither crowds one task nor shortens the report. Checks that compare two numbers
return them in one row; :func:`summarise` turns any result into a failure count.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.functions import dates
from fareflow.operators.ordering import with_adjacent, with_neighbour

Condition = Column | str | None


def _rows(df: DataFrame, where: Condition) -> DataFrame:
    return df if where is None else df.where(where)


def _count() -> Column:
    return F.count(F.lit(1))


def not_null(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    return _rows(df, where).where(F.col(column).isNull())


def unique(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    """Repeated values; NULLs are not compared."""
    rows = _rows(df, where).where(F.col(column).isNotNull())
    return rows.groupBy(F.col(column).alias("value")).agg(_count().alias("n_rows")).where("n_rows > 1")


def unique_combination_of_columns(
    df: DataFrame, columns: Sequence[str], where: Condition = None
) -> DataFrame:
    """Repeated combinations; NULLs are equal."""
    return _rows(df, where).groupBy(*columns).agg(_count().alias("n_rows")).where("n_rows > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence, where: Condition = None) -> DataFrame:
    """Values outside the list; NULL passes."""
    found = _rows(df, where).groupBy(F.col(column).alias("value")).agg(_count().alias("n_rows"))
    return found.where(~F.col("value").isin(list(values)))


def not_accepted_values(
    df: DataFrame, column: str, values: Sequence, where: Condition = None
) -> DataFrame:
    """Forbidden values that occur."""
    found = _rows(df, where).groupBy(F.col(column).alias("value")).agg(_count().alias("n_rows"))
    return found.where(F.col("value").isin(list(values)))


def accepted_range(
    df: DataFrame, column: str, low=None, high=None, inclusive: bool = True, where: Condition = None
) -> DataFrame:
    """Rows outside the range; NULL passes."""
    value, outside = F.col(column), F.lit(False)
    if low is not None:
        outside = outside | ((value < low) if inclusive else (value <= low))
    if high is not None:
        outside = outside | ((value > high) if inclusive else (value >= high))
    return _rows(df, where).where(outside)


def expression_is_true(
    df: DataFrame, expression: str, column: str | None = None, where: Condition = None
) -> DataFrame:
    """Rows for which the expression is false; NULL passes. ``column`` is put before it."""
    text = f"{column} {expression}" if column else expression
    return _rows(df, where).where(~F.expr(f"({text})"))


def at_least_one(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    """One row when the column has no value at all."""
    return _rows(df, where).agg(F.count(column).alias("n_values")).where("n_values = 0")


def not_constant(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    """One row when the column has exactly one distinct value (a minimum equal to its maximum)."""
    bounds = _rows(df, where).agg(F.min(column).alias("lowest"), F.max(column).alias("highest"))
    return bounds.where("lowest = highest").select(F.col("lowest").alias("only_value"))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, where: Condition = None
) -> DataFrame:
    """The share of non-NULL rows when out of bounds; an empty relation passes."""
    share = F.try_divide(F.count(column).cast("double"), _count().cast("double"))
    result = _rows(df, where).agg(share.alias("not_null_proportion"))
    return result.where(
        (F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame, column: str, part: str, interval: int, now: Column | None = None,
    where: Condition = None,
) -> DataFrame:
    """The newest value when older than ``now`` less the interval; an empty relation passes."""
    moment = dates.now_utc() if now is None else now
    threshold = dates.add_interval(part, F.lit(-interval), moment)
    newest = _rows(df, where).agg(F.max(column).cast("timestamp_ntz").alias("most_recent"))
    return newest.withColumn("threshold", threshold).where("most_recent < threshold")


def _tagged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both relations below each other, by position, with a 1 in ``_a`` or ``_b``."""
    return left.select("*", F.lit(1).alias("_a"), F.lit(0).alias("_b")).union(
        right.select("*", F.lit(0).alias("_a"), F.lit(1).alias("_b")))


def _two_counts(df: DataFrame, other: DataFrame) -> DataFrame:
    rows = _tagged(df.select(), other.select())
    return rows.agg(
        F.coalesce(F.sum("_a"), F.lit(0)).alias("count_a"),
        F.coalesce(F.sum("_b"), F.lit(0)).alias("count_b"),
    )


def equal_rowcount(df: DataFrame, other: DataFrame, where: Condition = None) -> DataFrame:
    """Both row counts and ``diff_count``, which is 0 when the check passes."""
    return _two_counts(_rows(df, where), other).withColumn(
        "diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def fewer_rows_than(df: DataFrame, other: DataFrame, where: Condition = None) -> DataFrame:
    """Both row counts and ``row_count_delta``: the excess, 1 for a tie, 0 when the check passes."""
    a, b = F.col("count_a"), F.col("count_b")
    return _two_counts(_rows(df, where), other).withColumn(
        "row_count_delta", F.when(a > b, a - b).when(a == b, 1).otherwise(0))


def equality(
    df: DataFrame, other: DataFrame, columns: Sequence[str] | None = None, strict: bool = False,
    where: Condition = None,
) -> DataFrame:
    """Distinct rows found on one side only, with the side.

    ``strict`` also reports rows whose number differs. Both directions come from one aggregate,
    combined before its shuffle, instead of two set differences.
    """
    columns = list(columns or df.columns)
    left = _rows(df, where).select(*columns)
    sums = _tagged(left, other.select(*columns)).groupBy(*columns).agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    differs = (F.col("_a") != F.col("_b")) if strict else (
        (F.col("_a") == 0) | (F.col("_b") == 0))
    side = F.when(F.col("_a") > F.col("_b"), "a_minus_b").otherwise("b_minus_a")
    return sums.where(differs).select(side.alias("which_diff"), *columns)


def cardinality_equality(
    df: DataFrame, column: str, other: DataFrame, field: str, where: Condition = None
) -> DataFrame:
    """Values whose number of rows differs between two columns, once per side that has them."""
    left = _rows(df, where).select(F.col(column).alias("value"))
    sums = _tagged(left, other.select(F.col(field).alias("value"))).groupBy("value").agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    sides = F.array(
        F.struct(F.lit("a_minus_b").alias("which_diff"), F.col("_a").alias("num_rows")),
        F.struct(F.lit("b_minus_a").alias("which_diff"), F.col("_b").alias("num_rows")),
    )
    return sums.where("_a <> _b").select("value", F.inline(sides)).where("num_rows > 0")


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str, from_condition: Condition = None,
    to_condition: Condition = None,
) -> DataFrame:
    """Non-NULL ids without a parent, with the number of rows that hold them."""
    ids = _rows(df, from_condition).where(F.col(column).isNotNull()).groupBy(
        F.col(column).alias("id")).agg(_count().alias("n_rows"))
    parents = _rows(to, to_condition).where(F.col(field).isNotNull()).select(
        F.col(field).alias("id")).distinct()
    return ids.join(parents, "id", "left_anti")


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, part: str | None = None, where: Condition = None
) -> DataFrame:
    """Values that are not their predecessor plus the interval; the first one passes.

    A repeated value fails once for each repeat, its predecessor being itself.
    """
    def follows(previous: Column) -> Column:
        if part is None:
            return F.col(column) == previous + interval
        return F.col(column).cast("timestamp_ntz") == dates.add_interval(
            part, F.lit(interval), previous)

    near = with_adjacent(_rows(df, where).select(column), column, out="_previous")
    cases = F.array(
        F.struct(F.col("_previous").alias("previous"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.col(column).alias("previous"), (F.col("n_rows") - 1).alias("n")),
    )
    return (
        near.select(column, F.inline(cases))
        .where(F.col("n") > 0)
        .where(~follows(F.col("previous")))
        .withColumnsRenamed({"previous": f"previous_{column}", "n": "n_rows"})
    )


def mutually_exclusive_ranges(
    df: DataFrame, lower: str, upper: str, partition_by: str | None = None, gaps: str = "allowed",
    zero_length_range_allowed: bool = False, where: Condition = None,
) -> DataFrame:
    """Ranges that are empty, reversed, open (a NULL bound) or collide with the next one.

    ``lower`` and ``upper`` are SQL expressions. Ranges are ordered by (lower, upper) with NULLs last. Ranges that repeat
    are counted first and follow one another, so only distinct ones have to be put in order.
    """
    words = {"not_allowed": "equal_to", "allowed": "less_than_or_equal_to", "required": "less_than"}
    if gaps not in words:
        raise ValueError(f"gaps must be one of {tuple(words)}, got {gaps!r}")
    range_word = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    range_name = f"lower_bound_{range_word}_upper_bound"
    next_name = f"upper_bound_{words[gaps]}_next_lower_bound"
    keys = ["partition_by_col"] if partition_by else []
    lo, up, nxt = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")

    ranges = _rows(df, where).select(
        *([F.expr(partition_by).alias("partition_by_col")] if partition_by else []),
        F.expr(lower).alias("lower_bound"), F.expr(upper).alias("upper_bound"),
    ).groupBy(*keys, "lower_bound", "upper_bound").agg(_count().alias("n_rows"))
    flagged = ranges.withColumns({"_no_lower": lo.isNull(), "_no_upper": up.isNull()})
    placed = with_neighbour(flagged, keys, ["_no_lower", "lower_bound", "_no_upper", "upper_bound"], 1, "_next")

    def case(next_bound: Column, is_last: Column, n: Column) -> Column:
        return F.struct(next_bound.alias("next_lower_bound"), is_last.alias("is_last_record"), n.cast("bigint").alias("n"))

    none, after = F.lit(None), F.col("_next")["lower_bound"]
    nothing = case(none.cast(ranges.schema["lower_bound"].dataType), none.cast("boolean"), F.col("n_rows"))
    copies = case(lo, F.lit(False), F.col("n_rows") - 1)
    last = case(after, F.col("_next").isNull(), F.lit(1))
    # A missing lower bound fails whatever follows; such rows sort last, with no next bound.
    cases = F.when(lo.isNull(), F.array(nothing)).when(
        after == lo, F.array(case(lo, F.lit(False), F.col("n_rows")))).otherwise(F.array(copies, last))
    ordered = placed.select(*keys, "lower_bound", "upper_bound", F.inline(cases)).where("n > 0")

    compare = {"not_allowed": up == nxt, "allowed": up <= nxt, "required": up < nxt}[gaps]
    in_order = (lo <= up) if zero_length_range_allowed else (lo < up)
    return ordered.withColumns({
        range_name: F.coalesce(in_order, F.lit(False)),
        next_name: F.coalesce(compare, F.col("is_last_record"), F.lit(False)),
    }).where(~(F.col(range_name) & F.col(next_name))).withColumnRenamed("n", "n_rows")


def columns_match_set(df: DataFrame, names: Iterable[str]) -> tuple[set[str], set[str]]:
    """Column names missing and column names in excess; no job is run."""
    have, want = {c.lower() for c in df.columns}, {n.lower() for n in names}
    return want - have, have - want


def not_empty_string(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    return _rows(df, where).where(F.col(column) == "")


def columns_equal(df: DataFrame, left: str, right: str, where: Condition = None) -> DataFrame:
    """Rows where the columns differ; a NULL on one side only is a difference."""
    return _rows(df, where).where(~F.col(left).eqNullSafe(F.col(right)))


class Outcome(NamedTuple):
    """A check's result and how its failures are counted (rows by default)."""

    check: str
    relation: str
    rows: DataFrame
    failures: Column | None = None


def equality_failures() -> Column:
    """Number of differing rows plus the imbalance between the sides."""
    left = F.count(F.when(F.col("which_diff") == "a_minus_b", 1))
    right = F.count(F.when(F.col("which_diff") == "b_minus_a", 1))
    return left + right + F.abs(left - right)


def summarise(outcomes: Sequence[Outcome]) -> DataFrame:
    """One row per check: name, relation, number of failures."""
    parts = []
    for o in outcomes:
        failures = _count() if o.failures is None else F.coalesce(o.failures, F.lit(0))
        parts.append(o.rows.agg(failures.cast("bigint").alias("failures")).select(
            F.lit(o.check).alias("check"), F.lit(o.relation).alias("relation"), "failures"))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result
