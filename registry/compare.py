"""One form for both sides of a comparison: doubles rounded half up to four decimals."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame

DIGITS = 4


def comparable(df: DataFrame, whole: Collection[str] = (), ratios: Collection[str] = ()) -> DataFrame:
    """``whole`` names columns that mostly hold whole numbers, ``ratios`` others that differ in most rows; they give the same
    values sooner. Not all columns: the code of a row must stay below the size up to which Java compiles it."""
    def form(name: str) -> str:
        column = f"`{name}`"
        return whole_rounded(column) if name in whole else ratio_rounded(column) if name in ratios else sql_rounded(column)

    return df.selectExpr(*[f"{form(n)} AS `{n}`" if t == "double" else f"`{n}`" for n, t in df.dtypes])


def whole_rounded(expression: str) -> str:
    """The value of :func:`sql_rounded`; whole numbers stay as they are. Adding 0 takes the sign of a zero."""
    return (f"CASE WHEN {expression} = rint({expression}) AND abs({expression}) < 1e15D THEN {expression} + 0D "
            f"ELSE {sql_rounded(expression)} END")


def ratio_rounded(expression: str) -> str:
    """The value of :func:`sql_rounded`, by arithmetic where no error of a double can turn the last digit.

    Below 100,000 these errors and the tenth decimal move a value by less than 0.000001 of the last digit, so only
    values near its half (and large ones) need decimals.
    """
    unit = f"{10 ** DIGITS}D"
    scaled = f"{expression} * {unit}"
    return (f"CASE WHEN abs({expression}) < 100000D AND abs({scaled} - rint({scaled})) < 0.4999D "
            f"THEN rint({scaled}) / {unit} + 0D ELSE {sql_rounded(expression)} END")


def sql_rounded(expression: str, digits: int = DIGITS) -> str:
    return (f"CAST(CAST(CAST({expression} AS DECIMAL(38,10)) AS DECIMAL(38,{digits})) AS DOUBLE)")


def finish(sql: str, doubles: str) -> str:
    """Round the named double columns of a query's result."""
    replaced = ", ".join(f"{sql_rounded(c)} AS {c}" for c in doubles.split())
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})" if replaced else sql
