"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def array_of(*items: Column) -> Column:
    return F.array(*items)


def array_with(items: Column, extra: Column) -> Column:
    return F.array_append(items, extra)


def arrays_joined(first: Column, second: Column) -> Column:
    return F.concat(first, second)


def array_text(items: Column) -> Column:
    """``[1,2,3]``: no blanks, unlike a plain cast."""
    return F.concat(F.lit("["), F.array_join(items.cast("array<string>"), ","), F.lit("]"))


def present_only(*items: Column) -> Column:
    """An array of the items that are not NULL."""
    return F.array_compact(F.array(*items))
