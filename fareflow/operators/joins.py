"""Look-ups of a per-key table from a large fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from fareflow.operators.ordering import null_safe
from fareflow.sources.tables import plan_bytes

# Stored bytes; a hash table in memory takes up to about ten times as much.
BROADCAST_BYTES = 16 * 1024 * 1024
HOT_ROWS = 2_000_000
# Parts that facts without a key are spread over.
LOOSE_SALTS = 4096


def lookup(
    facts: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    take: Sequence[str],
    rows_column: str,
    match_nulls: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Left join ``facts`` to ``table`` (unique on ``keys``), adding the ``take`` columns.

    ``table`` should be a written table. Its size is checked first: up to ``broadcast_bytes`` it is
    broadcast and the facts do not move. A larger table meets the facts in one shuffle. ``rows_column`` has the
    number of fact rows behind a key; ``sizes`` (keys and that column) has it for keys the table lacks,
    too. Keys with more than ``hot_rows`` number at most (facts / hot_rows), so they are broadcast: their
    facts are tagged with one of several salts, and their table row is repeated once a salt. Facts without a key
    have no partner and are spread over salts of their own.
    """
    keys = list(keys)
    table = table.select(*keys, *dict.fromkeys([*take, rows_column]))
    if plan_bytes(table) <= broadcast_bytes:
        return _left(facts, F.broadcast(table), keys, take, match_nulls)
    counted = table if sizes is None else sizes
    hot = F.broadcast(counted.where(F.col(rows_column) > hot_rows).select(
        *keys, F.ceil(F.col(rows_column) / max(1, hot_rows)).cast("int").alias("_salts")))
    match = _match("f", "h", keys, match_nulls)
    lacking = F.lit(False)
    for key in [] if match_nulls else keys:
        lacking = lacking | F.col(key).isNull()
    salts = F.coalesce(F.col("_salts"), F.when(lacking, F.lit(LOOSE_SALTS)), F.lit(1))
    tagged = facts.alias("f").join(hot.alias("h"), match, "left").select("f.*", "h._salts").withColumn(
        "_salt", F.pmod(F.monotonically_increasing_id(), salts).cast("int")).drop("_salts")
    repeated = table.alias("f").join(hot.alias("h"), match, "left").select(
        *[f"f.`{c}`" for c in dict.fromkeys([*keys, *take])],
        F.explode(F.sequence(F.lit(0), F.coalesce("h._salts", F.lit(1)) - 1)).alias("_salt"))
    on = _match("f", "t", keys, match_nulls) & F.expr("f._salt = t._salt")
    return tagged.alias("f").join(repeated.alias("t"), on, "left").select(
        *[f"f.`{c}`" for c in facts.columns], *[f"t.`{c}`" for c in take])


def _match(left, right, keys, match_nulls):
    if match_nulls:
        return null_safe(left, right, keys)
    return F.expr(" AND ".join(f"{left}.`{k}` = {right}.`{k}`" for k in keys))


def _left(facts, table, keys, take, match_nulls):
    return facts.alias("f").join(
        table.alias("t"), _match("f", "t", keys, match_nulls), "left"
    ).selectExpr("f.*", *[f"t.`{c}`" for c in take])


def attach(
    left: DataFrame, right: DataFrame, keys: Sequence[str], match_nulls: bool = False,
    how: str = "left",
) -> DataFrame:
    """Join two aggregates of the same grain; the right side adds its non-key columns."""
    keys = list(keys)
    extra = [c for c in right.columns if c not in keys]
    return left.alias("l").join(
        right.alias("r"), _match("l", "r", keys, match_nulls), how
    ).selectExpr("l.*", *[f"r.`{c}`" for c in extra])
