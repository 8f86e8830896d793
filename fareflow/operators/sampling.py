"""Stratified sampling that gives the same rows however the data is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fareflow.operators.joins import BROADCAST_BYTES, attach
from fareflow.operators.ordering import null_safe
from fareflow.sources.tables import RunFolder, plan_bytes

# Spark trims each task's rows to the limit before the shuffle up to this many per group
# (spark.sql.optimizer.windowGroupLimitThreshold); larger samples are trimmed by salt.
TRIMMED_BY_SPARK = 1000
SALTS = 256
# Digits of a hash that are compared with a stratum's limit.
HASH_DIGITS = 12
# Rows looked at above the number taken: in standard deviations of their number, and some more.
SPARE_DEVIATIONS, SPARE_ROWS = 6, 12


def sample_order(identity: Column, seed: str) -> Column:
    """A fixed pseudo-random order: md5 of the row's identity and a seed."""
    return F.md5(F.concat(identity.cast("string"), F.lit(seed)))


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, rank: str
) -> DataFrame:
    """The first ``limit`` rows per group with their rank; hot groups are trimmed before they meet."""
    if limit > TRIMMED_BY_SPARK:
        salt = F.pmod(F.xxhash64(*[o for o in order]), F.lit(SALTS))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = df.withColumn("_salt", salt).withColumn(rank, F.row_number().over(part)).where(
            F.col(rank) <= limit).drop("_salt", rank)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= limit)


def _last_digits(share: Column) -> Column:
    """The first digits of the last hash within a share, from 0 to 1, of all hashes.

    Hashes are compared with them as text, so digits are made once a stratum and no hash is read as a number.
    """
    last = F.least(F.floor(share * float(16 ** HASH_DIGITS)), F.lit(16 ** HASH_DIGITS - 1))
    return F.lpad(F.lower(F.hex(last)), HASH_DIGITS, "0")


def stratified_sample(
    df: DataFrame, strata: Sequence[str], identity: str, rate: float, at_least: int, at_most: int,
    seed: str, weight: str = "sample_weight", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``rate`` of each stratum, between ``at_least`` and ``at_most`` rows, with expansion weights.

    A stratum smaller than ``at_least`` is taken whole with weight 1, so the weights of a stratum
    always add up to its size. NULL in a stratum key is a value like any other.

    Strata are counted first. Where their table is small enough to be sent to all tasks, a row goes on only if its
    hash is as low as those of the wanted rows and some to spare, so few rows are ranked. A stratum that falls
    short of its rows by chance is ranked whole, as all are where the table is larger.
    """
    run = RunFolder(df.sparkSession)
    wanted = F.greatest(F.lit(at_least), F.least(F.round(F.col("_size") * rate), F.lit(at_most)))
    sizes = run.write("strata", df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_size")).withColumn(
        "_take", F.least(F.col("_size"), wanted).cast("bigint")))
    rows = df.withColumn("_order", sample_order(F.col(identity), seed))
    most = max(at_least, at_most)
    if plan_bytes(sizes) <= broadcast_bytes:
        spare = SPARE_DEVIATIONS * F.sqrt(F.col("_take").cast("double")) + SPARE_ROWS
        limits = sizes.select(*strata, _last_digits((F.col("_take") + spare) / F.col("_size")).alias("_limit"))
        low = run.write("low", attach(rows, F.broadcast(limits), strata, match_nulls=True, how="inner").where(
            F.substring("_order", 1, HASH_DIGITS) <= F.col("_limit")).drop("_limit"))
        found = low.groupBy(*strata).agg(F.count(F.lit(1)).alias("_found"))
        short = run.write("short", attach(sizes, found, strata, match_nulls=True).where(
            F.coalesce("_found", F.lit(0)) < F.col("_take")).select(*strata))
        if short.isEmpty():
            rows = low
        else:
            same, few = null_safe("r", "s", strata), F.broadcast(short).alias("s")
            rows = low.alias("r").join(few, same, "left_anti").unionByName(rows.alias("r").join(few, same, "left_semi"))
    candidates = first_per_group(rows, strata, [F.col("_order"), F.col(identity)], most, "_rank")
    return (
        attach(candidates, sizes, strata, match_nulls=True, how="inner")
        .where(F.col("_rank") <= F.col("_take"))
        .withColumn(weight, F.col("_size").cast("double") / F.col("_take"))
        .drop("_order", "_rank", "_size", "_take")
    )
