"""Exact duplicates by skew-safe combining.

Copies are combined three times, and each time rows count as equal only if their whole texts are:
within a task (the map side of the first aggregate), within a salted digest group, and between
the salted winners of a digest. A hot text therefore reaches the last step as at most one row
for each salt. Memberships are then looked up by digest, those of hot texts by digest and salt. Should two different texts share a
digest, those digests (and no others) are looked up by digest and text.

Defined results: a null text counts as the empty text. A null id is smaller than any other, so it
stays only in a group without ids. Of rows that repeat both text and id, one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from fareflow.llm.common import numbered, pick, place
from fareflow.operators.joins import lookup
from fareflow.sources.tables import RunFolder

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def text_groups(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row for each distinct text of ``docs`` (doc_id, text): _digest, _text, keep_id, group_size."""
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("_text"),
    ).select(
        digest(F.col("_text")).alias("_digest"), "_text", "doc_id",
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("_salt"),
    )
    salted = rows.groupBy("_digest", "_salt", "_text").agg(
        F.max("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    return salted.groupBy("_digest", "_text").agg(
        F.max("_keep").alias("keep_id"), F.sum("_n").alias("group_size"))


def duplicate_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise: Callable[[Column], Column] | None = None,
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """For every row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``normalise`` is applied to the text first; left out, texts are compared as they are. The
    hash is always SHA-256 of the normalised text, whatever ``digest`` groups by.
    """
    run = RunFolder(docs.sparkSession)
    docs = pick(docs, id_column, text_column).toDF("doc_id", "text")
    if normalise is not None:
        docs = docs.select("doc_id", normalise(F.col("text")).alias("text"))
    found = text_groups(docs, salts, digest)
    # Narrow: what a digest stands for, and whether it stands for one text only.
    groups = run.write("digests", found.groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_texts"), F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size")))
    text = F.coalesce("text", F.lit(""))
    members = docs.select("doc_id", digest(text).alias("_digest"), sha256(text).alias("text_sha256"))
    # Rows that repeat text and id are counted, so that one of them can stay.
    members = members.groupBy("_digest", "text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("_copies"))
    # A hot text's rows are spread over salts there.
    result = lookup(members, groups, ["_digest"], ["_texts", "keep_id", "group_size"], "group_size").where(
        "_texts = 1").drop("_texts")
    clashing = groups.where("_texts > 1").select("_digest")
    if not clashing.isEmpty():
        result = result.unionByName(_by_content(docs, clashing, salts, digest))
    return result.select(
        "doc_id", "keep_id", "group_size", "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"),
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        "text_sha256")


def _by_content(docs, clashing, salts, digest):
    """Memberships of the digests that several texts share."""
    text = F.coalesce("text", F.lit(""))
    some = docs.withColumn("_digest", digest(text)).join(clashing, "_digest", "left_semi")
    groups = text_groups(some.select("doc_id", "text"), salts, digest)
    members = some.groupBy("_digest", text.alias("_text"), "doc_id").agg(
        F.count(F.lit(1)).alias("_copies"))
    return members.join(groups, ["_digest", "_text"]).select(
        "_digest", sha256(F.col("_text")).alias("text_sha256"), "doc_id", "_copies", "keep_id", "group_size")


def without_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; ties are broken by the other columns."""
    key = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    kept = duplicate_groups(docs, id_column, text_column).where("kept").select(
        F.col("text_sha256").alias("_sha"), key(F.col("doc_id")).alias("_id"))
    own, text = place(docs, id_column), F.coalesce(F.col(place(docs, text_column)), F.lit(""))
    rows = numbered(docs).withColumns({"_sha": sha256(text), "_id": key(F.col(own))})
    # Keyed by digest and id, so that a hot text is spread; the window needs no shuffle of its own.
    rows = rows.join(kept, ["_sha", "_id"], "left_semi")
    order = [c for c in rows.columns if c not in ("_sha", "_id", place(docs, text_column), own)]
    ranked = rows.withColumn("_rank", F.row_number().over(
        Window.partitionBy("_sha", "_id").orderBy(F.desc_nulls_last(own), *order)))
    return ranked.where("_rank = 1").drop("_rank", "_sha", "_id").toDF(*docs.columns)
