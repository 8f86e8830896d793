"""From raw documents to token ids: every stage is written as Parquet and read again by the next.

The first four stages return the columns of documents; the last one returns doc_id, n_tokens and the packed ids.
The mix repeats documents, so an id may come more than once from then on.

Defined results: a null text counts as empty everywhere. Rows may share an id, and an id or a source may be null; no
column but doc_id, text and source is read, and all are handed on, whatever they are called. An empty
table stays empty through all stages. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fareflow.llm.bpe_encode import encode_documents
from fareflow.llm.common import table
from fareflow.llm.exact_dedup import without_duplicates
from fareflow.llm.line_quality import good_documents, train
from fareflow.llm.mixing import mixed_documents
from fareflow.llm.shingle_join import without_near_duplicates
from fareflow.sources.tables import RunFolder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. The chain learns from the labelled ones among ``docs``.

    Null and empty texts go, since they have fewer than ten words. Repeated rows are judged each for itself.
    Without labelled documents of both kinds the base rules alone decide.
    """
    return good_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays, a null id only where there is no other; of rows that repeat
    text and id one stays."""
    return without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Rows without words, and rows without an id, are near copies of nothing and stay. Rows that share an id go or stay together.
    """
    return without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of sources takes them.

    Rows without words come once. A null source is one of its own, ordered last. Rows that share an id come equally often.
    """
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, packed as little-endian unsigned 32-bit integers; none for a null text."""
    encoded = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("exact dedup", exact_dedup),
    ("near duplicates", near_dedup),
    ("source mixing", mixing),
    ("byte-level BPE", encoding),
]

#: The first stage decodes a trained chain, which SQL cannot express; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows are written and read again, too."""
    folder = RunFolder(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = folder.write(f"stage_{i}", stage(spark, docs, sf_dir))
    return docs


def pipeline_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def pipeline_oracles() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
