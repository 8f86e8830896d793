"""Small helpers that the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Fixed value: the characters between words.
WORD = r"[^\x20\x09-\x0D]+"
_shipped: set[str] = set()


def pick(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, matched by exact name: other columns may be called anything."""
    places = [df.columns.index(c) for c in columns]
    return numbered(df).select(*[F.col(f"_c{p}").alias(c) for p, c in zip(places, columns)])


def numbered(df: DataFrame) -> DataFrame:
    """The columns as _c0, _c1, ..., so that no operator column can clash with one of them."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, column: str) -> str:
    """The name that a column has after ``numbered``."""
    return f"_c{df.columns.index(column)}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver runs from.

    The archive is handed to Spark, whose file server copies it to every executor.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    if not root.is_dir():  # already imported from an archive
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="fareflow-code-"), "fareflow_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def arrow_map(df: DataFrame, work, schema: str) -> DataFrame:
    """``df.mapInArrow`` with the package importable on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def by_bytes(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts in ``column`` have at most ``most`` bytes together, or are one row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(sizes[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The runs of equal values in the first ``keys`` columns of sorted rows, across batches."""
    parts: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)])
        edges = [0, *(np.flatnonzero((np.diff(columns) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            key = tuple(columns[:, start].tolist())
            if parts and key != last:
                yield pa.Table.from_batches(parts)
                parts = []
            last = key
            parts.append(batch.slice(start, end - start))
    if parts:
        yield pa.Table.from_batches(parts)


def mix(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers scattered one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
