"""Documents dealt into chunks by a hash of their id, and helpers for operators that work chunk by chunk.

A chunk is what one task holds of the documents at a time. It says once what all its documents have (a
hash, with the smallest and largest id), so a passage that a third of all documents share is as many rows
as there are chunks, and the answer comes back to the chunk, not to each document.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

CHUNKS_PER_PARTITION = 4
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def chunked(docs: DataFrame, id_col: str = "doc_id", per_partition: int = CHUNKS_PER_PARTITION) -> DataFrame:
    """With ``_chunk``; the number of chunks follows spark.sql.shuffle.partitions, which is set for the data's size."""
    chunks = per_partition * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.withColumn("_chunk", F.pmod(F.xxhash64(id_col), F.lit(chunks)).cast("int"))


def grouped(rows: DataFrame, number_col: str, partitions: int) -> GroupedData:
    """Grouped by chunk, or range of hashes, with the same count of these numbers in each partition.

    Dealt by a hash of the few numbers, some tasks would get several times the others' share to sort and hold.
    """
    return rows.repartitionById(partitions, number_col).groupBy(number_col)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs inside drop their shuffle files when they end: each writes a table that the next one reads."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs inside pass so many rows at a time to Python workers: either side holds one batch as a whole."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def extremes(keys: np.ndarray, values: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with the least and the greatest value of each, and of each further column."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    out = [keys[first]]
    for column in (values, *more):
        out += [f.reduceat(column[order], first) if len(first) else column[:0] for f in (np.minimum, np.maximum)]
    return tuple(out)


def ids_of(table: pa.Table, id_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and which of them are known (a null id is never compared)."""
    column = table.column(id_col).combine_chunks()
    known = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False), known


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64, copy=False).view(np.uint64)
