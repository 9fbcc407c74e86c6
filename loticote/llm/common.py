"""Helpers shared by the operators: Arrow text buffers, bounded sub-batches, session settings."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows in one Arrow batch sent to Python; text batches are cut again by bytes inside the tasks.
ARROW_ROWS = 2000
SUB_BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Batch size, and the folder of this package for Python workers that start elsewhere.

    On a cluster the package has to be installed or sent with the job (``--py-files``); in local mode
    the workers then find it from any working directory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    environment = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in [root, *paths] if p)
    return spark


def text_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, whatever else the table has."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and the n + 1 borders; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def strings(data: np.ndarray, borders: np.ndarray) -> pa.Array:
    """The reverse of utf8(): texts from bytes and borders."""
    borders = np.ascontiguousarray(borders, np.int64)
    return pa.LargeStringArray.from_buffers(
        len(borders) - 1, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data))
    )


def sub_batches(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SUB_BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of text, at least one row."""
    for batch in batches:
        _, borders = utf8(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(borders, borders[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def gathered(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Join small batches up to about ``limit`` bytes of text, so that vectors are long."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in sub_batches(batches, text, limit):
        more = batch.column(text).nbytes
        if held and size + more > limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if batch.num_rows:
            held.append(batch)
            size += more
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def runs(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length, one after another."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
