"""Which 64-bit keys occur more than once in a corpus, asked and answered in packed messages.

A block of documents sends its keys as sorted binary lists, one message for each bucket of keys; a bucket
compares the lists of all blocks and answers each with its repeated keys. A key travels once (twice, if it is
repeated inside the block) for each block however many documents hold it, so a very common key is as many
entries as there are blocks, and a message costs 8 bytes a key instead of a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_BUCKETS = 512
BUCKET_TEXT = 2 << 20
BLOCK_IDS = 512
LONG_TEXT = 128 << 10
HOT_IDS = 1000


def block_of(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", ids: int = BLOCK_IDS, long_text: int = LONG_TEXT
) -> Column:
    """The block of each row; rows with the same id and text share it, whatever reads them.

    Documents with neighbouring ids share a block; files are mostly written in this order, so that a
    task meets most of a block at once. Any other order gives more messages and the same answers. Rows
    whose id does not spread them are dealt by a digest of id and text instead, about ``ids`` to a block: those
    without an id and those of an id that more than ``ids`` rows have. If there are more than HOT_IDS such
    ids, all rows are dealt so. A text of ``long_text`` bytes or more has a block of its own, so a block
    of neighbours holds less than ``ids * long_text`` bytes and a few rows more for each repeated id.
    """
    counts = rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > ids) | F.col(id_col).isNull())
    total, hot = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    col, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.xxhash64(col, text)
    if (hot or 0) > HOT_IDS:
        spread = F.lit(True)
        total = rows.count()
    else:
        spread = col.isNull() | col.isin([r[0] for r in counts.select(id_col).collect() if r[0] is not None])
    dealt = F.pmod(digest, F.lit(-(-(total or 1) // ids))) + 1
    alone = F.pmod(digest, F.lit(1 << 61)) + (1 << 61)
    return (
        F.when(F.octet_length(text) >= long_text, -alone)
        .when(spread, -dealt)
        .otherwise(F.floor(col / ids))
        .cast("long")
    )


def bucket_bits(rows: DataFrame, text_col: str = "text") -> int:
    """Buckets as a power of two: they grow with the text, so that one holds a few megabytes of keys."""
    total = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return (max(MIN_BUCKETS, -(-total // BUCKET_TEXT)) - 1).bit_length()


def messages(block: int, keys: np.ndarray, bits: int) -> pa.RecordBatch:
    """The keys of a block by bucket (their highest bits); each key at most twice."""
    keys = np.sort(keys)
    if len(keys) > 2:
        third = np.zeros(len(keys), bool)
        third[2:] = (keys[2:] == keys[1:-1]) & (keys[1:-1] == keys[:-2])
        keys = keys[~third]
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    used, first = np.unique(bucket, return_index=True)
    borders = np.append(first, len(keys)) * 8
    packed = pa.BinaryArray.from_buffers(
        pa.binary(), len(used), [None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(keys))]
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(np.full(len(used), block, np.int64)), packed], names=["bucket", "block", "keys"]
    )


MESSAGE = "bucket int, block long, keys binary"


def answer(table: pa.Table) -> pa.Table:
    """For one bucket: every block's keys that are repeated anywhere, in itself included."""
    column = table.column("keys").combine_chunks()
    data = [np.frombuffer(k, np.uint64) for k in column.to_pylist()]
    sizes = np.array([len(d) for d in data])
    keys = np.concatenate(data)
    distinct, where, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts[where] > 1
    of = np.repeat(np.arange(len(data)), sizes)
    blocks = np.array(table.column("block").to_pylist())
    out = []
    for i, part in enumerate(np.split(np.flatnonzero(again), np.searchsorted(of[again], np.arange(1, len(data))))):
        if len(part):
            out.append((int(blocks[i]), np.unique(keys[part]).tobytes()))
    names = list(zip(*out)) or [(), ()]
    return pa.table({"block": pa.array(names[0], pa.int64()), "keys": pa.array(names[1], pa.binary())})


def repeated(sent: DataFrame) -> DataFrame:
    """(block, keys): the repeated keys of every block, in one row for each bucket."""
    return sent.groupBy("bucket").applyInArrow(answer, "block long, keys binary")


def all_keys(table: pa.Table) -> np.ndarray:
    """The keys of all answers to a block, sorted."""
    parts = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each wanted key is in the sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), bool)
    return keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted
