"""Assignment of documents to shards of nearly equal bytes; groups of equal texts stay together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loticote.session import materialize

ROWS_PER_CELL = 4_000
PROBES = 48


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def group_key(text: Column) -> Column:
    """128 bits of the text as hexadecimal digits; NULL texts are one group of their own."""
    return F.coalesce(F.md5(text.cast("binary")), F.lit("-"))


def group_sizes(df: DataFrame, size: Column, key: Column) -> DataFrame:
    """One row per group: its key and its bytes. Partial sums make a hot group one row per task."""
    return df.select(key.alias("key"), size.alias("size")).groupBy("key").agg(F.sum("size").alias("size"))


def running_sizes(groups: DataFrame, cells: int) -> DataFrame:
    """Groups in the order of their keys, with the bytes of all groups up to and including each.

    The order is cut into cells by the first digits of the key, which are spread evenly. Only the totals
    of the cells (some thousands of rows for each million groups) pass through one window partition.
    """
    digits = max(1, len(f"{max(cells - 1, 1):x}"))
    celled = groups.withColumn("cell", F.substring("key", 1, digits))
    totals = celled.groupBy("cell").agg(F.sum("size").alias("cell_size"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
    inside = Window.partitionBy("cell").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    return celled.join(totals, "cell").select(
        "key", "size", (F.col("before") + F.sum("size").over(inside)).alias("upto")
    )


def jumps(running: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """Greedy filling for several capacities at once: the bytes up to the end of every shard.

    A shard ends at the last group that still fits. All capacities make one jump per pass; a pass is one
    aggregate without a shuffle of rows, and only the (capacity, end) numbers reach the driver.
    """
    ends = [[0] for _ in capacities]
    for _ in range(shards):
        targets = [e[-1] + c for e, c in zip(ends, capacities)]
        row = running.agg(
            *(
                F.coalesce(F.max(F.when(F.col("upto") <= t, F.col("upto"))), F.lit(0)).alias(f"e{i}")
                for i, t in enumerate(targets)
            )
        ).first()
        for i, e in enumerate(ends):
            e.append(max(e[-1], row[i]))
    return ends


def minimax_cuts(running: DataFrame, shards: int) -> list[int]:
    """Ends (in running bytes) of the contiguous shards whose largest one is as small as possible.

    The capacity lies between max(total / shards, largest group) and total / shards + largest group. Each
    round tries PROBES capacities of the interval greedily, so the interval shrinks PROBES-fold a round:
    the binary search with more than one probe at a time, because a pass costs far more than a probe.
    """
    total, largest = running.agg(F.max("upto"), F.max("size")).first()
    if not total:
        return [0] * shards
    low = max(-(-total // shards), largest)  # may be feasible
    high = -(-total // shards) + largest  # is always feasible
    best = None
    while best is None or low < high:
        step = max(1, (high - low) // PROBES)
        tried = list(range(low, high, step))[: PROBES + 1] + [high]
        found = jumps(running, tried, shards)
        for i, (capacity, ends) in enumerate(zip(tried, found)):
            if ends[-1] >= total:
                best, high = ends, capacity
                low = min(high, tried[i - 1] + 1) if i else high
                break
    return best[1:]


def minimax_shards(
    df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, group_key`` of every row.

    Size is the UTF-8 bytes plus one (NULL text: one). Rows with equal texts form one atomic group; groups
    in the order of a digest of their text are cut into ``shards`` contiguous parts so that the largest
    part is as small as this order allows. The shard of a row follows from comparing its digest with the
    cuts, without a join. Slots count from 0 without gaps in each shard, by (cell, doc_id, digest); rows that are
    equal in all of it are interchangeable. NULL texts form one group and have a NULL checksum; NULL ids
    are numbered like others; an empty table gives no rows; shards can be empty if there are fewer groups.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text_size(F.col(text_col)).alias("size"),
        F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
        group_key(F.col(text_col)).alias("group_key"),
    )
    rows = materialize(rows, "shard-rows")
    n = rows.count()
    cells = max(1, -(-n // ROWS_PER_CELL))
    running = materialize(
        running_sizes(group_sizes(rows, F.col("size"), F.col("group_key")), cells), "shard-running"
    )
    ends = minimax_cuts(running, shards)
    inner = sorted(set(ends[:-1]) - {0})
    last_keys = {r.upto: r.key for r in running.where(F.col("upto").isin(inner)).collect()} if inner else {}
    cuts = [last_keys.get(e) for e in ends[:-1]]
    shard = F.lit(0)
    for cut in cuts:
        # A cut without a key lies before the first group: the shard is empty.
        shard = shard + (F.lit(1) if cut is None else (F.col("group_key") > cut).cast("int"))
    cell = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(cells)).cast("int")
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("cell", cell)
    totals = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "group_key")
    numbered = placed.withColumn("rank", F.row_number().over(inside) - 1)
    return numbered.join(totals, ["shard", "cell"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("before") + F.col("rank")).cast("long").alias("slot"),
        "group_key",
    )
