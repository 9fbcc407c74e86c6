"""What each filter of a chain removes, for every order of the chain and every part of the corpus.

A filter fails a document or it does not, whatever ran before, so the documents left after some filters depend
on the set of these filters alone. Five filters have 32 sets: each document becomes a 32-bit word that has bit
S set when it survives all filters of S. The words of a part and label are counted position by position with
carry-save adders; the 32 counts of each part and label then answer every order, step and Shapley sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loticote.session import materialize

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
ALL = SETS - 1
# Truth tables: bit S of the i-th is set when filter i belongs to set S.
TABLES = [sum(1 << s for s in range(SETS) if s >> i & 1) for i in range(len(FILTERS))]

WHITE = r"[\x20\x09-\x0D]+"
# Words counted in one go; counts of a stretch are summed by Spark afterwards.
STRETCH_ROWS = 1 << 17


def text_failures(text: Column) -> list[Column]:
    """Filters A to D of one text."""
    words = F.array_remove(F.split(text, WHITE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return [
        n < 200,
        100 * distinct.cast("long") < 50 * n.cast("long"),
        100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]


def survival_word(failures: list[Column]) -> Column:
    """32 bits in a long: bit S is set when no filter of S fails."""
    lost = F.lit(0).cast("long")
    for failed, truth in zip(failures, TABLES):
        lost = lost.bitwiseOR(F.when(failed, F.lit(truth).cast("long")).otherwise(F.lit(0).cast("long")))
    return F.bitwise_not(lost).bitwiseAND(F.lit((1 << SETS) - 1).cast("long"))


def add_words(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits, by carry-save adders.

    Three words of a weight become one of it (the sum bits) and one of twice the weight (the carries),
    until at most two are left of each weight; only these few are taken apart.
    """
    counts = np.zeros(SETS, np.int64)
    places = np.arange(SETS, dtype=np.uint32)
    weight = 1
    while len(words):
        carries = []
        while len(words) > 2:
            k = len(words) // 3
            a, b, c = words[:k], words[k : 2 * k], words[2 * k : 3 * k]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * k :]])
        counts += weight * (words[:, None] >> places & np.uint32(1)).sum(axis=0, dtype=np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


COUNTS = "part string, good boolean, toxic boolean, counts array<long>"


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 32 counts of each part and label in stretches of rows."""

    def counted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        parts = table.column("part").combine_chunks().dictionary_encode()
        label = pc.add(pc.multiply(pc.cast(table.column("good"), pa.int64()), 2), pc.cast(table.column("toxic"), pa.int64()))
        group = parts.indices.to_numpy().astype(np.int64) * 4 + label.to_numpy()
        order = np.argsort(group, kind="stable")
        words = table.column("word").to_numpy().astype(np.uint32)[order]
        groups, start = np.unique(group[order], return_index=True)
        sums = [add_words(w) for w in np.split(words, start[1:])]
        return pa.RecordBatch.from_arrays(
            [
                parts.dictionary.take(pa.array(groups // 4)),
                pa.array((groups & 2) > 0),
                pa.array((groups & 1) > 0),
                pa.array([s.tolist() for s in sums], pa.list_(pa.int64())),
            ],
            names=["part", "good", "toxic", "counts"],
        )

    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= STRETCH_ROWS:
            yield counted(held)
            held, rows = [], 0
    if held:
        yield counted(held)


def survival_words(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``doc_id, part, word, good, toxic``: one row per document.

    A document is good (toxic) if any label row of its id says so. Filter E fails a document whose text a
    smaller id has as well: the smallest id of each text is found by aggregation, and a document fails
    unless it is found among these by id and text, a join whose keys are no more frequent than repeated rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    narrow = rows.select(
        "doc_id",
        "part",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        *(f.alias(name) for f, name in zip(text_failures(F.col("text")), FILTERS)),
    )
    narrow = materialize(narrow, "audit-rows")
    first = narrow.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = first.withColumn("is_first", F.lit(True))
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL")
    said = said.groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    joined = narrow.join(first, ["doc_id", "digest"], "left").join(said, "doc_id", "left")
    copied = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return joined.select(
        "doc_id",
        "part",
        survival_word([*(F.col(c) for c in "ABCD"), copied]).alias("word"),
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def subset_survivors(words: DataFrame) -> DataFrame:
    """``part, kept, good, toxic``: three arrays with the survivors of each of the 32 sets."""
    counted = words.select("part", "good", "toxic", "word").mapInArrow(count_words, COUNTS)
    sums = {
        "kept": lambda s: F.col("counts")[s],
        "good": lambda s: F.when(F.col("good"), F.col("counts")[s]).otherwise(0),
        "toxic": lambda s: F.when(F.col("toxic"), F.col("counts")[s]).otherwise(0),
    }
    columns = [F.sum(of(s)).alias(f"{name}{s}") for name, of in sums.items() for s in range(SETS)]
    total = counted.groupBy("part").agg(*columns)
    return total.select("part", *(F.array(*(f"{name}{s}" for s in range(SETS))).alias(name) for name in sums))


def shapley(kept: Column, i: int) -> Column:
    """What filter ``i`` removes, summed over all orders: each set before it stands for its orders."""
    n = len(FILTERS)
    out = F.lit(0).cast("long")
    for s in range(SETS):
        if not s >> i & 1:
            size = s.bit_count()
            out = out + factorial(size) * factorial(n - 1 - size) * (kept[s] - kept[s | 1 << i])
    return out


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """One row per part, order of the five filters and step, with the counts of this step's filter.

    ``kept`` after the step, ``removed`` at it, ``redundant`` (fail this filter, but went earlier),
    ``unique_fails`` (fail this filter alone), ``good_lost`` and ``toxic_lost`` (removed here, labelled so)
    and ``shapley`` (removed by this filter, summed over all orders).

    NULL texts are empty, NULL parts the empty string. Rows with a NULL id never count as later copies and
    have no labels; repeated rows count each, and rows of one id and text are no copies of each other.
    Several label rows of an id count once; label rows without a document change nothing. Further columns
    are not read. An empty table gives no rows.
    """
    counts = subset_survivors(survival_words(docs, labels, id_col, text_col, part_col))
    kept = F.col("kept")
    per_filter = F.array(
        *(
            F.struct(
                (kept[0] - kept[1 << i]).alias("fails"),
                (kept[ALL ^ 1 << i] - kept[ALL]).alias("unique_fails"),
                shapley(kept, i).alias("shapley"),
            )
            for i in range(len(FILTERS))
        )
    )
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    counts = counts.withColumn("of", per_filter).withColumn("filter_order", F.explode(orders))
    counts = counts.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def place(letter: Column) -> Column:
        return F.call_function("position", letter, F.lit(FILTERS)) - 1

    def bit(i: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), i)

    letters = F.split("filter_order", "")
    earlier = F.slice(letters, F.lit(1), F.col("step") - 1)
    before = F.aggregate(earlier, F.lit(0), lambda s, letter: s + bit(place(letter)))
    counts = counts.withColumn("i", place(letters[F.col("step") - 1])).withColumn("before", before)
    counts = counts.withColumn("after", F.col("before") + bit(F.col("i")))
    lost = lambda c: F.col(c)[F.col("before")] - F.col(c)[F.col("after")]
    of = F.col("of")[F.col("i")]
    return counts.select(
        "part",
        "filter_order",
        "step",
        kept[F.col("after")].alias("kept"),
        lost("kept").alias("removed"),
        (of["fails"] - lost("kept")).alias("redundant"),
        of["unique_fails"].alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        of["shapley"].alias("shapley"),
    )
