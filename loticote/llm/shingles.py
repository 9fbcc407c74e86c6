"""Documents linked by the Jaccard similarity of their word shingles, and the components of the links.

Sets of similar documents share most of their shingles, so first a fixed part of all shingles (those with a
small hash) is counted over the corpus; a document with too many shingles that nobody else has cannot be
similar to any other text. The sets of the others are joined by prefixes: of two sets that are similar
enough, the first |S| - ceil(t |S|) + k shingles in one common order, rare ones first, hold k common ones. Rare
shingles are indexed alone; frequent ones of small sets in combinations of two. Candidates are
verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loticote.llm import exchange
from loticote.llm.common import runs, sub_batches, utf8
from loticote.llm.hashing import digests, mix
from loticote.llm.repeats import pack_texts, parts, text_lists
from loticote.session import materialize

# The part of all shingles that is counted over the corpus, in 1/100.
COUNTED = 40


def spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


SPACE = spaces()


def shingle_sets(data: np.ndarray, borders: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, ascending, one text after another, and their borders."""
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + np.uint8(32), data)
    inside = ~SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    first = borders[:-1][borders[:-1] < borders[1:]]
    follows = np.ones(len(data), bool)
    follows[first] = False
    if len(data):
        begins[1:] &= ~(inside[:-1] & follows[1:])
        ends[:-1] &= ~(inside[1:] & follows[1:])
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = digests(data, start, end)
    of = np.searchsorted(borders, start, "right") - 1
    counts = np.bincount(of, minlength=len(borders) - 1) if len(of) else np.zeros(len(borders) - 1, np.int64)
    word_borders = np.concatenate(([0], np.cumsum(counts)))
    # One shingle at every word that has enough words of its text from there on, or one for a short text.
    sizes = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(counts)), sizes)
    at = np.repeat(word_borders[:-1], sizes) + runs(sizes)
    wide = np.minimum(counts, words)[owner]
    shingles = wide.astype(np.uint64)
    padded = np.concatenate((hashes, np.zeros(words, np.uint64)))
    for k in range(words):
        part = np.where(k < wide, padded[at + k], np.uint64(0))
        shingles = mix(shingles * np.uint64(0x9E3779B97F4A7C15) + part)
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    keep = np.ones(len(shingles), bool)
    if len(keep):
        keep[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    shingles, owner = shingles[keep], owner[keep]
    return shingles, np.searchsorted(owner, np.arange(len(counts) + 1))


def signatures(sets: np.ndarray, borders: np.ndarray) -> list[bytes]:
    """128 bits of every set; empty sets have their own value."""
    sums = []
    for salt in (0x1234567, 0x89ABCDEF01):
        running = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(sets ^ np.uint64(salt)), dtype=np.uint64)))
        sums.append(running[borders[1:]] - running[borders[:-1]])
    both = np.stack(sums, 1)
    return [row.tobytes() for row in both]


def counted_part(sets: np.ndarray) -> np.ndarray:
    return sets < np.uint64(int(COUNTED / 100 * 2**64))


def ask(words: int, bits: int):
    """Sends the counted shingles of every block, those of equal sets once.

    A mark of 16 bits goes with each shingle, which depends on it and on its set: a shingle with two marks
    is in two different sets, one that only copies of a set hold has one mark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            for block, rows in parts(batch):
                sets, borders = shingle_sets(*utf8(rows.column("text")), words)
                names = signatures(sets, borders)
                first = np.zeros(len(names), bool)
                first[np.unique(np.array(names, object), return_index=True)[1]] = True
                able = counted_part(sets) & np.repeat(first, np.diff(borders))
                salt = np.repeat(np.array([int.from_bytes(n[:8], "little") for n in names], np.uint64), np.diff(borders))
                keys, marks = sets[able], (mix(sets[able] ^ salt[able]) >> np.uint64(48)).astype(np.uint16)
                order = np.lexsort((marks, keys))
                keys, marks = keys[order], marks[order]
                keep = np.ones(len(keys), bool)
                keep[1:] = (keys[1:] != keys[:-1]) | (marks[1:] != marks[:-1])
                keys, marks = keys[keep], marks[keep]
                keep = np.ones(len(keys), bool)
                keep[2:] = keys[2:] != keys[:-2]  # two marks say all
                yield bucketed(block, keys[keep], marks[keep], bits)

    return run


def bucketed(block: int, keys: np.ndarray, values: np.ndarray, bits: int) -> pa.RecordBatch:
    """Sorted keys and their values by the highest bits of the keys."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    used, first = np.unique(bucket, return_index=True)
    last = np.append(first[1:], len(keys))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used.astype(np.int32)),
            pa.array(np.full(len(used), block, np.int64)),
            pa.array([keys[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
            pa.array([values[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
        ],
        names=["bucket", "block", "keys", "values"],
    )


BUCKETED = "bucket int, block long, keys binary, values binary"
ANSWERED = "block long, keys binary, values binary"


def received(table: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Keys and values of a bucket, the message of each, and the messages' blocks."""
    keys = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
    values = np.concatenate([np.frombuffer(v, kind) for v in table.column("values").to_pylist()])
    return np.concatenate(keys), values, np.repeat(np.arange(len(keys)), [len(k) for k in keys]), table.column("block").to_pylist()


def by_message(of: np.ndarray, blocks: list[int], keys: np.ndarray, values: np.ndarray | None = None) -> pa.Table:
    out = []
    for rows in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1) if len(of) else []:
        told = b"" if values is None else values[rows].tobytes()
        out.append((blocks[of[rows[0]]], keys[rows].tobytes(), told))
    columns = list(zip(*out)) or [(), (), ()]
    return pa.table({
        "block": pa.array(columns[0], pa.int64()), "keys": pa.array(columns[1], pa.binary()),
        "values": pa.array(columns[2], pa.binary()),
    })


def answer_shared(table: pa.Table) -> pa.Table:
    """The shingles of each block that two different sets hold, as their lowest 32 bits: another shingle
    of a block with the same bits only keeps a document longer than needed."""
    keys, marks, of, blocks = received(table, np.uint16)
    order = np.argsort(keys, kind="stable")
    first = np.concatenate(([True], keys[order][1:] != keys[order][:-1]))
    starts = np.flatnonzero(first)
    low, high = np.minimum.reduceat(marks[order], starts), np.maximum.reduceat(marks[order], starts)
    shared = np.empty(len(keys), bool)
    shared[order] = (low != high)[np.cumsum(first) - 1]
    return by_message(of[shared], blocks, keys[shared].astype(np.uint32))


def active_sets(words: int, percent: int):
    """One row per document of a block; of those that can be similar to another, one of each set has it."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        known = np.unique(np.frombuffer(b"".join(answers.column("keys").to_pylist()), np.uint32)).astype(np.uint64)
        seen: set[bytes] = set()
        out = [SET_ROWS.empty_table()]
        for ids, data, text_borders in text_lists(texts):
            sets, borders = shingle_sets(data, text_borders, words)
            size = np.diff(borders)
            names = signatures(sets, borders)
            counted = counted_part(sets)
            again = np.zeros(len(sets), bool)
            again[counted] = exchange.among(known, sets[counted] & np.uint64(0xFFFFFFFF))
            sums = lambda flags: np.concatenate(([0], np.cumsum(flags)))
            asked = sums(counted)[borders[1:]] - sums(counted)[borders[:-1]]
            shared = sums(again)[borders[1:]] - sums(again)[borders[:-1]]
            able = (size > 0) & (shared >= asked - spare(size, percent) - MARK_SLACK)
            lists = []
            for i, name in enumerate(names):
                chosen = able[i] and name not in seen
                if chosen:
                    seen.add(name)
                lists.append(sets[borders[i] : borders[i + 1]].view(np.int64) if chosen else None)
            out.append(pa.table(
                [pa.array(ids, pa.int64()), pa.array(size.astype(np.int64)), pa.array(names, pa.binary()),
                 pa.array(lists, pa.list_(pa.int64()))],
                schema=SET_ROWS,
            ))
        return pa.concat_tables(out)

    return run


SET_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("shingles", pa.list_(pa.int64()))
])
# Two sets have the same mark for one of 65 536 of their common shingles; so many are forgiven.
MARK_SLACK = 4


def spare(size: np.ndarray, percent: int) -> np.ndarray:
    """|S| - ceil(t |S|): so many shingles of a set can be missing in a similar one."""
    return size + (-percent * size) // 100


def flat_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    borders = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), borders - borders[0]


def ask_frequency(bits: int):
    """Sends how many of a block's distinct sets hold each shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, rows in parts(batch):
                keys, counts = np.unique(flat_sets(rows.column("shingles"))[0], return_counts=True)
                yield bucketed(block, keys, counts.astype(np.uint16), bits)

    return run


def answer_frequency(table: pa.Table) -> pa.Table:
    """To each block its shingles that several sets hold, with their number (65 535 stands for more)."""
    keys, counts, of, blocks = received(table, np.uint16)
    _, where = np.unique(keys, return_inverse=True)
    held = np.bincount(where, weights=counts)[where]
    some = held > 1
    return by_message(of[some], blocks, keys[some], np.minimum(held[some], 65_535).astype(np.uint16))


def prefix_rows(percent: int, rare: int):
    """Sets that can still be similar to another: their shared shingles, and their prefix with frequencies.

    The common order is by frequency, then by hash, so prefixes hold the rarest shingles. A set with more
    shingles of its own than can be missing is done. ``reach`` has, for each shingle of the prefix, the size of
    the largest set that can be similar if this is the first common shingle, and ``frequent_reach`` is that of the
    largest one with which no rare shingle is common; ``weight`` is the mean frequency of the shingles.
    """

    def run(sets: pa.Table, answers: pa.Table) -> pa.Table:
        known = np.frombuffer(b"".join(answers.column("keys").to_pylist()), np.uint64)
        counts = np.frombuffer(b"".join(answers.column("values").to_pylist()), np.uint16)
        known, first = np.unique(known, return_index=True)
        counts = counts[first]
        keys, borders = flat_sets(sets.column("shingles"))
        held = np.ones(len(keys), np.int64)
        here = exchange.among(known, keys)
        held[here] = counts[np.searchsorted(known, keys[here])] if len(known) else 1
        size = np.diff(borders)
        out: list[tuple] = []
        for i, (name, n) in enumerate(zip(sets.column("sig").to_pylist(), size.tolist())):
            k, h = keys[borders[i] : borders[i + 1]], held[borders[i] : borders[i + 1]]
            common = h > 1
            missing = int(spare(np.array(n), percent))
            own = n - int(common.sum())
            if own > missing:
                continue
            # One longer than one common shingle needs, so that similar sets share two; own ones are the first of it.
            order = np.lexsort((k, h))[own : missing + 2]
            frequent_reach = (100 + percent) * int((h > rare).sum()) // percent - n
            reach = (100 + percent) * (n - own - np.arange(len(order))) // percent - n
            prefix = k[order].view(np.int64), h[order].astype(np.int32)
            out.append((name, n, reach, frequent_reach, float(h.sum()) / n, k[common].view(np.int64), *prefix))
        columns = list(zip(*out)) or [()] * 8
        return pa.table({
            "sig": pa.array(columns[0], pa.binary()), "n": pa.array(columns[1], pa.int64()),
            "reach": pa.array(columns[2], pa.list_(pa.int64())), "frequent_reach": pa.array(columns[3], pa.int64()),
            "weight": pa.array(columns[4], pa.float64()), "shingles": pa.array(columns[5], pa.list_(pa.int64())),
            "prefix": pa.array(columns[6], pa.list_(pa.int64())), "held": pa.array(columns[7], pa.list_(pa.int32())),
        })

    return run


PREFIXES = """sig binary, n long, reach array<long>, frequent_reach long, weight double, shingles array<long>,
    prefix array<long>, held array<int>"""


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    # Shingles that one set alone holds cannot be common and are not among these; n counts all.
    left = sets.select(F.col("sig").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    sizes = sets.select("sig", "n")
    # Sizes alone refuse some pairs before any set moves.
    able = (
        pairs.join(sizes.toDF("a", "m_a"), "a").join(sizes.toDF("b", "m_b"), "b")
        .where(100 * F.least("m_a", "m_b") >= percent * F.greatest("m_a", "m_b")).select("a", "b")
    )
    both = F.size(F.array_intersect("s_a", "s_b"))
    return (
        able.join(left, "a").join(right, "b").withColumn("both", both)
        .where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")
    )


def components(edges: DataFrame) -> DataFrame:
    """(sig, label): the smallest member reachable, by taking the least label around and jumping on.

    Every round is written and read back, so lost executors repeat one round at most.
    """
    edges = materialize(
        edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "sig")
    labels = materialize(labels, "labels")
    while True:
        around = (
            edges.join(labels.select(F.col("sig").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("sig")).agg(F.min("label").alias("near"))
        )
        hooked = labels.join(around, "sig").select("sig", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("sig").alias("label"), F.col("label").alias("further"))
        moved = hooked.join(jump, "label", "left").select(
            "sig", "old", F.least("label", F.coalesce("further", "label")).alias("label")
        )
        moved = materialize(moved, "labels")
        labels = moved.select("sig", "label")
        if moved.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def index_keys(sets: DataFrame, percent: int, rare: int, small: int) -> DataFrame:
    """(key, sig, n, reach, weight): the keys under which every set is indexed.

    Similar sets share two shingles of their prefixes. If one of them is rare, they meet under it. Else
    all are frequent: sets up to ``small`` shingles meet under a combination of two, larger ones under
    single shingles; sets close below ``small`` use both, as their partners can be on either side.

    Similar sets are in reach of each other under their first common shingle; under later ones they need
    not be. A prefix with a frequent shingle holds all rare ones of its set, so sets that meet under
    combinations alone have no rare one in common, and there ``reach`` counts the frequent ones only.
    """
    entries = sets.select("sig", "n", "weight", F.explode(F.arrays_zip("prefix", "held", "reach")).alias("e"))
    entries = entries.select("sig", "n", "weight", F.col("e.prefix").alias("key"), "e.held", "e.reach")
    alone = entries.where((F.col("held") <= rare) | (100 * F.col("n") > percent * small)).select(
        "key", "sig", "n", "reach", "weight"
    )
    frequent = F.filter(F.arrays_zip("prefix", "held"), lambda e: e["held"] > rare)
    lists = sets.where(F.col("n") <= small).select(
        "sig", "n", F.col("frequent_reach").alias("reach"), "weight", F.array_sort(F.transform(frequent, lambda e: e["prefix"])).alias("s")
    )
    two = F.flatten(
        F.transform("s", lambda x, i: F.transform(F.slice(F.col("s"), i + 2, F.size("s")), lambda y: F.xxhash64(x, y)))
    )
    return alone.unionByName(lists.select(F.explode(two).alias("key"), "sig", "n", "reach", "weight"))


def star_pairs(lists: DataFrame, first: Column) -> DataFrame:
    """Each set with the most frequent first member of its lists, where both lie in different components.

    ``lists`` has (key, sig, n, reach, weight, label). The first member has the largest ``first``.
    """
    hub = F.max_by(F.struct("sig", "n", "reach", "label"), F.struct(first, F.col("sig")))
    hubs = lists.groupBy("key").agg(hub.alias("hub"), F.min("label").alias("low"), F.max("label").alias("high"))
    hubs = hubs.where("low != high").select("key", "hub")
    able = (
        (F.col("label") != F.col("hub.label")) & (F.col("n") <= F.col("hub.reach")) & (F.col("hub.n") <= F.col("reach"))
    )
    votes = (
        lists.join(hubs, "key").where(able)
        .groupBy("sig", F.col("hub.sig").alias("hub")).agg(F.count(F.lit(1)).alias("votes"))
    )
    order = Window.partitionBy("sig").orderBy(F.desc("votes"), "hub")
    best = votes.withColumn("r", F.row_number().over(order)).where("r = 1")
    return best.select(F.least("sig", "hub").alias("a"), F.greatest("sig", "hub").alias("b")).distinct()


def labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return lists.withColumn("label", F.col("sig"))
    found = lists.join(labels, "sig", "left")
    return found.withColumn("label", F.coalesce("label", "sig"))


def similar_components(sets: DataFrame, percent: int, rare: int, small: int, rounds: int) -> DataFrame:
    """(sig, label) of the components of all sets with a link.

    Large groups of near copies would give all their pairs, so ``rounds`` times each set is first compared with one
    member of another component in its lists: the one with the most frequent shingles, which is closest to
    what the copies were made from, and in every other round one of the largest component in reach.
    What is left are pairs whose members still lie in different components; these are compared in full,
    so that no link between two components is lost. Sets without a partner in reach of their size leave
    the lists before.
    """
    lists = materialize(index_keys(sets, percent, rare, small), "index")
    links = None
    labels = None
    for turn in range(rounds):
        marked = labelled(lists, labels)
        if turn % 2:
            sizes = marked.select("sig", "label").distinct().groupBy("label").agg(F.count(F.lit(1)).alias("members"))
            marked = marked.join(sizes, "label")
        first = F.col("members").cast("double") if turn % 2 else F.col("weight")
        found = materialize(verified(star_pairs(marked, first), sets, percent), "star-links")
        if found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    marked = labelled(lists, labels).drop("weight")
    mixed = marked.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("least"), F.max("reach").alias("most")
    )
    mixed = mixed.where("low != high").select("key", "least", "most")
    marked = marked.join(mixed, "key").where("reach >= least AND n <= most").drop("least", "most")
    marked = materialize(marked, "open-lists")
    other = marked.select(
        "key", F.col("sig").alias("b"), F.col("label").alias("label_b"), F.col("n").alias("n_b"), F.col("reach").alias("reach_b")
    )
    pairs = marked.join(other, "key").where("label < label_b AND n <= reach_b AND n_b <= reach")
    pairs = pairs.select(F.least("sig", "b").alias("a"), F.greatest("sig", "b").alias("b")).distinct()
    found = materialize(verified(pairs, sets, percent), "cross-links")
    if found.isEmpty():
        return labels if labels is not None else found.select(F.col("a").alias("sig"), F.col("b").alias("label"))
    return components(found if links is None else links.unionByName(found))


def similar_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 75,
    rare: int = 16,
    small: int = 64,
    rounds: int = 2,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_copies`` of every row.

    Words are what ASCII white space separates, A-Z in lower case; a document's set are its distinct runs of
    ``words`` words, or all its words as one run if there are fewer. Documents link when 100 * common >=
    ``percent`` * union; ``component_id`` is the smallest id that links reach, ``n_copies`` the rows with the
    same set. NULL texts, and texts without a word, have empty sets and are linked with nothing. Rows with equal
    sets are one node, so copies make no pairs. A NULL id is nobody's smallest id, unless all ids of a component
    are NULL; repeated rows are copies; an empty table gives no rows.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    rows = rows.withColumn("block", exchange.block_of(rows))
    bits = exchange.bucket_bits(rows)
    asked = rows.select("block", "text").mapInArrow(ask(words, bits), BUCKETED)
    answers = asked.groupBy("bucket").applyInArrow(answer_shared, ANSWERED)
    lists = rows.mapInArrow(pack_texts, "block long, blob binary")
    known = materialize(
        lists.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            active_sets(words, percent), "doc_id long, n long, sig binary, shingles array<long>"
        ),
        "shingle-sets",
    )
    one = Window.partitionBy("sig").orderBy(F.col("doc_id").asc_nulls_last())
    sets = known.where(F.col("shingles").isNotNull()).withColumn("r", F.row_number().over(one)).where("r = 1")
    # The tasks that write the distinct sets are the blocks that ask for frequencies.
    sets = sets.select("sig", "shingles", F.spark_partition_id().cast("long").alias("block"))
    sets = materialize(sets, "distinct-sets")
    asked = sets.select("block", "shingles").mapInArrow(ask_frequency(bits), BUCKETED)
    answers = asked.groupBy("bucket").applyInArrow(answer_frequency, ANSWERED)
    sets = materialize(
        sets.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            prefix_rows(percent, rare), PREFIXES
        ),
        "prefixes",
    )
    labels = similar_components(sets, percent, rare, small, rounds)
    classes = known.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies"))
    classes = classes.join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    classes = materialize(classes, "classes")
    least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "label").select("sig", "component_id", "n_copies")
    return known.select("doc_id", "n", "sig").join(classes, "sig", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows whose id is the smallest of their component, one each, with all their columns.

    Rows without an id stay where their whole component has none, one for each text.
    """
    found = similar_documents(df, id_col, text_col, **options)
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = found.where(same).select(F.col("doc_id").alias("__first")).distinct()
    text = F.xxhash64(text_col)
    one = Window.partitionBy(id_col, F.when(F.col(id_col).isNull(), text)).orderBy(text)
    kept = df.join(first, df[id_col].eqNullSafe(first["__first"])).withColumn("__r", F.row_number().over(one))
    return kept.where("__r = 1").select(*df.columns)
