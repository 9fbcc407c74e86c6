"""Bytes that belong to a long string which starts anywhere else in the corpus, by prefix-free parsing.

Triggers (places where a rolling hash of W bytes is 0 modulo P) cut every text into phrases that overlap by
a trigger; equal text is cut alike wherever it stands. The dictionary of phrases is counted over the corpus: a
window that holds a phrase which occurs once occurs once itself, which settles nearly all text that is not
repeated. What is left is put into corpus order by suffixes: a window is a suffix of a phrase (its
bytes up to its first trigger) followed by the parse from there, and windows are equal if both parts are.
Only equality of the first ``length`` bytes matters, so ranks are 128-bit digests of these suffixes
instead of places in one sorted array; copies of a passage then meet in packed lists of digests and not
in one range of a global sort. Windows are ranked in groups of 16 with the same first trigger, by what
all 16 share and by the whole group; single windows only where groups differ at the edge of a repeat.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loticote.llm import exchange
from loticote.llm.common import runs, sub_batches, utf8
from loticote.llm.hashing import Pieces, mix
from loticote.session import materialize

W = 8
P = 32
GROUP = 16
PART_BYTES = 4 << 20
UNIQUE, OPEN, REPEATED_OPEN = 0, 1, 2


def packed(value) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(value, protocol=5))


def unpacked(blob: bytes):
    """Only ever applied to what packed() wrote into this job's own shuffle or scratch table."""
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def triggers(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the triggers that lie inside one text, and their texts."""
    if len(data) < W:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    eight = np.ndarray((len(data) - W + 1,), "<u8", np.ascontiguousarray(data).tobytes(), strides=(1,))
    rolled = (eight * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)
    place = np.flatnonzero(rolled % np.uint64(P) == 0)
    of = np.searchsorted(borders, place, "right") - 1
    inside = place + W <= borders[of + 1]
    return place[inside], of[inside]


def phrases(data: np.ndarray, borders: np.ndarray, length: int):
    """Start, end, text and key of all phrases that fit into a window."""
    place, of = triggers(data, borders)
    whole = (of[1:] == of[:-1]) & (place[1:] + W - place[:-1] <= length)
    start, end, of = place[:-1][whole], place[1:][whole] + W, of[:-1][whole]
    return start, end, of, Pieces(data)(start, end) ^ mix((end - start).astype(np.uint64))


def parts(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each block."""
    blocks = np.array(batch.column("block").to_pylist())
    for block in np.unique(blocks):
        yield int(block), batch.filter(pa.array(blocks == block))


def ask_phrases(bits: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text", PART_BYTES):
            for block, rows in parts(batch):
                yield exchange.messages(block, phrases(*utf8(rows.column("text")), length)[3], bits)

    return run


def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a block in one compressed list, which is what moves instead of texts."""
    for batch in sub_batches(batches, "text", PART_BYTES):
        for block, rows in parts(batch):
            data, borders = utf8(rows.column("text"))
            blob = packed((rows.column("doc_id").to_pylist(), data, borders))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([blob], pa.binary())], names=["block", "blob"])


def text_lists(table: pa.Table) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    for blob in table.column("blob").to_pylist():
        yield unpacked(blob)


def row_key(doc_id: int | None, text: bytes) -> bytes:
    """Names a row in later steps; rows with equal id and text have equal results."""
    return hashlib.blake2b(text, digest_size=16, key=repr(doc_id).encode()).digest()


@dataclass
class Regions:
    """The parts of texts in which windows can be repeated, and the starts of these windows."""

    keys: list[bytes]  # of the texts
    of: np.ndarray  # text of each region
    at: np.ndarray  # start of each region in its text
    data: np.ndarray
    borders: np.ndarray  # of the regions in data
    first: np.ndarray  # first window of each run of windows, in data
    count: np.ndarray

    def windows(self) -> np.ndarray:
        return np.repeat(self.first, self.count) + runs(self.count)


def find_regions(ids: list, data: np.ndarray, borders: np.ndarray, known: np.ndarray, length: int) -> Regions:
    """Windows without a phrase that occurs once; ``known`` are the repeated phrases."""
    n = len(data)
    start, end, of, keys = phrases(data, borders, length)
    once = ~exchange.among(known, keys)
    change = np.zeros(n + 2, np.int64)
    low = np.maximum(end[once] - length, borders[of[once]])
    change += np.bincount(low, minlength=n + 2)[: n + 2]
    change -= np.bincount(start[once] + 1, minlength=n + 2)[: n + 2]
    able = np.zeros(n + 2, np.int64)
    long = np.flatnonzero(np.diff(borders) >= length)
    np.add.at(able, borders[:-1][long], 1)
    np.add.at(able, borders[1:][long] - length + 1, -1)
    able = (np.cumsum(able) > 0) & (np.cumsum(change) == 0)
    edge = np.diff(np.concatenate(([0], able[:n].astype(np.int8), [0])))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    text = np.searchsorted(borders, first, "right") - 1
    # Two texts can touch: a run of windows never reaches over a border, because the last starts of a text are not able.
    stop = last + length
    fresh = np.ones(len(first), bool)
    fresh[1:] = (first[1:] > stop[:-1]) | (text[1:] != text[:-1])
    region = np.cumsum(fresh) - 1
    begin = first[fresh]
    finish = np.maximum.reduceat(stop, np.flatnonzero(fresh)) if len(first) else stop
    sizes = finish - begin
    cuts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    held = data[np.repeat(begin, sizes) + runs(sizes)] if len(begin) else data[:0]
    used, where = np.unique(text[fresh], return_inverse=True)
    names = [row_key(ids[t], data[borders[t] : borders[t + 1]].tobytes()) for t in used.tolist()]
    return Regions(
        names, where, begin - borders[text[fresh]], held, cuts,
        first - begin[region] + cuts[region] if len(first) else first, last - first + 1,
    )


def region_rows(length: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        known = exchange.all_keys(answers)
        blocks, blobs = [], []
        for ids, data, borders in text_lists(texts):
            found = find_regions(ids, data, borders, known, length)
            if len(found.first):
                blocks.append(texts.column("block")[0].as_py())
                blobs.append(packed(found))
        return pa.table({"block": pa.array(blocks, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return run


@dataclass
class Groups:
    """Windows with the same first trigger and nearly the same distance to it."""

    windows: np.ndarray  # starts in the regions' data
    borders: np.ndarray  # of the groups among the windows
    records: np.ndarray  # two digests of what all windows of the group share, one of the whole group

    def names(self) -> np.ndarray:
        return mix(self.records[:, 0] ^ mix(self.records[:, 2]))


def group_windows(regions: Regions, length: int, one: Pieces, two: Pieces) -> Groups:
    """Groups of windows; a window in which no trigger is whole is a group of its own."""
    place, _ = triggers(regions.data, regions.borders)
    windows = regions.windows()
    at = np.searchsorted(place, windows)
    trigger = np.append(place, np.iinfo(np.int64).max // 2)[at]
    near = trigger + W <= windows + length
    gap = np.where(near, trigger - windows, 0)
    nth = gap // GROUP
    marker = np.where(near, trigger, -1 - windows)
    new = np.ones(len(windows), bool)
    new[1:] = (marker[1:] != marker[:-1]) | (nth[1:] != nth[:-1])
    first = np.flatnonzero(new)
    borders = np.append(first, len(windows))
    head = windows[first]
    tail = windows[borders[1:] - 1] if len(first) else head
    near, nth, trigger = near[first], nth[first], trigger[first]
    core = np.where(near, trigger - nth * GROUP, head)
    size = np.where(near, length - GROUP + 1, length)
    mask = np.add.reduceat(np.uint64(1) << (gap % GROUP).astype(np.uint64), first) if len(first) else np.zeros(0, np.uint64)
    kind = mix(np.where(near, nth, 10**9).astype(np.uint64))
    whole = mix(one(head, tail + length) ^ mix(two(head, tail + length) + mask))
    # A lone window is its own core, so that equal ones are equal groups.
    whole = np.where(near, whole, np.uint64(0))
    records = np.stack([mix(one(core, core + size) ^ kind), mix(two(core, core + size) + kind), whole], 1)
    return Groups(windows, borders, records.reshape(-1, 3))


def record_messages(block: int, records: np.ndarray, bits: int) -> pa.RecordBatch:
    """Records (rows of 64-bit numbers) by the highest bits of the first; equal ones at most twice."""
    order = np.lexsort(records.T[::-1])
    records = records[order]
    if len(records) > 2:
        same = (records[1:] == records[:-1]).all(1)
        third = np.zeros(len(records), bool)
        third[2:] = same[1:] & same[:-1]
        records = records[~third]
    bucket = (records[:, 0] >> np.uint64(64 - bits)).astype(np.int64)
    used, first = np.unique(bucket, return_index=True)
    last = np.append(first[1:], len(records))
    lists = [records[a:b].tobytes() for a, b in zip(first, last)]
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(np.full(len(used), block, np.int64)), pa.array(lists, pa.binary())],
        names=["bucket", "block", "keys"],
    )


def received(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    lists = [np.frombuffer(k, np.uint64).reshape(-1, width) for k in table.column("keys").to_pylist()]
    of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return np.concatenate(lists), of, table.column("block").to_pylist()


def answers_by_block(of: np.ndarray, blocks: list[int], names: np.ndarray, status: np.ndarray) -> pa.Table:
    out: list[tuple] = []
    order = np.argsort(of, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        if len(rows):
            out.append((blocks[of[rows[0]]], names[rows].tobytes(), status[rows].tobytes()))
    columns = list(zip(*out)) or [(), (), ()]
    return pa.table({
        "block": pa.array(columns[0], pa.int64()), "keys": pa.array(columns[1], pa.binary()),
        "status": pa.array(columns[2], pa.binary()),
    })


def numbered(records: np.ndarray) -> np.ndarray:
    """A number for each distinct row."""
    order = np.lexsort(records.T[::-1])
    sorted_ = records[order]
    new = np.concatenate(([0], np.cumsum((sorted_[1:] != sorted_[:-1]).any(1))))
    out = np.empty(len(records), np.int64)
    out[order] = new
    return out


def judge_groups(table: pa.Table) -> pa.Table:
    """Groups that are not plainly repeated: unique ones, and those whose windows have to be compared."""
    records, of, blocks = received(table, 3)
    core, whole = numbered(records[:, :2]), numbered(records)
    times = np.bincount(whole)[whole]
    alike = np.bincount(core)[core]
    lone = times == 1
    unsettled = np.zeros(core.max() + 1, bool)
    unsettled[core[lone & (alike > 1)]] = True
    status = np.where(alike == 1, UNIQUE, np.where(lone, OPEN, REPEATED_OPEN)).astype(np.uint8)
    told = lone | unsettled[core]
    names = mix(records[:, 0] ^ mix(records[:, 2]))
    return answers_by_block(of[told], blocks, names[told], status[told])


def judge_windows(table: pa.Table) -> pa.Table:
    """Windows that are repeated."""
    records, of, blocks = received(table, 2)
    window = numbered(records)
    again = np.bincount(window)[window] > 1
    names = mix(records[:, 0] ^ mix(records[:, 1]))
    return answers_by_block(of[again], blocks, names[again], np.zeros(int(again.sum()), np.uint8))


ANSWER = "block long, keys binary, status binary"


def ask_groups(bits: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("blob").to_pylist()):
                regions = unpacked(blob)
                found = group_windows(regions, length, Pieces(regions.data, 1), Pieces(regions.data, 2))
                yield record_messages(block, found.records, bits)

    return run


def told(answers: pa.Table, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names and status of what a block was told, sorted by name."""
    rows = answers.filter(pc.equal(answers.column("level"), level))
    names = np.frombuffer(b"".join(rows.column("keys").to_pylist()), np.uint64)
    status = np.frombuffer(b"".join(rows.column("status").to_pylist()), np.uint8)
    order = np.argsort(names, kind="stable")
    return names[order], status[order]


def group_status(groups: Groups, answers: pa.Table) -> np.ndarray:
    """Status of every group; 255 is plainly repeated."""
    names, status = told(answers, 1)
    if not len(names):
        return np.full(len(groups.records), 255, np.uint8)
    mine = groups.names()
    at = np.minimum(np.searchsorted(names, mine), len(names) - 1)
    return np.where(names[at] == mine, status[at], 255).astype(np.uint8)


def window_records(windows: np.ndarray, length: int, one: Pieces, two: Pieces) -> np.ndarray:
    return np.stack([one(windows, windows + length), two(windows, windows + length)], 1).reshape(-1, 2)


def ask_windows(bits: int, length: int):
    def run(regions: pa.Table, answers: pa.Table) -> pa.Table:
        sent = []
        for block, blob in zip(regions.column("block").to_pylist(), regions.column("blob").to_pylist()):
            found = unpacked(blob)
            one, two = Pieces(found.data, 1), Pieces(found.data, 2)
            groups = group_windows(found, length, one, two)
            status = group_status(groups, answers)
            chosen = np.repeat((status == OPEN) | (status == REPEATED_OPEN), np.diff(groups.borders))
            sent.append(record_messages(block, window_records(groups.windows[chosen], length, one, two), bits))
        return pa.Table.from_batches(sent) if sent else pa.table(
            {"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "keys": pa.array([], pa.binary())}
        )

    return run


def span_rows(length: int):
    """The removed spans of every text that has any."""

    def run(regions: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[bytes, tuple] = {}
        blocks = regions.column("block").to_pylist()
        names = told(answers, 2)[0]
        for blob in regions.column("blob").to_pylist():
            found = unpacked(blob)
            one, two = Pieces(found.data, 1), Pieces(found.data, 2)
            groups = group_windows(found, length, one, two)
            status = np.repeat(group_status(groups, answers), np.diff(groups.borders))
            again = (status == 255) | (status == REPEATED_OPEN)
            edge = np.flatnonzero(status == OPEN)
            records = window_records(groups.windows[edge], length, one, two)
            again[edge] = exchange.among(names, mix(records[:, 0] ^ mix(records[:, 1])))
            starts = groups.windows[again]
            region = np.searchsorted(found.borders, starts, "right") - 1
            starts = starts - found.borders[region] + found.at[region]
            text = found.of[region]
            if not len(starts):
                continue
            fresh = np.ones(len(starts), bool)
            fresh[1:] = (starts[1:] > starts[:-1] + length) | (text[1:] != text[:-1])
            begin = np.flatnonzero(fresh)
            finish = np.append(begin[1:], len(starts)) - 1
            for t in np.unique(text[begin]).tolist():
                mine = text[begin] == t
                out[found.keys[t]] = (starts[begin[mine]], starts[finish[mine]] + length)
        rows = [packed(out)] if out else []
        return pa.table({"block": pa.array(blocks[:1] * len(rows), pa.int64()), "spans": pa.array(rows, pa.binary())})

    return run


def cut_rows(texts: pa.Table, spans: pa.Table) -> pa.Table:
    """Every row of a block with its spans and what is left."""
    known: dict[bytes, tuple] = {}
    for blob in spans.column("spans").to_pylist():
        known.update(unpacked(blob))
    out = []
    for ids, data, borders in text_lists(texts):
        for i, doc_id in enumerate(ids):
            raw = data[borders[i] : borders[i + 1]].tobytes()
            begin, end = known.get(row_key(doc_id, raw), ((), ())) if known else ((), ())
            kept, last = [], 0
            for a, b in zip(begin, end):
                kept.append(raw[last:a])
                last = b
            kept.append(raw[last:])
            found = [{"start": int(a), "end": int(b)} for a, b in zip(begin, end)]
            out.append((doc_id, len(raw), found, b"".join(kept)))
    columns = list(zip(*out)) or [(), (), (), ()]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table({
        "doc_id": pa.array(columns[0], pa.int64()), "n_bytes": pa.array(columns[1], pa.int64()),
        "spans": pa.array(columns[2], span), "kept": pa.array(columns[3], pa.binary()),
    })


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: maximal removed runs of bytes, and the other bytes.

    A byte is removed if it lies in a string of ``length`` bytes that also starts anywhere else in the
    corpus, in the same text included; overlaps count, strings never reach from one text into another, and
    all are judged on the input. ``kept`` is binary, as a run can end inside a character. NULL texts are empty;
    NULL ids and repeated rows are rows like others (a repeated row is a copy); texts under ``length`` bytes stay
    whole; an empty table gives no rows. ``length`` has to be at least 32.
    """
    if length < 2 * GROUP:
        raise ValueError("length has to be at least 32")
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("block", exchange.block_of(rows))
    bits = exchange.bucket_bits(rows)
    asked = rows.select("block", "text").mapInArrow(ask_phrases(bits, length), exchange.MESSAGE)
    answers = exchange.repeated(asked)
    lists = rows.mapInArrow(pack_texts, "block long, blob binary")
    regions = lists.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        region_rows(length), "block long, blob binary"
    )
    regions = materialize(regions, "repeat-regions")
    asked = regions.mapInArrow(ask_groups(bits, length), exchange.MESSAGE)
    groups = asked.groupBy("bucket").applyInArrow(judge_groups, ANSWER)
    groups = materialize(groups.withColumn("level", F.lit(1)), "repeat-groups")
    asked = regions.groupBy("block").cogroup(groups.groupBy("block")).applyInArrow(
        ask_windows(bits, length), exchange.MESSAGE
    )
    windows = asked.groupBy("bucket").applyInArrow(judge_windows, ANSWER).withColumn("level", F.lit(2))
    spans = regions.groupBy("block").cogroup(groups.unionByName(windows).groupBy("block")).applyInArrow(
        span_rows(length), "block long, spans binary"
    )
    return lists.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(
        cut_rows, "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"
    )
