"""Benchmark passages in whole documents, allowing edits: q-gram filter in diagonal bands, then alignment.

Both sides are compared as normalized UTF-8: A-Z in lower case, runs of ASCII white space and punctuation
as one space. An item is searched in overlapping windows, long ones and dense short ones. A window of m bytes that occurs with at most
k edits shares at least m - q + 1 - k q of its q-grams with that place, on diagonals at most k apart. So the shared
q-grams are counted in diagonal bands 2 (k + 1) wide that overlap by half, bands under the bound are dropped,
and what is left is aligned in the band exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loticote.llm.common import gathered, runs, utf8

Q = 8
TABLE_BITS = 20
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_map() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[[*range(33), 127]] = 32
    table[[ord(c) for c in PUNCTUATION]] = 32
    return table


BYTE_MAP = byte_map()


def normalized(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalized texts with a zero byte after each, and the place of every byte in ``data``.

    The zero byte (its place is the end of its text) keeps texts apart: no q-gram of an item holds one.
    """
    mapped = BYTE_MAP[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (mapped[1:] != 32) | (mapped[:-1] != 32)
    starts = borders[:-1][borders[:-1] < borders[1:]]
    keep[starts] = True
    place = np.flatnonzero(keep)
    cuts = np.searchsorted(place, borders[1:])
    out = np.insert(mapped[place], cuts, 0)
    return out, np.insert(place, cuts, borders[1:])


def qgrams(data: np.ndarray) -> np.ndarray:
    """The Q bytes at every place, as one number."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(data) - Q + 1,), "<u8", np.ascontiguousarray(data).tobytes(), strides=(1,))


def slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)


class Patterns:
    """The windows of a block of items and an index of the items' q-grams.

    Every item has windows of ``window`` bytes, and one longer than ``passage`` also has short
    windows of ``passage`` bytes every ``step``, so that a part of it is found at any offset.
    """

    def __init__(
        self, items: list[tuple[int | None, str]], window: int, stride: int, rate: float,
        passage: int | None = None, step: int = 1,
    ):
        self.item_ids: list[int | None] = []
        self.totals: list[int] = []
        self.scales = [(window, stride)] + ([(passage, step)] if passage else [])
        bodies, starts, of = [], [[] for _ in self.scales], [[] for _ in self.scales]
        base = 0
        for item_id, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            clean = normalized(raw, np.array([0, len(raw)]))[0].tobytes()[:-1].strip(b" ")
            if len(clean) < Q:
                continue
            total = 0
            for k, (size, every) in enumerate(self.scales):
                if k and len(clean) <= min(size, window):
                    continue  # its one window is there already
                mine = np.arange(0, max(1, len(clean) - size + 1), every)
                if mine[-1] + size < len(clean):
                    mine = np.append(mine, len(clean) - size)
                starts[k].append(base + mine)
                of[k].append(np.full(len(mine), len(self.item_ids)))
                total += len(mine)
            bodies.append(np.frombuffer(clean, np.uint8))
            self.item_ids.append(item_id)
            self.totals.append(total)
            base += len(clean)
        whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        lengths = np.array([len(x) for x in bodies], np.int64)
        self.body = np.concatenate(bodies) if bodies else np.zeros(0, np.uint8)
        self.borders = np.concatenate(([0], np.cumsum(lengths)))
        # Windows of one scale are neighbours, in the order of their starts.
        self.scale_borders = np.concatenate(([0], np.cumsum([sum(map(len, x)) for x in starts])))
        self.starts = whole([x for scale in starts for x in scale])
        self.items = whole([x for scale in of for x in scale])
        limits = np.repeat([size for size, _ in self.scales], np.diff(self.scale_borders))
        self.sizes = sizes = np.minimum(self.borders[self.items + 1] - self.starts, limits)
        # The largest budget up to the rate that leaves a bound of at least one shared q-gram.
        self.budget = np.minimum((sizes * rate).astype(np.int64), np.maximum((sizes - Q) // Q, 0))
        self.bound = sizes - Q + 1 - self.budget * Q
        self.least = np.full(len(lengths), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.items, self.bound)
        self.cell = 2 * (int(self.budget.max(initial=0)) + 1)
        counts = lengths - Q + 1
        flat = np.concatenate([qgrams(x) for x in bodies]) if bodies else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.grams, self.first, self.lengths = np.unique(flat[order], return_index=True, return_counts=True)
        self.at = (np.repeat(self.borders[:-1], counts) + runs(counts))[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[slot(self.grams)] = True

    @property
    def windows(self) -> list[np.ndarray]:
        return [self.body[a : a + n] for a, n in zip(self.starts.tolist(), self.sizes.tolist())]

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, place in ``body``) of every q-gram that the text shares with an item."""
        grams = qgrams(data)
        able = np.flatnonzero(self.table[slot(grams)])
        found = grams[able]
        at = np.minimum(np.searchsorted(self.grams, found), max(len(self.grams) - 1, 0))
        real = self.grams[at] == found if len(self.grams) else np.zeros(len(found), bool)
        able, at = able[real], at[real]
        counts = self.lengths[at]
        rows = np.repeat(self.first[at], counts) + runs(counts) if len(at) else at
        return np.repeat(able, counts), self.at[rows]

    def crowded(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shared q-grams without those of item diagonals that have too few for any window.

        The band of a window is at most one cell wide, so it lies in two neighbouring cells of its item.
        """
        place, at = self.shared(data)
        item = np.searchsorted(self.borders, at, "right") - 1
        wide = (len(data) + len(self.body)) // self.cell + 3  # cells of one item are no neighbours of the next one's
        keys = item * np.int64(wide) + (place - at + len(self.body)) // self.cell + 1
        cells, where, counts = np.unique(keys, return_inverse=True, return_counts=True)
        near = np.zeros(len(cells), np.int64)
        if len(cells) > 1:
            touch = cells[1:] == cells[:-1] + 1
            near[1:] = np.where(touch, counts[:-1], 0)
            near[:-1] = np.maximum(near[:-1], np.where(touch, counts[1:], 0))
        enough = (counts + near)[where] >= self.least[item]
        return place[enough], at[enough]

    def bands(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first diagonal) of every band with enough shared q-grams."""
        place, at = self.crowded(data)
        begin = self.borders[np.searchsorted(self.borders, at, "right") - 1]
        windows, diagonals = [], []
        for (size, _), low, high in zip(self.scales, self.scale_borders[:-1], self.scale_borders[1:]):
            # The windows that hold the q-gram.
            starts = self.starts[low:high]
            first = np.searchsorted(starts, np.maximum(at - (size - Q), begin))
            counts = np.searchsorted(starts, at, "right") - first
            window = low + np.repeat(first, counts) + runs(counts)
            windows.append(window)
            diagonals.append(np.repeat(place - at, counts) + self.starts[window])
        window, diagonal = np.concatenate(windows), np.concatenate(diagonals)
        step = self.budget[window] + 1
        band = (diagonal + len(data)) // step  # shifted, so that it is never negative
        wide = 4 * len(data) + 4
        keys, counts = np.unique(window * np.int64(wide) + band, return_counts=True)
        window, band = keys // wide, keys % wide
        after = np.zeros(len(keys), np.int64)
        if len(keys) > 1:
            after[:-1] = np.where(keys[1:] == keys[:-1] + 1, counts[1:], 0)
        enough = counts + after >= self.bound[window]
        # A band also starts one step before a cell that has no cell before it.
        alone = counts >= self.bound[window]
        if len(keys) > 1:
            alone[1:] &= keys[1:] != keys[:-1] + 1
        window = np.concatenate((window[enough], window[alone]))
        band = np.concatenate((band[enough], band[alone] - 1))
        return window, band * (self.budget[window] + 1) - len(data)

    def align(self, data: np.ndarray, window: np.ndarray, diagonal: np.ndarray):
        """Banded alignment of whole windows to any place of their bands: edits, start and end."""
        edits, starts, ends = (np.zeros(len(window), np.int64) for _ in range(3))
        groups = self.sizes[window] * 1000 + self.budget[window]
        for key in np.unique(groups):
            rows = np.flatnonzero(groups == key)
            for part in np.array_split(rows, -(-len(rows) // 2000)):
                edits[part], starts[part], ends[part] = self.align_equal(data, window[part], diagonal[part])
        return edits, starts, ends

    def align_equal(self, data, window, diagonal):
        """Windows of one size and budget, all at once; places and windows along the second axis.

        Cell (d, w) at step i is byte i of the window against place low + i + d. It holds edits * one + start,
        counted from low. Windows without a cell inside of the budget are left out from then on.
        """
        size, budget = int(self.sizes[window[0]]), int(self.budget[window[0]])
        wide = 2 * (budget + 1) + 2 * budget
        low = diagonal - budget  # first diagonal of each band
        one = 1 << max(8, wide.bit_length())
        far = one * (size + wide + 2)
        kind = np.int32 if 2 * far * (size + wide) < 1 << 31 else np.int64
        left, right = max(0, -int(low.min())), max(0, int(low.max()) + size + wide - len(data))
        # Beyond the data there are zeros as between the texts; no item has one.
        padded = np.concatenate((np.zeros(left, np.uint8), data, np.zeros(right, np.uint8)))
        around = np.lib.stride_tricks.sliding_window_view(padded, size + wide)[low + left]
        bordering = (around == 0).any(axis=1)
        value = np.full(len(window), far, np.int64)
        last = np.zeros(len(window), np.int64)
        for rows, borders in ((np.flatnonzero(~bordering), False), (np.flatnonzero(bordering), True)):
            if not len(rows):
                continue
            here_of = np.ascontiguousarray(around[rows].T)
            text = np.ascontiguousarray(self.body[self.starts[window[rows]][:, None] + np.arange(size)].T)
            place = low[rows][None] + np.arange(wide)[:, None]
            start = np.broadcast_to(np.arange(wide, dtype=kind)[:, None], place.shape)
            cells = np.where((place >= 0) & (place <= len(data)), start, kind(far))
            passed = (np.arange(1, wide + 1) * one).astype(kind)[:, None]
            for i in range(size):
                here = here_of[i : i + wide]
                best = cells + (here != text[i]).astype(kind) * kind(one)
                if borders:
                    outside = here == 0
                    best += outside.astype(kind) * kind(far)
                    passed = np.cumsum(np.where(outside, kind(far), kind(one)), axis=0, dtype=kind)
                # An item byte is missing in the text, or the text has further bytes, though no border.
                np.minimum(best[:-1], cells[1:] + kind(one), out=best[:-1])
                best -= passed
                np.minimum.accumulate(best, axis=0, out=best)
                cells = best + passed
                if i % 16 == 15:
                    able = cells.min(axis=0) < (budget + 1) * one
                    if 4 * np.count_nonzero(able) < 3 * len(able):
                        rows, here_of, text, cells = rows[able], here_of[:, able], text[:, able], cells[:, able]
                        if not len(rows):
                            break
            if len(rows):
                best = cells.argmin(axis=0)
                value[rows], last[rows] = cells[best, np.arange(len(rows))], best
        return value // one, low + value % one, low + size + last

    def find(self, data: np.ndarray, borders: np.ndarray):
        """(text, window, edits, start, end) of every window that occurs; places are bytes of the texts."""
        clean, place = normalized(data, borders)
        empty = np.zeros(0, np.int64)
        if not len(self.starts) or not len(clean):
            return empty, empty, empty, empty, empty
        window, diagonal = self.bands(clean)
        if not len(window):
            return empty, empty, empty, empty, empty
        edits, start, end = self.align(clean, window, diagonal)
        good = (edits <= self.budget[window]) & (end > start)
        window, edits, start, end = window[good], edits[good], start[good], end[good]
        marks = np.flatnonzero(clean == 0)  # one after each text; texts hold none, zero bytes are mapped
        text = np.searchsorted(marks, start)
        return text, window, edits, place[start] - borders[text], place[end - 1] + 1 - borders[text]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """Items in blocks of at most ``block_bytes`` of text (one item at least), streamed to the driver."""
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")
    ).where(F.col("text").isNotNull()).distinct().orderBy("item", "text")
    block, size = [], 0
    for row in items.toLocalIterator():
        n = len(row.text.encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((row.item, row.text))
        size += n
    if block:
        yield block


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = 0.1,
    window: int = 120,
    stride: int = 60,
    block_bytes: int = 4 << 20,
    batch_bytes: int = 2 << 20,
    passage: int = 68,
    step: int = 4,
) -> DataFrame:
    """``doc_id, item_id, n_found, n_windows, edits, start, end`` for every document and item that leaks into it.

    An item leaks when one of its windows occurs with edits of at most ``rate`` of the window. Windows are
    ``window`` normalized bytes, every ``stride`` (a shorter item is one window), and ``passage`` bytes,
    every ``step``: whatever its offset, a verbatim part of an item holds a whole window from ``passage + step - 1``
    bytes on. ``n_found`` of ``n_windows`` windows occur;
    ``edits`` is the least number; ``start`` and ``end`` are code points of the text around the windows found.
    Budgets are at most (m - q) / q, as the filter bound must be positive. Items that are NULL or shorter
    than q normalized bytes match nothing, NULL and empty texts match nothing, NULL ids stay NULL; repeated
    items count once, repeated documents each; empty tables give no rows.

    Documents never move: each block of items (at most ``block_bytes``, so its size is bounded) goes to
    the tasks, and a larger benchmark takes one pass over the documents for each block.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, n_found long, n_windows long, edits long, start long, end long"
    out = df.sparkSession.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        out = out.unionByName(rows.mapInArrow(leak_rows(Patterns(block, window, stride, rate, passage, step), batch_bytes), schema))
    return out


def leak_rows(patterns: Patterns, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", batch_bytes):
            data, borders = utf8(batch.column("text"))
            found: dict[tuple, list] = {}
            seen = set()
            for t, w, e, s, end in zip(*(x.tolist() for x in patterns.find(data, borders))):
                i = patterns.items[w]
                row = found.setdefault((t, patterns.item_ids[i], patterns.totals[i]), [0, e, s, end])
                row[0] += (t, w) not in seen
                seen.add((t, w))
                row[1:] = [min(row[1], e), min(row[2], s), max(row[3], end)]
            ids = batch.column("doc_id").to_pylist()
            out = []
            for (t, item, total), (n, e, s, end) in found.items():
                raw = data[borders[t] : borders[t + 1]].tobytes()
                chars = [len(raw[:x].decode("utf-8", "ignore")) for x in (s, end)]
                out.append((ids[t], item, n, total, e, *chars))
            names = ["doc_id", "item_id", "n_found", "n_windows", "edits", "start", "end"]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def drop_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = 0.1,
    window: int = 120,
    stride: int = 60,
    block_bytes: int = 4 << 20,
    batch_bytes: int = 2 << 20,
    passage: int = 68,
    step: int = 4,
) -> DataFrame:
    """The rows into which no item leaks, with all their columns; the text column has to be a string."""
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        df = df.mapInArrow(clean_rows(Patterns(block, window, stride, rate, passage, step), text_col, batch_bytes), StructType(df.schema.fields))
    return df


def clean_rows(patterns: Patterns, text_col: str, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, text_col, batch_bytes):
            data, borders = utf8(batch.column(text_col))
            clean = np.ones(batch.num_rows, bool)
            clean[patterns.find(data, borders)[0]] = False
            yield batch.filter(pa.array(clean))

    return run
