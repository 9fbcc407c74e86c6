"""Scores of whole texts by context mixing over bits, and the smoothed unigram score of their words.

Model: the last three, four and five bytes each predict the bits of the next byte from the counts of all training
texts after the same bytes. A gate, the longest of these contexts that training knows, and the place of the bit
select the weights that combine the predictions in the logistic domain. The weights start from values fitted to
all training texts, each byte without its own counts, and each text refines its own ones after every SPAN bytes, from its
first byte to its last. A text ends with the byte 255, which UTF-8 never holds, so probabilities of all texts
sum to at most one.

Counts stay distributed and grow with the corpus. Each block of documents sends its distinct grams, a byte after
its longest context, with their training counts, by bucket of the shortest context: a bucket meets all grams with
the same shorter contexts. It adds up the blocks' counts and answers every pair of context and byte with the
eight predictions on the way to its byte. As it knows all predictions of its grams, it also counts what the fit needs:
how often training has the same predictions, gate and place of the bit. The fit adds up its steps over these counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loticote.llm import exchange
from loticote.llm.common import gathered, utf8
from loticote.llm.hashing import digests, mix
from loticote.llm.shingles import SPACE
from loticote.session import materialize

PAD = 8
END = 255
ORDERS = (3, 4, 5)
CONTEXTS = len(ORDERS)
INPUTS = CONTEXTS + 1  # and a constant
GRAM = max(ORDERS) + 1
SPAN = 32
FIRST_WEIGHT = 0.45
UNIT = 12  # predictions are sent in twelfths
UNKNOWN = -128  # instead of the first prediction: training does not know the context
PRIOR = 0.05
BLOCK_IDS = 4096
BLOCK_BYTES = 16 << 20
LONG_TEXT = 64 << 10
HELD_GRAMS = 3 << 20
SIDE_BY_SIDE = 192
FIT_BLOCK = -(1 << 62) - 1
FIT_STEPS = 12
FIT_SLICES = 64
FIT_CLOSE = 1e-6
RIDGE = 20.0


def framed(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with PAD zero bytes before and END after each; starts and sizes (with END)."""
    sizes = np.diff(borders)
    starts = borders[:-1] + PAD + np.arange(len(sizes)) * (PAD + 1)
    out = np.zeros(len(data) + len(sizes) * (PAD + 1) + PAD, np.uint8)
    shift = np.repeat(starts - borders[:-1], sizes)
    out[np.arange(len(data)) + shift] = data
    out[starts + sizes] = END
    return out, starts, sizes + 1


def plain(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as their words in lower case with one space between: what is modelled."""
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + np.uint8(32), data)
    space = SPACE[data]
    data[space] = 32
    first = np.zeros(len(data) + 1, bool)
    first[borders] = True
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1]) | first[1:-1]
    keep &= ~(space & first[:-1])  # none before the first word
    borders = np.concatenate(([0], np.cumsum(keep)))[borders]
    data = data[keep]
    # nor after the last one
    last = borders[1:][borders[1:] > borders[:-1]] - 1
    drop = np.zeros(len(data), bool)
    drop[last] = data[last] == 32
    return data[~drop], np.concatenate(([0], np.cumsum(~drop)))[borders]


def bits_of(byte: np.ndarray) -> np.ndarray:
    return (byte[..., None] >> np.arange(7, -1, -1, dtype=np.uint8)) & np.uint8(1)


SIGNS = bits_of(np.arange(256, dtype=np.uint8)).astype(np.float32) * 2 - 1


def text_grams(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the texts and their ends with the bytes before it, as one number, and the borders.

    The byte itself is the highest one, so that in sorted numbers those that agree in a shorter context
    and the byte are neighbours.
    """
    text, starts, sizes = framed(data, borders)
    eight = np.ndarray((len(text) - 7,), "<u8", text.tobytes(), strides=(1,))
    borders = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(borders[-1]) + np.repeat(starts - borders[:-1], sizes)
    return eight[at - 7] >> np.uint64(8 * (8 - GRAM)), borders


def distinct_of(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values (``np.unique`` takes several times as long by its hash table)."""
    values = np.sort(values)
    return values[changes(values)]


def ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the place of each value among them."""
    order = np.argsort(values)
    values = values[order]
    new = changes(values)
    where = np.empty(len(values), np.int32)
    where[order] = np.cumsum(new, dtype=np.int32) - 1
    return values[new], where


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several lists and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    distinct, where = ranks(np.concatenate(keys))
    return distinct, np.bincount(where, np.concatenate(counts), len(distinct)).astype(np.int64)


def changes(x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    out[1:] = x[1:] != x[:-1]
    return out


def context_hash(order: int, context: np.ndarray) -> np.ndarray:
    """A bijection of order and context to 56 bits."""
    low, half = np.uint64((1 << 56) - 1), np.uint64(28)
    x = context | np.uint64(ORDERS.index(order) << 48)
    for factor in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
        x = ((x ^ (x >> half)) * np.uint64(factor)) & low
    return x ^ (x >> half)


class Pairs:
    """The distinct pairs of context and byte in sorted distinct grams: their keys, and which a gram has."""

    def __init__(self, grams: np.ndarray):
        keys, self.of = [], []
        total = 0
        for order in ORDERS:
            short = grams >> np.uint64(8 * (GRAM - 1 - order))
            new = changes(short)
            self.of.append(np.cumsum(new) - 1 + total)
            short = short[new]
            context = short & np.uint64((1 << (8 * order)) - 1)
            keys.append((context_hash(order, context) << np.uint64(8)) | (short >> np.uint64(8 * order)))
            total += len(short)
        keys = np.concatenate(keys)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def counts(self, of_grams: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.keys), np.int64)
        for of in self.of:
            if len(of):
                total += np.bincount(of, of_grams, len(total)).astype(np.int64)
        return total[self.order]

    def by_pair(self, odds: np.ndarray) -> np.ndarray:
        """What is in the order of the keys, as ``of`` counts the pairs."""
        out = np.empty_like(odds)
        out[self.order] = odds
        return out

    def rows(self, odds: np.ndarray, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        """(grams, contexts, 8) of some grams from what is in the order of the keys."""
        odds = self.by_pair(odds)
        return np.stack([odds[of[some]] for of in self.of], 1)


def gram_buckets(grams: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted grams by bucket, and their buckets in this order."""
    least = min(ORDERS)
    context = (grams >> np.uint64(8 * (GRAM - 1 - least))) & np.uint64((1 << (8 * least)) - 1)
    bucket = (mix(context) >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order].astype(np.int64)


def by_length(docs: pa.Table) -> pa.Table:
    """Rows with the longest texts first, so that texts of like length run side by side."""
    sizes = np.diff(utf8(docs.column("text"))[1])
    return docs.take(pa.array(np.argsort(-sizes, kind="stable")))


def batches_of(docs: pa.Table, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    columns = [c.combine_chunks() for c in docs.columns]
    whole = pa.RecordBatch.from_arrays(columns, names=docs.column_names)
    return gathered(iter([whole]), "text", batch_bytes)


def held_rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("held_out").to_numpy(zero_copy_only=False)


def words(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in lower case, each text's end last, and the borders by text."""
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + np.uint8(32), data)
    inside = ~SPACE[data]
    new_text = np.zeros(len(data) + 1, bool)
    new_text[borders] = True
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1] | new_text[1:-1]
        ends[:-1] &= ~inside[1:] | new_text[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    found = digests(data, start, end)
    cuts = np.searchsorted(start, borders)
    out = np.insert(found, cuts[1:], mix(np.array([END], np.uint64))[0])
    return out, cuts + np.arange(len(cuts))


def slices_of(bucket: np.ndarray) -> dict[int, slice]:
    used, first = np.unique(bucket, return_index=True)
    return dict(zip(used.tolist(), map(slice, first.tolist(), [*first[1:].tolist(), len(bucket)])))


ASKED = "bucket int, bits int, block long, words binary, word_counts binary, grams binary, gram_counts binary"


class Asked:
    """Distinct words and grams of some texts of a block, with their training counts."""

    def __init__(self):
        self.words, self.grams = ([], []), ([], [])

    def add(self, batch: pa.RecordBatch, counts: bool) -> None:
        data, borders = utf8(batch.column("text"))
        train = ~held_rows(batch) & counts
        found, cuts = words(data, borders)
        grams, ends = text_grams(*plain(data, borders))
        for values, lengths, (keys, times) in ((found, np.diff(cuts), self.words), (grams, np.diff(ends), self.grams)):
            counted = np.repeat(train, lengths)
            distinct, n = np.unique(values[counted], return_counts=True)
            other = distinct_of(values[~counted])
            keys += [distinct, other]
            times += [n, np.zeros(len(other), np.int64)]

    def messages(self, block: int | None, bits: int) -> pa.RecordBatch:
        found, times = merged(*self.words)
        grams, gram_times = merged(*self.grams)
        order, bucket = gram_buckets(grams, bits)
        grams, gram_times = grams[order], gram_times[order]
        word_slices, gram_slices = slices_of((found >> np.uint64(64 - bits)).astype(np.int64)), slices_of(bucket)
        used = sorted(word_slices.keys() | gram_slices.keys())
        none = slice(0, 0)
        cut = lambda x, slices: pa.array([packed(x[slices.get(b, none)]) for b in used], pa.binary())
        columns = [
            pa.array(used, pa.int32()),
            pa.array([bits] * len(used), pa.int32()),
            pa.array([block] * len(used), pa.int64()),
            cut(found, word_slices),
            cut(times.astype(np.uint32), word_slices),
            cut(grams, gram_slices),
            cut(gram_times.astype(np.uint32), gram_slices),
        ]
        names = ["bucket", "bits", "block", "words", "word_counts", "grams", "gram_counts"]
        return pa.RecordBatch.from_arrays(columns, names=names)


def asker(bits: int, batch_bytes: int):
    """Each block's distinct words and grams, with their training counts, by bucket."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Asked] = {}
        size = 0
        for batch in gathered(batches, "text", batch_bytes):
            blocks, of = np.unique(batch.column("block").to_numpy(zero_copy_only=False), return_inverse=True)
            for i, block in enumerate(blocks.tolist()):
                asked = held.setdefault(block, Asked())
                asked.add(batch.take(pa.array(np.flatnonzero(of == i))), block != FIT_BLOCK)
                size += sum(map(len, asked.grams[0][-2:]))
            if size > HELD_GRAMS:
                yield from (asked.messages(block, bits) for block, asked in held.items())
                held, size = {}, 0
        yield from (asked.messages(block, bits) for block, asked in held.items())

    return ask


def summed(table: pa.Table, keys: str, counts: str) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Distinct keys of all blocks, their sums, and where the distinct keys of each block are among them."""
    mine = [unpacked(k, np.uint64) for k in table.column(keys).to_pylist()]
    times = np.concatenate([unpacked(c, np.uint32) for c in table.column(counts).to_pylist()])
    distinct, where = ranks(np.concatenate(mine))
    totals = np.bincount(where, times, len(distinct)).astype(np.int64)
    of: dict[int, list[np.ndarray]] = {}
    for block, at in zip(table.column("block").to_pylist(), np.split(where, np.cumsum([len(k) for k in mine])[:-1])):
        of.setdefault(block, []).append(at)
    # Several tasks may have asked for one block.
    return distinct, totals, {b: distinct_of(np.concatenate(at)) if len(at) > 1 else at[0] for b, at in of.items()}


def path_counts(keys: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of context and byte and each bit of the byte: training counts at the place the bits before
    it lead to, those that go the same way and all."""
    byte = (keys & np.uint64(255)).astype(np.int64)
    context = np.cumsum(changes(keys >> np.uint64(8)))
    same, every = np.zeros((2, len(keys), 8), np.int64)
    for depth in range(8):
        node = np.cumsum(changes(context << depth | byte >> (8 - depth))) - 1
        way = 2 * node + (byte >> (7 - depth) & 1)
        sums = np.bincount(way, totals, 2 * (int(node[-1]) + 1) if len(node) else 0)
        same[:, depth] = sums[way]
        every[:, depth] = sums[way] + sums[way ^ 1]
    return same, every


def log_odds(same: np.ndarray, every: np.ndarray) -> np.ndarray:
    """Predictions in favour of the bit that came; the first one is UNKNOWN if the context was never seen."""
    odds = np.log((same + PRIOR) / (every - same + PRIOR))
    out = np.clip(np.round(odds * UNIT), -127, 127).astype(np.int8)
    out[every[:, 0] == 0, 0] = UNKNOWN
    return out


def fit_counts(odds: np.ndarray, byte: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often training has each gate, place of the bit, predictions and bit: distinct codes and their counts.

    ``odds`` are those of grams without their own counts: (grams, contexts, 8).
    """
    known = odds[:, :, 0] != UNKNOWN
    odds = odds.copy()
    odds[:, :, 0] *= known
    code = known.sum(1)[:, None] << 3 | np.arange(8)
    for k in range(CONTEXTS):
        code = code << 8 | odds[:, k].view(np.uint8)
    return merged([(code << 1 | bits_of(byte)).ravel().astype(np.uint64)], [np.repeat(times, 8)])


def fit_inputs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gate and place of the bit as one number, and (INPUTS, codes): the predictions and the constant."""
    code = code.astype(np.int64)
    shifts = 1 + 8 * np.arange(CONTEXTS)[::-1, None]
    odds = (code >> shifts & 255).astype(np.uint8).view(np.int8)
    return code >> (1 + 8 * CONTEXTS), np.concatenate([odds / UNIT, ((code & 1) * 2.0 - 1)[None]])


def fit_terms(code: np.ndarray, times: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(gate and place, INPUTS + INPUTS ** 2): slope and curvature of the log likelihood of some codes."""
    out = np.zeros(((CONTEXTS + 1) * 8, INPUTS + INPUTS**2))
    group, x = fit_inputs(code)
    w = weights.transpose(0, 2, 1).reshape(-1, INPUTS)
    borders = np.searchsorted(group, np.arange(len(out) + 1))  # codes are sorted
    for g, (first, last) in enumerate(zip(borders[:-1], borders[1:])):
        mine, n = x[:, first:last], times[first:last]
        missed = 1 / (1 + np.exp(np.clip(w[g] @ mine, -30, 30)))
        out[g, :INPUTS] = mine @ (n * missed)
        out[g, INPUTS:] = ((mine * (n * missed * (1 - missed))) @ mine.T).ravel()
    return out


def stepped(weights: np.ndarray, terms: np.ndarray, ridge: float) -> np.ndarray:
    """The weights after one Newton step of ridge logistic regression, by gate and place of the bit."""
    start, out = first_weights(), weights.copy()
    for g, row in enumerate(terms):
        gate, bit = divmod(g, 8)
        slope = row[:INPUTS] - ridge * (weights[gate, :, bit] - start[gate, :, bit])
        bend = row[INPUTS:].reshape(INPUTS, INPUTS) + ridge * np.eye(INPUTS)
        out[gate, :, bit] += np.clip(np.linalg.solve(bend, slope), -0.5, 0.5)
    return out


ANSWERED = (
    "bucket int, bits int, block long, words binary, word_counts binary, odds array<binary>, "
    "codes binary, code_counts binary"
)


def answer(table: pa.Table) -> pa.Table:
    """For one bucket: to every block its words that occur in training, with their counts over the corpus, and the
    predictions of its pairs of context and byte, by length of the context in the order of its grams; one row without a
    block holds the number of distinct training words and of all, and what training has for the
    fit. To the block of a fit to chosen texts each pair is answered without one of its own."""
    distinct, totals, words_of = summed(table, "words", "word_counts")
    grams, gram_totals, grams_of = summed(table, "grams", "gram_counts")
    pairs = Pairs(grams)
    same, every = path_counts(pairs.keys, pairs.counts(gram_totals))
    odds = pairs.by_pair(log_odds(same, every))
    # A pair that training does not know is in no gram that the fit counts.
    without = log_odds(np.maximum(same - 1, 0), np.maximum(every - 1, 0))
    trained = np.flatnonzero(gram_totals)
    byte = (grams[trained] >> np.uint64(8 * (GRAM - 1))).astype(np.uint8)
    codes, code_counts = fit_counts(pairs.rows(without, trained), byte, gram_totals[trained])
    without = pairs.by_pair(without)
    counted = np.array([np.count_nonzero(totals), totals.sum()], np.int64).tobytes()
    rows = [(None, b"", counted, None, packed(codes.astype(np.uint32)), packed(code_counts))]
    for block, place in words_of.items():
        place, mine = place[totals[place] > 0], grams_of[block]
        told = []
        for of in pairs.of:
            asked = of[mine]
            told.append(packed((odds if block != FIT_BLOCK else without)[asked[changes(asked)]]))
        rows.append((block, packed(distinct[place]), packed(totals[place]), told, b"", b""))
    names = list(zip(*rows))
    return pa.table({
        "bucket": pa.array([table.column("bucket")[0].as_py()] * len(rows), pa.int32()),
        "bits": pa.array([table.column("bits")[0].as_py()] * len(rows), pa.int32()),
        "block": pa.array(names[0], pa.int64()),
        "words": pa.array(names[1], pa.binary()),
        "word_counts": pa.array(names[2], pa.binary()),
        "odds": pa.array(names[3], pa.list_(pa.binary())),
        "codes": pa.array(names[4], pa.binary()),
        "code_counts": pa.array(names[5], pa.binary()),
    })


class Block:
    """The texts of a block, longest first, and what the corpus predicts for each of their grams."""

    def __init__(self, docs: pa.Table, answers: pa.Table, batch_bytes: int):
        self.docs = by_length(docs)
        self.batches, grams = [], []
        for batch in batches_of(self.docs, batch_bytes):
            found, borders = text_grams(*plain(*utf8(batch.column("text"))))
            distinct, where = ranks(found)
            grams.append(distinct)
            self.batches.append((batch, distinct, where, borders))
        self.grams = distinct_of(np.concatenate(grams))
        odds = self.told(answers.select(["bucket", "bits", "odds"]).sort_by("bucket"))
        known = odds[:, :, 0] != UNKNOWN
        odds[:, :, 0] *= known
        self.known = known
        self.gate = known.sum(1)
        self.odds = odds
        self.byte = (self.grams >> np.uint64(8 * (GRAM - 1))).astype(np.uint8)

    def told(self, answers: pa.Table) -> np.ndarray:
        """(grams, contexts, 8) from the answers in the order of the buckets."""
        order, _ = gram_buckets(self.grams, answers.column("bits")[0].as_py())
        out = np.empty((len(order), CONTEXTS, 8), np.int8)
        answers = answers.column("odds").to_pylist()
        for k, context in enumerate(ORDERS):
            odds = np.concatenate([unpacked(told[k], np.int8) for told in answers]).reshape(-1, 8)
            pair = np.cumsum(changes((self.grams >> np.uint64(8 * (GRAM - 1 - context)))[order])) - 1
            out[order, k] = odds[pair]
        return out

    def inputs(self, rows: slice) -> np.ndarray:
        """(INPUTS, grams, 8): the predictions and the constant, in favour of the bit that came."""
        odds = self.odds[rows].transpose(1, 0, 2) * np.float32(1 / UNIT)
        return np.concatenate([odds, SIGNS[self.byte[rows]][None]])


def first_weights() -> np.ndarray:
    out = np.full((CONTEXTS + 1, INPUTS, 8), FIRST_WEIGHT)
    out[:, CONTEXTS] = 0
    return out


def fit_weights(block: Block, ridge: float = RIDGE) -> np.ndarray:
    """Start weights by gate and place of the bit, from the texts of one block."""
    times = np.zeros(len(block.grams), np.int64)
    for _, distinct, where, _ in block.batches:
        times[np.searchsorted(block.grams, distinct)] += np.bincount(where, minlength=len(distinct))
    odds = block.odds.copy()
    odds[:, :, 0][~block.known] = UNKNOWN
    codes, counts = fit_counts(odds, block.byte, times)
    out = first_weights()
    for _ in range(FIT_STEPS):
        out = stepped(out, fit_terms(codes, counts, out), ridge)
    return out


def fitter(batch_bytes: int):
    def fit(docs: pa.Table, answers: pa.Table) -> pa.Table:
        return pa.table({"weights": pa.array([fit_weights(Block(docs, answers, batch_bytes)).ravel().tolist()])})

    return fit


def merge_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a task's buckets, equal codes added up, by slice of the codes."""
    held: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])

    def sent() -> pa.RecordBatch:
        codes, counts = merged(*held)
        part = mix(codes) % np.uint64(FIT_SLICES)
        mine = [np.flatnonzero(part == i) for i in range(FIT_SLICES)]
        columns = [
            pa.array(range(FIT_SLICES), pa.int32()),
            pa.array([packed(codes[i].astype(np.uint32)) for i in mine], pa.binary()),
            pa.array([packed(counts[i]) for i in mine], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["slice", "codes", "code_counts"])

    for batch in batches:
        for codes, counts in zip(batch.column("codes"), batch.column("code_counts")):
            held[0].append(unpacked(codes.as_py(), np.uint32).astype(np.uint64))
            held[1].append(unpacked(counts.as_py(), np.int64))
            if sum(map(len, held[0])) > HELD_GRAMS:
                yield sent()
                held = ([], [])
    yield sent()


def merge_slice(table: pa.Table) -> pa.Table:
    codes = [unpacked(x, np.uint32).astype(np.uint64) for x in table.column("codes").to_pylist()]
    codes, counts = merged(codes, [unpacked(x, np.int64) for x in table.column("code_counts").to_pylist()])
    return pa.table({
        "codes": pa.array([packed(codes.astype(np.uint32))], pa.binary()),
        "code_counts": pa.array([packed(counts)], pa.binary()),
    })


def term_adder(weights: np.ndarray):
    """The terms of a step over the counts of a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(((CONTEXTS + 1) * 8, INPUTS + INPUTS**2))
        for batch in batches:
            for codes, counts in zip(batch.column("codes"), batch.column("code_counts")):
                total += fit_terms(unpacked(codes.as_py(), np.uint32), unpacked(counts.as_py(), np.int64), weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["place", "term"]
        )

    return add


def fit_all(answers: DataFrame, ridge: float = RIDGE) -> np.ndarray:
    """Start weights from all training texts: the counts of all buckets are added up, then every step adds up its terms
    over them."""
    counts = answers.where("block is null").select("codes", "code_counts")
    counts = counts.mapInArrow(merge_codes, "slice int, codes binary, code_counts binary")
    counts = counts.groupBy("slice").applyInArrow(merge_slice, "codes binary, code_counts binary")
    counts = materialize(counts, "fit-counts")
    out = first_weights()
    for _ in range(FIT_STEPS):
        terms = counts.mapInArrow(term_adder(out), "place int, term double").groupBy("place").agg(F.sum("term").alias("term"))
        found = np.zeros((CONTEXTS + 1) * 8 * (INPUTS + INPUTS**2))
        for row in terms.collect():
            found[row.place] = row.term
        before, out = out, stepped(out, found.reshape((CONTEXTS + 1) * 8, -1), ridge)
        if np.abs(out - before).max() < FIT_CLOSE:
            break
    return out


def gram_tables(block: Block, weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Predictions of each gram, eight to a word, and their mixture under the start weights; the last row is for no byte."""
    n = len(block.grams)
    odds = [np.zeros(n + 1, np.int64) for _ in ORDERS]
    for k, table in enumerate(odds):
        table[:n] = np.ascontiguousarray(block.odds[:, k]).view(np.int64)[:, 0]
    mixed = np.full((n + 1, 8), 30, np.float32)
    weights = weights.astype(np.float32)
    for first in range(0, n, 1 << 14):
        part = slice(first, min(first + (1 << 14), n))
        mixed[part] = np.einsum("kgb,gkb->gb", block.inputs(part), weights[block.gate[part]])
    return odds, mixed


def text_bits(
    odds: list[np.ndarray], mixed: np.ndarray, byte: np.ndarray, gram: np.ndarray, borders: np.ndarray, rate: float
) -> np.ndarray:
    """Total bits of every text, its end included; ``gram`` has the row of each byte.

    SIDE_BY_SIDE texts of like length advance together, few enough to stay in the cache.
    """
    lengths = np.diff(borders)
    out = np.zeros(len(lengths))
    order = np.argsort(-lengths, kind="stable")
    signs = np.concatenate([SIGNS[byte], np.zeros((1, 8), np.float32)])
    for first in range(0, len(order), SIDE_BY_SIDE):
        some = order[first : first + SIDE_BY_SIDE]
        out[some] = side_by_side(odds, mixed, signs, gram, borders[some], lengths[some], np.float32(rate))
    return out


def side_by_side(
    odds: list[np.ndarray], mixed: np.ndarray, signs: np.ndarray, gram: np.ndarray, begin: np.ndarray, sizes: np.ndarray, rate: np.float32
) -> np.ndarray:
    refined = np.zeros((INPUTS, len(sizes), 8), np.float32)
    total = np.zeros(len(sizes))
    nothing = len(mixed) - 1
    places = np.arange(SPAN)[:, None]
    for first in range(0, int(sizes[0]), SPAN):
        m = int(np.searchsorted(-sizes, -first, "left"))
        at = begin[:m] + (first + places)
        row = gram.take(at, mode="clip")
        if sizes[m - 1] < first + SPAN:
            row[first + places >= sizes[:m]] = nothing
        z = mixed.take(row, axis=0)
        inputs = [table.take(row).view(np.int8).reshape(z.shape) * np.float32(1 / UNIT) for table in odds]
        inputs.append(signs.take(row, axis=0))
        w = refined[:, :m]
        for k, x in enumerate(inputs):
            z += x * w[k]
        np.clip(z, -12, 30, out=z)
        np.negative(z, out=z)
        against = np.exp(z, out=z)
        spent = 1 + against
        against /= spent
        against *= rate
        total[:m] += np.log(spent, out=spent).sum(0).sum(1)
        for k, x in enumerate(inputs):
            x *= against
            w[k] += x.sum(0)
    return total / np.log(2)


SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, bits_per_byte double"
)


def scorer(weights: np.ndarray, vocabulary: int, total: int, rate: float, batch_bytes: int):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys = np.concatenate([unpacked(x, np.uint64) for x in answers.column("words").to_pylist()])
        counts = np.concatenate([unpacked(x, np.int64) for x in answers.column("word_counts").to_pylist()])
        ranked = np.argsort(keys)
        keys, counts = keys[ranked], counts[ranked]
        block = Block(docs, answers, batch_bytes)
        odds, mixed = gram_tables(block, weights)
        out = []
        for batch, distinct, where, borders in block.batches:
            found, cuts = words(*utf8(batch.column("text")))
            asked, again = ranks(found)
            at = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
            c = np.where(keys[at] == asked, counts[at], 0) if len(keys) else np.zeros(len(asked), np.int64)
            logs = np.log10((c + 1) / (total + 1.0 * (vocabulary + 1)))
            gram = np.searchsorted(block.grams, distinct).astype(np.int32)[where]
            spent = text_bits(odds, mixed, block.byte, gram, borders, rate)
            out.append(pa.table({
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "n_tokens": pa.array(np.diff(cuts)),
                "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64)[again], cuts[:-1])),
                "train_tokens": pa.array(np.full(batch.num_rows, total, np.int64)),
                "base_score": pa.array(np.add.reduceat(logs[again], cuts[:-1])),
                "score": pa.array(-spent * np.log10(2.0)),
                "bits_per_byte": pa.array(spent / np.maximum(np.diff(borders) - 1, 1)),
            }))
        return pa.concat_tables(out)

    return score


def text_block(rows: DataFrame) -> Column:
    """Blocks of neighbours as in ``exchange``, of about BLOCK_BYTES and at most BLOCK_IDS ids."""
    size, n = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    ids = min(BLOCK_IDS, max(1, BLOCK_BYTES * n // max(size or 0, 1)))
    return exchange.block_of(rows, ids=ids, long_text=LONG_TEXT)


def fit_rows(train: DataFrame, texts: int) -> DataFrame:
    """The ``texts`` training rows of the smallest digests, without empty and long texts; equal rows once."""
    mark = F.xxhash64("text", "doc_id")
    rows = train.where(F.octet_length("text").between(1, LONG_TEXT - 1)).withColumn("mark", mark)
    last = rows.select("mark").distinct().orderBy("mark").limit(texts).agg(F.max("mark")).first()[0]
    return rows.where(F.col("mark") <= F.lit(last).cast("long")).dropDuplicates(["mark"]).drop("mark")


def score_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: float = 0.008,
    batch_bytes: int = 4 << 20,
    fit_texts: int | None = None,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every row.

    Training texts are those whose crc32(id) mod 7 is not 2. ``base_score`` is the sum of log10((c + 1) /
    (N + V + 1)) over the words in lower case and one end per text; words are compared by 64-bit hashes.
    ``score`` is log10 of the probability of the same words and end, as bytes with one space between
    words; ``bits_per_byte`` is the same per such byte. NULL is the empty text: one
    token. NULL ids count as training rows; repeated rows count and are scored each; an empty
    table gives no rows. Counts of words and contexts and the start weights cover all training texts and stay
    distributed. ``fit_texts`` fits the start weights to at most so many of them instead, chosen by digest among those
    below LONG_TEXT bytes; zero keeps the constants.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("held_out", held_out).withColumn("block", text_block(rows))
    bits = exchange.bucket_bits(rows)
    asking = rows
    if fit_texts is not None:
        fit = fit_rows(rows.where(~F.col("held_out")), fit_texts).withColumn("block", F.lit(FIT_BLOCK).cast("long"))
        asking = rows.unionByName(fit)
    sent = asking.mapInArrow(asker(bits, batch_bytes), ASKED)
    answers = materialize(sent.groupBy("bucket").applyInArrow(answer, ANSWERED), "context-counts")
    vocabulary = total = 0
    for row in answers.where("block is null").select("word_counts").toLocalIterator():
        distinct, n = np.frombuffer(row.word_counts, np.int64).tolist()
        vocabulary, total = vocabulary + distinct, total + n
    if fit_texts is None:
        weights = fit_all(answers)
    else:
        fitted = answers.where(F.col("block") == FIT_BLOCK).groupBy("block")
        fitted = fit.groupBy("block").cogroup(fitted).applyInArrow(fitter(batch_bytes), "weights array<double>").collect()
        weights = np.array(fitted[0].weights).reshape(first_weights().shape) if fitted else first_weights()
    grouped = answers.where(F.col("block") != FIT_BLOCK).drop("codes", "code_counts").groupBy("block")
    return rows.groupBy("block").cogroup(grouped).applyInArrow(scorer(weights, vocabulary, total, rate, batch_bytes), SCHEMA)
