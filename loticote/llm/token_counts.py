"""Token counts of whole documents, exactly as a tokenizer of the ``tokenizers`` library gives them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loticote.llm.common import strings, sub_batches, text_rows, utf8

# White space under every definition in use: a piece never holds it, so it ends whatever stands before.
STABLE = " \n\t\r"


class ChunkEncoder:
    """Token starts of chunks. The encoding of a word, as the tokenizer gives it, is kept and used again.

    At most ``memory_words`` words, of 64 characters each on average, are kept; then the store is emptied.
    """

    def __init__(self, tokenizer, memory_words: int):
        self.tokenizer, self.memory = tokenizer, memory_words
        self.forget()

    def forget(self) -> None:
        self.known, self.chars = {}, 0
        # Starts of the tokens of all known words, and where each word's begin.
        self.starts, self.places = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        if len(self.known) + len(words) > self.memory or self.chars > 64 * self.memory:
            self.forget()
        new = [w for w in words if w not in self.known]
        starts, ends = [self.starts], [self.places]
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            found = [e.offsets for e in self.tokenizer.encode_batch(part, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            starts.append(np.fromiter((a for e in found for a, _ in e), np.int32, int(sizes.sum())))
            ends.append(ends[-1][-1] + np.cumsum(sizes))
            self.known.update(zip(part, range(len(self.known), len(self.known) + len(part))))
        if new:
            self.starts, self.places = np.concatenate(starts), np.concatenate(ends)
            self.chars += sum(map(len, new))

    def encode(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The starts of the tokens of all chunks, in characters of their chunk, and the borders of the chunks."""
        data, borders = utf8(chunks)
        table = np.arange(256, dtype=np.uint8)
        table[[ord(c) for c in STABLE]] = 32
        lists = pc.split_pattern(strings(table[data], borders), " ")
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn(words)
        at = coded.indices.to_numpy()
        chars = np.fromiter(map(len, words), np.int64, len(words))[at]
        known = np.fromiter((self.known[w] for w in words), np.int64, len(words))[at]
        firsts = lists.offsets.to_numpy()
        ends = np.concatenate(([0], np.cumsum(chars + 1)))
        place = ends[:-1] - np.repeat(ends[firsts[:-1]], np.diff(firsts))
        from_ = self.places[known]
        sizes = self.places[known + 1] - from_
        upto = np.concatenate(([0], np.cumsum(sizes)))
        inner = np.arange(upto[-1]) + np.repeat(from_ - upto[:-1], sizes)
        return np.repeat(place, sizes) + self.starts[inner], upto[firsts]


class OverlapCounter:
    """Counts the tokens of texts from overlapping chunks.

    Each chunk is encoded with offsets. Two neighbours are spliced at a place of their overlap where a
    token starts in both and white space stands before it: the tokenizer drops white space and never
    looks across it, so the tokens on either side of that place are those of the whole text. The tokens
    of both chunks from there to the last such place must agree as well. Where the overlap has no such
    place (a very long word), it is widened by doubling, at last to the whole of both chunks.
    """

    def __init__(self, tokenizer, chunk_chars: int, overlap_chars: int, memory_words: int = 400_000):
        self.encoder = ChunkEncoder(tokenizer, memory_words)
        self.chunk, self.overlap = chunk_chars, overlap_chars
        self.widened = 0

    def chunks(self, size: int) -> list[tuple[int, int]]:
        """The chunks of a text, where no overlap has to be widened."""
        step = max(1, self.chunk - self.overlap)
        return [(i, min(i + self.chunk, size)) for i in range(0, max(1, size - self.overlap), step)]

    def splice(self, text: str, left: np.ndarray, right: np.ndarray, begin: int, end: int) -> int | None:
        """The first proven common boundary in (begin, end)."""
        left, right = left[np.searchsorted(left, begin + 1) :], right[: np.searchsorted(right, end)]
        both = np.intersect1d(left, right).tolist()
        first = next((p for p in both if p > begin and text[p - 1] in STABLE), None)
        if first is None:
            return None
        last = next(p for p in reversed(both) if text[p - 1] in STABLE)
        same = [side[np.searchsorted(side, first) : np.searchsorted(side, last)] for side in (left, right)]
        return first if np.array_equal(*same) else None

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; the chunks of all of them are encoded together."""
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        many = np.flatnonzero(sizes > self.chunk)
        long = {int(i): texts[int(i)].as_py() for i in many}
        spans = [(i, begin, end) for i in long for begin, end in self.chunks(int(sizes[i]))]
        whole = texts.filter(pa.array(sizes <= self.chunk))
        cut = pa.array([long[i][begin:end] for i, begin, end in spans], texts.type)
        starts, borders = self.encoder.encode(pa.concat_arrays([whole, cut]))
        out = np.zeros(len(texts), np.int64)
        out[sizes <= self.chunk] = np.diff(borders[: len(whole) + 1])
        ready: dict[int, dict] = {}
        for (i, begin, end), a, b in zip(spans, borders[len(whole) :], borders[len(whole) + 1 :]):
            ready.setdefault(i, {})[begin, end] = starts[a:b] + begin
        for i, text in long.items():
            out[i] = self.spliced(text, ready[i])
        return out

    def count(self, text: str) -> int:
        return int(self.counts(pa.array([text], pa.string()))[0])

    def spliced(self, text: str, ready: dict[tuple[int, int], np.ndarray]) -> int:
        def starts(begin: int, end: int) -> np.ndarray:
            if (begin, end) in ready:
                return ready[begin, end]
            return self.encoder.encode(pa.array([text[begin:end]], pa.string()))[0] + begin

        total, begin, end = 0, 0, min(self.chunk, len(text))
        left = starts(0, end)
        done = 0
        while end < len(text):
            overlap = self.overlap
            while True:
                start = max(end - overlap, begin)
                stop = min(start + max(self.chunk, 2 * overlap), len(text))
                right = starts(start, stop)
                cut = 0 if start == 0 else self.splice(text, left, right, start, end)
                if start == 0:
                    left_part, right_part = 0, right
                    break
                if cut is not None:
                    left_part = int(np.count_nonzero((left >= done) & (left < cut)))
                    right_part = right
                    break
                if start == begin:
                    # Both chunks as one: nothing between the last splice and here is stable.
                    cut, left_part = done, 0
                    right_part = starts(done, stop)
                    break
                overlap *= 2
                self.widened += 1
            total += left_part
            left, done, begin, end = right_part, cut, max(cut, start), stop
        return total + int(np.count_nonzero(left >= done))


def count_tokens(
    df: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    chunk_chars: int = 2_048,
    overlap_chars: int = 128,
    memory_words: int = 400_000,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, without special tokens of the template.

    Every text is encoded in chunks of ``chunk_chars`` characters that overlap by ``overlap_chars``, a text
    that is no longer than that as one chunk, and its chunks are spliced; the counts are exact. NULL counts as the empty text (0 tokens); a NULL id, repeated rows and further columns are
    allowed, each input row gives one output row. An empty table gives none. The tokenizer file is read
    on the executors and must cut its input at white space and drop it (checked when it is loaded).
    """
    chunk_chars, overlap_chars = max(2, chunk_chars), max(1, min(overlap_chars, chunk_chars - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_file)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        alone = [len(tokenizer.encode(x, add_special_tokens=False)) for x in ("ab", "c", "ab c", " ab \n\tc ")]
        if not alone[0] + alone[1] == alone[2] == alone[3]:
            raise ValueError("this tokenizer does not cut its input at white space")
        counter = OverlapCounter(tokenizer, chunk_chars, overlap_chars, memory_words)
        for batch in sub_batches(batches):
            column = batch.column("text").fill_null("")
            tokens = counter.counts(column)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.binary_length(column).cast(pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return text_rows(df, id_col, text_col).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
