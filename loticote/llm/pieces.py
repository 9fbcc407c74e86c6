"""Subword encoding and decoding with a SentencePiece merge model, by suffix-array matching.

The words of a batch are written one after another into one text, a suffix array of that text is built as
deep as the longest piece, every piece is looked up by binary search, and the occurrences found are edges
from their first to their last character. Edges are sorted by position and relaxed.

The models in use are merge (BPE) models: a text's pieces are those that merging leaves, not those of the
best total score. Relaxing therefore keeps, for every position, the last piece of the encoding of the text
up to there. An edge continues the encoding that ends where it starts if, and only if, merging the two
adjoining pieces alone would leave both as they are; exactly one edge into each position does. That gives
what the library gives.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loticote.llm.common import gathered, runs, strings, text_rows

SPACE = "▁"
CHAR_BITS = 16
# New words are indexed in slices of about this many characters.
SLICE_CHARS = 300_000


def merge_all(symbols: list[int], merges: dict[tuple[int, int], int], rank: np.ndarray) -> tuple[list[int], tuple]:
    """Merge the best pair, leftmost first, until none is left; also the parts of the last merge."""
    last = (-1, -1)
    while len(symbols) > 1:
        best = min(
            ((rank[m], i, m) for i in range(len(symbols) - 1) if (m := merges.get((symbols[i], symbols[i + 1]))) is not None),
            default=None,
        )
        if best is None:
            break
        _, i, m = best
        last = (symbols[i], symbols[i + 1])
        symbols[i : i + 2] = [m]
    return symbols, last


class PieceTable:
    """What encoding needs of a model: pieces, merges, ranks, and how each piece is merged."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        if model.normalize("  a  b\t ") != "▁▁▁a▁▁b\t▁" or model.normalize("ﬁÉ") != "▁ﬁÉ":
            raise ValueError("only models that keep texts as they are and add a leading space are supported")
        self.size = size
        self.text = [model.id_to_piece(i) for i in range(size)]
        normal = [
            i for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.byte_ids = np.full(256, -1, np.int64)
        for i in range(size):
            if model.is_byte(i):
                self.byte_ids[int(self.text[i][1:-1], 16)] = i
        if (self.byte_ids < 0).any():
            raise ValueError("only models with byte fallback are supported")
        ids = {self.text[i]: i for i in normal}
        if any(SPACE in t.lstrip(SPACE) for t in ids):
            raise ValueError("a piece reaches across words")
        chars = sorted({c for t in ids for c in t})
        # Characters that are no pieces but occur in some get ids behind the pieces; the last id is any other.
        loose = [c for c in chars if c not in ids]
        self.all_ids = ids | {c: size + i for i, c in enumerate(loose)}
        self.other = size + len(loose)
        order = sorted(normal, key=lambda i: -model.get_score(i))
        self.rank = np.full(self.other + 1, -1, np.int64)
        for r, i in enumerate(order):
            if len(self.text[i]) > 1:
                self.rank[i] = r
        merges = {}
        for t, i in ids.items():
            for cut in range(1, len(t)):
                pair = (self.all_ids.get(t[:cut]), self.all_ids.get(t[cut:]))
                if None not in pair:
                    merges[pair] = i
        left, right = (np.full(self.other + 1, -1, np.int64) for _ in range(2))
        stable = np.zeros(self.other + 1, bool)
        for t, i in self.all_ids.items():
            end, parts = merge_all([self.all_ids[c] for c in t], merges, self.rank)
            stable[i] = end == [i]
            if stable[i] and len(t) > 1:
                left[i], right[i] = parts
                if max(self.rank[parts[0]], self.rank[parts[1]]) >= self.rank[i]:
                    raise ValueError("a piece is merged before its parts")
        stable[self.other] = True
        self.left, self.right, self.stable = left, right, stable
        base = self.other + 1
        keys = np.array([a * base + b for a, b in merges], np.int64)
        sort = np.argsort(keys)
        self.base, self.merge_keys = base, keys[sort]
        self.merge_rank = self.rank[np.array(list(merges.values()), np.int64)[sort]]

        # Pieces as rows of character codes for the search, longest piece first decides the depth.
        self.codes = {c: k + 1 for k, c in enumerate(chars)}
        if len(chars) + 2 >= 1 << CHAR_BITS:
            raise ValueError("too many characters")
        self.code_of = np.zeros(0x110000, np.uint16)
        self.code_of[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        usable = [(t, i) for t, i in self.all_ids.items() if stable[i]]
        self.piece_ids = np.array([i for _, i in usable], np.int64)
        self.piece_len = np.array([len(t) for t, _ in usable], np.int64)
        self.depth = -(-int(self.piece_len.max()) // 4)
        low = np.zeros((len(usable), 4 * self.depth), np.uint64)
        for row, (t, _) in enumerate(usable):
            low[row, : len(t)] = [self.codes[c] for c in t]
        pad = np.arange(4 * self.depth)[None] >= self.piece_len[:, None]
        self.low = packed(low)
        self.high = packed(np.where(pad, np.uint64((1 << CHAR_BITS) - 1), low))
        self.code_ids = np.full(len(chars) + 1, self.other, np.int64)
        self.code_ids[1:] = [self.all_ids[c] for c in chars]

        # Decoding: the bytes of every piece.
        parts = [bytes([int(t[1:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else
                 t.replace(SPACE, " ").encode() for i, t in enumerate(self.text)]
        self.piece_bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.piece_borders = np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def merge_at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of two symbols; a huge number if there is none."""
        keys = a * self.base + b
        at = np.minimum(np.searchsorted(self.merge_keys, keys), len(self.merge_keys) - 1)
        return np.where(self.merge_keys[at] == keys, self.merge_rank[at], np.int64(1) << 60)

    def adjoin(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of a and b together leaves exactly a and b.

        The merges of both are taken back from the last to the first. While x and y adjoin, their own merge
        must not come before the merge that ends this state; of equal merges the left one comes first.
        """
        good = self.merge_at(a, b) >= 1 << 60
        live = np.flatnonzero(good)
        x, y = a[live], b[live]
        while len(live):
            rx, ry = self.rank[x], self.rank[y]
            more = (rx >= 0) | (ry >= 0)
            live, x, y, rx, ry = live[more], x[more], y[more], rx[more], ry[more]
            undo = rx > ry
            x, y = np.where(undo, self.right[x], x), np.where(undo, y, self.left[y])
            met = self.merge_at(x, y)
            bad = np.where(undo, met < rx, met <= ry)
            good[live[bad]] = False
            live, x, y = live[~bad], x[~bad], y[~bad]
        return good


def packed(codes: np.ndarray) -> np.ndarray:
    """Four character codes in each 64-bit key, so that keys compare like the text."""
    c = codes.reshape(len(codes), -1, 4)
    return (c[..., 0] << np.uint64(48)) | (c[..., 1] << np.uint64(32)) | (c[..., 2] << np.uint64(16)) | c[..., 3]


@functools.lru_cache(maxsize=2)
def load(model_file: str) -> PieceTable:
    return PieceTable(model_file)


class Encoder:
    """Encodes distinct words; pairs that were tested for adjoining are remembered."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.pairs, self.pair_good = np.zeros(0, np.int64), np.zeros(0, bool)

    def adjoin(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.table.base + b
        distinct, where = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.pairs, distinct)
        known = at < len(self.pairs)
        known[known] = self.pairs[at[known]] == distinct[known]
        good = np.zeros(len(distinct), bool)
        good[known] = self.pair_good[at[known]]
        new = distinct[~known]
        if len(new):
            good[~known] = self.table.adjoin(new // self.table.base, new % self.table.base)
            if len(self.pairs) + len(new) > 4_000_000:
                self.pairs, self.pair_good = distinct, good
            else:
                self.pairs = np.insert(self.pairs, at[~known], new)
                self.pair_good = np.insert(self.pair_good, at[~known], good[~known])
        return good[where]

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every occurrence of a piece in the text (codes; 0 never matches)."""
        table, n = self.table, len(codes)
        wide = np.zeros(n + 4 * table.depth, np.uint64)
        wide[:n] = codes
        four = (wide[:-3] << np.uint64(48)) | (wide[1:-2] << np.uint64(32)) | (wide[2:-1] << np.uint64(16)) | wide[3:]
        keys = [four[4 * d : 4 * d + n] for d in range(table.depth)]
        # Suffixes in the order of as many characters as the longest piece has; most differ early.
        order = np.argsort(keys[0], kind="stable")
        order = self.refine(order, keys)
        in_order = [k[order] for k in keys]
        low = self.search(in_order, table.low, False)
        high = self.search(in_order, table.high, True)
        counts = np.maximum(high - low, 0)
        starts = order[np.repeat(low, counts) + runs(counts)]
        return starts, np.repeat(table.piece_len, counts), np.repeat(table.piece_ids, counts)

    @staticmethod
    def refine(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        """Sort on by the next keys, only inside the groups that are equal so far."""
        group = np.concatenate(([0], np.cumsum(keys[0][order][1:] != keys[0][order][:-1]))) if len(order) else order
        for key in keys[1:]:
            sizes = np.bincount(group) if len(group) else np.zeros(0, int)
            tied = np.flatnonzero(sizes[group] > 1) if len(group) else group
            if not len(tied):
                break
            inner = np.lexsort((key[order[tied]], group[tied]))
            order[tied] = order[tied[inner]]
            k = key[order]
            group = np.concatenate(([0], np.cumsum((group[1:] != group[:-1]) | (k[1:] != k[:-1]))))
        return order

    @staticmethod
    def search(in_order: list[np.ndarray], wanted: np.ndarray, after: bool) -> np.ndarray:
        """Binary search of all pieces at once: the first suffix not below (or above, if ``after``)."""
        n = len(in_order[0])
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), n, np.int64)
        while (open_ := low < high).any():
            middle = np.minimum((low + high) // 2, n - 1)
            below = np.zeros(len(wanted), bool)
            equal = np.ones(len(wanted), bool)
            for d, key in enumerate(in_order):
                have = key[middle]
                below |= equal & (have < wanted[:, d])
                equal &= have == wanted[:, d]
            if after:
                below |= equal
            low = np.where(open_ & below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        return low

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words, one after another, and the n + 1 borders.

        Words are indexed in slices of about SLICE_CHARS characters: the keys, edges and orders of a slice
        take some hundred times its characters, and nothing of it is kept.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        slices = (np.cumsum(lengths + 1) - 1) // SLICE_CHARS
        cuts = np.searchsorted(slices, np.arange(int(slices[-1]) + 2)) if len(words) else np.zeros(1, np.int64)
        parts = [self.encode_slice(words[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()) if a < b]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        counts = np.concatenate([np.diff(borders) for _, borders in parts])
        return np.concatenate([ids for ids, _ in parts]), np.concatenate(([0], np.cumsum(counts)))

    def encode_slice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        table = self.table
        points = np.frombuffer("\x00".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        codes = table.code_of[points]
        inside = np.ones(len(points), bool)
        inside[begins[1:] - 1] = False  # the separators; a NUL inside a word stays a character
        codes[~inside] = 0
        starts, sizes, pieces = self.edges(codes)
        # Characters outside all pieces are edges of their own.
        lone = np.flatnonzero((codes == 0) & inside)
        starts = np.concatenate((starts, lone))
        sizes = np.concatenate((sizes, np.ones(len(lone), np.int64)))
        pieces = np.concatenate((pieces, np.full(len(lone), table.other)))
        # Edges in the order of their ends, counted from the start of the word: all words advance together.
        word = np.repeat(np.arange(len(words)), lengths + 1)[: len(points)]
        ends = starts + sizes
        step = ends - begins[word[starts]]
        order = np.argsort(step, kind="stable")
        starts, ends, pieces, step = starts[order], ends[order], pieces[order], step[order]
        cuts = np.searchsorted(step, np.arange(1, int(lengths.max(initial=0)) + 2))
        last = np.full(len(points) + 1, -1, np.int64)  # last piece of the encoding up to here
        back = np.zeros(len(points) + 1, np.int64)
        first = np.zeros(len(points) + 1, bool)
        first[begins] = True
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            s, e, p = starts[a:b], ends[a:b], pieces[a:b]
            good = first[s].copy()
            inner = np.flatnonzero(~good)
            good[inner] = self.adjoin(last[s[inner]], p[inner])
            last[e[good]], back[e[good]] = p[good], s[good]
        return self.walk(begins, lengths, last, back, points)

    def walk(self, begins, lengths, last, back, points) -> tuple[np.ndarray, np.ndarray]:
        """From the ends of all words back to their starts; then unknown characters become bytes."""
        table = self.table
        place, owner = begins + lengths, np.arange(len(begins))
        found, of, at = [], [], []
        live = place > begins
        place, owner = place[live], owner[live]
        while len(owner):
            found.append(last[place])
            of.append(owner)
            place = back[place]
            at.append(place)
            live = place > begins[owner]
            place, owner = place[live], owner[live]
        if not found:
            return np.zeros(0, np.int64), np.zeros(len(begins) + 1, np.int64)
        found, of, at = map(np.concatenate, (found, of, at))
        order = np.lexsort((at, of))
        found, of, at = found[order], of[order], at[order]
        unknown = found >= table.size
        widths = np.ones(len(found), np.int64)
        texts = [chr(points[i]).encode("utf-8", "surrogatepass") for i in at[unknown]]
        widths[unknown] = [len(t) for t in texts]
        out = np.repeat(found, widths)
        wide = np.repeat(unknown, widths)
        out[wide] = table.byte_ids[np.frombuffer(b"".join(texts), np.uint8)]
        per_word = np.bincount(of, weights=widths, minlength=len(begins)).astype(np.int64)
        return out, np.concatenate(([0], np.cumsum(per_word)))


def word_units(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of the texts, the word of each place, and the places' borders by text.

    A word is the leading spaces and what follows them up to the next space; no piece reaches across
    words. Every text but the empty one gets one leading space, as the model demands.
    """
    column = column.fill_null("")
    lists = pc.split_pattern(column, " ")
    parts = lists.flatten()
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    borders = lists.offsets.to_numpy().astype(np.int64)
    borders = borders - borders[0]
    empty = pc.equal(pc.binary_length(parts), 0).to_numpy(zero_copy_only=False)
    n = len(parts)
    last_of_text = np.zeros(n, bool)
    last_of_text[borders[1:] - 1] = True
    # Empty parts are further spaces of the next part of the same text; at its end they stand alone.
    keeps = ~empty | last_of_text
    blank = (pc.binary_length(column).to_numpy(zero_copy_only=False) == 0) if len(column) else np.zeros(0, bool)
    keeps[borders[:-1][blank]] = False
    position = np.arange(n)
    starts = np.zeros(n, bool)
    starts[borders[:-1]] = True
    # The number of spaces: parts since the one after the last kept part, or since the start of the text.
    anchor = np.where(keeps, position + 1, np.where(starts, position, 0))
    since = np.maximum.accumulate(np.concatenate(([0], anchor)))[:-1]
    since = np.maximum(since, np.repeat(borders[:-1], np.diff(borders)))
    spaces = position - since + 1
    kept = np.flatnonzero(keeps)
    coded = parts.take(pa.array(kept)).dictionary_encode()
    plain = coded.indices.to_numpy().astype(np.int64)
    words = [SPACE + w for w in coded.dictionary.to_pylist()]
    many = np.flatnonzero(spaces[kept] > 1)
    special: dict[str, int] = {}
    for i in many.tolist():
        word = SPACE * int(spaces[kept[i]] - 1) + words[plain[i]]
        plain[i] = special.setdefault(word, len(words) + len(special))
    words += list(special)
    per_text = np.concatenate(([0], np.cumsum(keeps)))[borders]
    return words, plain, per_text


class BatchEncoder:
    """Encodes batches of texts; the ids of a word are kept for later batches, up to ``memory_words``."""

    def __init__(self, table: PieceTable, memory_words: int):
        self.encoder, self.memory = Encoder(table), memory_words
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool, self.borders = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, places, per_text = word_units(column)
        if len(self.known) + len(words) > self.memory:
            self.forget()
        used = np.unique(places) if len(places) else places
        new = [words[i] for i in used.tolist() if words[i] not in self.known]
        ids, borders = self.encoder.encode(new)
        for word in new:
            self.known[word] = len(self.known)
        self.pool = np.concatenate((self.pool, ids.astype(np.int32)))
        self.borders = np.concatenate((self.borders, self.borders[-1] + borders[1:]))
        slot = np.zeros(len(words) + 1, np.int64)
        slot[used] = [self.known[words[i]] for i in used.tolist()]
        slots = slot[places]
        counts = (self.borders[1:] - self.borders[:-1])[slots] if len(slots) else slots
        out = self.pool[np.repeat(self.borders[:-1][slots], counts) + runs(counts)] if len(slots) else self.pool[:0]
        sums = np.concatenate(([0], np.cumsum(counts)))
        return out, sums[per_text]


def decode(table: PieceTable, ids: np.ndarray, borders: np.ndarray) -> pa.Array:
    """Texts from ids: the pieces' bytes one after another, without the leading space; wrong UTF-8 is replaced."""
    sizes = (table.piece_borders[1:] - table.piece_borders[:-1])[ids] if len(ids) else np.zeros(0, np.int64)
    data = table.piece_bytes[np.repeat(table.piece_borders[:-1][ids], sizes) + runs(sizes)] if len(ids) else table.piece_bytes[:0]
    ends = np.concatenate(([0], np.cumsum(sizes)))[borders]
    keep = np.ones(len(data), bool)
    filled = np.flatnonzero(ends[1:] > ends[:-1])
    leading = ends[:-1][filled]
    leading = leading[data[leading] == 32]
    keep[leading] = False
    data = data[keep]
    ends = np.concatenate(([0], np.cumsum(keep)))[ends]
    out = strings(data, ends)
    try:
        out.validate(full=True)
    except pa.ArrowInvalid:
        raw = data.tobytes()
        out = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])], pa.large_string())
    return out


def encode_texts(
    df: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = 3 << 20,
    memory_words: int = 300_000,
) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` of every row.

    ``ids`` are those that the library gives without begin and end; ``round_trip`` says whether decoding
    them gives the text back (a text that holds the model's own space sign U+2581 comes back with
    spaces). NULL and empty texts have no ids and come back as the empty text; NULL ids, repeated rows and
    further columns are allowed; an empty table gives no rows. Memory follows ``batch_bytes``, the longest
    text and ``memory_words``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(model_file)
        encoder = BatchEncoder(table, memory_words)
        for batch in gathered(batches, "text", batch_bytes):
            column = batch.column("text").fill_null("")
            ids, borders = encoder(column)
            same = pc.equal(decode(table, ids, borders), column.cast(pa.large_string()))
            for a in range(0, len(column), 1000):
                b = min(a + 1000, len(column))
                part = pa.ListArray.from_arrays(
                    pa.array((borders[a : b + 1] - borders[a]).astype(np.int32)), pa.array(ids[borders[a] : borders[b]])
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(borders[a : b + 1])), part, same.slice(a, b - a)],
                    names=["doc_id", "n_tokens", "ids", "round_trip"],
                )

    return text_rows(df, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean"
    )


def decode_ids(df: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from lists of piece ids; NULL lists and NULL or unknown ids inside give no text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(model_file)
        for batch in batches:
            lists = batch.column("ids")
            lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            texts = decode(table, flat.astype(np.int64), np.concatenate(([0], np.cumsum(lengths))).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts.cast(pa.string())], names=["doc_id", "text"])

    size = load(model_file).size
    clean = F.filter(F.col(ids_col).cast("array<int>"), lambda i: i.between(0, size - 1))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), clean.alias("ids")).mapInArrow(run, "doc_id long, text string")


