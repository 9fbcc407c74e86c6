"""Fill-in-middle: cut each text at two random unit borders and move the middle behind the rest.

Units are runs of ASCII letters and single other code points. Texts are laid out as little-endian 64-bit
words, each text from a word of its own and with at least one zero byte behind it. Arithmetic on whole words
marks, in the highest bit of each byte, the bytes that end a unit; a count of bits per word and running sums
find the word that holds the wanted border, and a select inside this word finds the byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loticote.llm.common import runs, utf8

MARKERS = ("<P>", "<S>", "<M>")
ANY_MARKER = "<[PSM]>"

ONES = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
CASE = np.uint64(0x2020202020202020)
# Added to seven bits these carry into the eighth from "a" on and from "{" on.
FROM_A = ONES * np.uint64(0x80 - ord("a"))
PAST_Z = ONES * np.uint64(0x80 - ord("z") - 1)

# Texts are worked on in slices of about this many bytes; a longer text is a slice by itself.
SLICE_BYTES = 4 << 20


def word_layout(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as uint64 words and the first word of each (one more entry: the end)."""
    lengths = np.diff(borders)
    first = np.concatenate(([0], np.cumsum(lengths // 8 + 1)))
    padded = np.zeros(int(first[-1]) * 8, np.uint8)
    padded[np.repeat(first[:-1] * 8, lengths) + runs(lengths)] = data
    return padded.view("<u8"), first


def letters(words: np.ndarray) -> np.ndarray:
    """Marks of the bytes that are ASCII letters."""
    folded = (words | CASE) & LOW7
    return (folded + FROM_A) & ~(folded + PAST_Z) & ~words & HIGH


def continuations(words: np.ndarray) -> np.ndarray:
    """Marks of the bytes 10xxxxxx, which do not begin a code point."""
    return words & ~(words << np.uint64(1)) & HIGH


def of_next_byte(marks: np.ndarray) -> np.ndarray:
    """Each byte gets the mark of the byte behind it; the last byte of all gets none."""
    out = marks >> np.uint64(8)
    out[:-1] |= marks[1:] << np.uint64(56)
    return out


def inside(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Marks of the bytes that belong to a text and not to the zeros behind it."""
    out = np.full(int(first[-1]), HIGH, np.uint64)
    out[first[1:] - 1] = HIGH & ((np.uint64(1) << (lengths % 8 * 8).astype(np.uint64)) - np.uint64(1))
    return out


def unit_ends(words: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """A letter ends a unit unless a letter follows, any other byte unless its code point goes on."""
    letter = letters(words)
    goes_on = (letter & of_next_byte(letter)) | (~letter & of_next_byte(continuations(words)))
    return ~goes_on & valid


def running_counts(marks: np.ndarray) -> np.ndarray:
    """Marks before each word (one more entry: all)."""
    return np.concatenate(([0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)))


def select(marks: np.ndarray, before: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The byte position behind the ``wanted``-th mark (from 1) of all marks."""
    word = np.searchsorted(before, wanted, "left") - 1
    rest = (wanted - before[word]).astype(np.uint64)
    # Each byte of the product holds the marks up to and including it: at most eight, so nothing overflows.
    upto = (marks[word] >> np.uint64(7)) * ONES
    reached = (upto + (np.uint64(0x80) - rest) * ONES) & HIGH
    return word * 8 + 9 - np.bitwise_count(reached).astype(np.int64)


def marks_up_to(marks: np.ndarray, before: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Marks in the bytes before a byte position."""
    word, byte = position // 8, position % 8
    held = marks[np.minimum(word, len(marks) - 1)]
    part = held & ((np.uint64(1) << (byte * 8).astype(np.uint64)) - np.uint64(1))
    return before[word] + np.bitwise_count(part).astype(np.int64)


def cut_points(
    data: np.ndarray, borders: np.ndarray, one: np.ndarray, two: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, code points before its first cut and between its cuts.

    The cuts lie behind as many units as ``one`` and ``two`` modulo (units + 1), in either order.
    """
    if len(borders) == 1:
        return (np.zeros(0, np.int64),) * 3
    words, first = word_layout(data, borders)
    valid = inside(first, np.diff(borders))
    ends = unit_ends(words, valid)
    before = running_counts(ends)
    base = before[first[:-1]]
    units = before[first[1:]] - base
    cuts = np.sort(np.stack([one % (units + 1), two % (units + 1)]), axis=0)
    starts = ~continuations(words) & valid
    before_start = running_counts(starts)
    chars = []
    for cut in cuts:
        at = first[:-1] * 8
        some = cut > 0
        at[some] = select(ends, before, (base + cut)[some])
        chars.append(marks_up_to(starts, before_start, at) - before_start[first[:-1]])
    return units, chars[0], chars[1] - chars[0]


CUTS = StructType([StructField(c, LongType()) for c in ("n", "prefix_chars", "middle_chars")])


@F.arrow_udf(CUTS)
def cut_texts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """Cuts of a batch of texts, in slices of bounded bytes."""
    data, borders = utf8(text)
    one, two = (c.to_numpy(zero_copy_only=False) for c in (one, two))
    out = []
    start = 0
    while start < len(text):
        end = int(np.searchsorted(borders, borders[start] + SLICE_BYTES, "right")) - 1
        end = min(max(end, start + 1), len(text))
        part = slice(borders[start], borders[end])
        out.append(cut_points(data[part], borders[start : end + 1] - borders[start], one[start:end], two[start:end]))
        start = end
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], CUTS.names)


def draws(key: Column, seed: int) -> list[Column]:
    """Four 32-bit numbers from the SHA-256 of ``seed:key``; a NULL key is the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def restore(output: Column, form: Column) -> Column:
    """The text from its transformed form. Only plain outputs can hold markers of their own."""
    parts = F.split(output, ANY_MARKER)
    part = lambda i: F.element_at(parts, i)
    return (
        F.when(form == "psm", F.concat(part(2), part(4), part(3)))
        .when(form == "spm", F.concat(part(3), part(4), part(2)))
        .otherwise(output)
    )


def fill_in_middle(
    df: DataFrame,
    seed: int = 1,
    fim_percent: int = 90,
    spm_percent: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row.

    ``n`` is the number of units, ``output`` the transformed text: the text itself (``plain``),
    prefix-suffix-middle (``psm``) or suffix-prefix-middle (``spm``), with a marker before each part. Empty
    texts and texts that hold a marker stay plain, as do ``100 - fim_percent`` percent of the others.
    Everything is drawn from the id and the seed, so a repeated run gives the same forms and cuts.

    NULL texts are empty. A NULL id draws like an empty id; rows with equal ids and texts give equal
    rows. Further columns are not read. An empty table gives none. Texts do not leave the JVM but for
    being looked at: only the three numbers of each text come back.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(id_col).cast("long"), seed)
    drawn = {"h1": h1, "h2": h2, "h3": h3, "h4": h4}
    named = {"doc_id": F.col(id_col).cast("long"), "text": text} | drawn
    rows = df.select(*(c.alias(name) for name, c in named.items()))
    plain = (F.col("text") == "") | F.col("text").rlike(ANY_MARKER) | (F.col("h3") % 100 >= fim_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    cut = rows.select("doc_id", "text", form.alias("form"), cut_texts("text", "h1", "h2").alias("cut"))
    p, m = F.col("cut.prefix_chars"), F.col("cut.middle_chars")
    prefix = F.substring("text", F.lit(1), p)
    middle = F.substring("text", p + 1, m)
    suffix = F.substring("text", p + m + 1, F.length("text"))
    psm = F.concat(F.lit(MARKERS[0]), prefix, F.lit(MARKERS[1]), suffix, F.lit(MARKERS[2]), middle)
    spm = F.concat(F.lit(MARKERS[1]), suffix, F.lit(MARKERS[0]), prefix, F.lit(MARKERS[2]), middle)
    moved = F.col("form") != "plain"
    return cut.select(
        "doc_id",
        F.col("cut.n").alias("n"),
        "form",
        F.when(moved, p).alias("prefix_chars"),
        F.when(moved, m).alias("middle_chars"),
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text")).alias("output"),
    )
