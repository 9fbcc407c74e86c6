"""Language of words and documents by a linear-chain conditional random field.

Every word of a sentence gets a label; emissions come from affixes, character n-grams and a learned
lexicon, transitions are learned, and forward-backward gives the probability of each label at each word.
A document's language is the label with the largest mean probability over its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loticote.llm.common import gathered, runs

UNKNOWN = "und"
ENDS = (".", "!", "?", "…", "。", "！", "？")
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MULTIPLIERS[3]
    return x ^ (x >> np.uint64(29))


def letters_of(word: str) -> str:
    """The word in lower case without what is not a letter at its ends; empty if it has no letter."""
    if word.isalpha():
        return word.lower()
    start, end = 0, len(word)
    while start < end and not word[start].isalpha():
        start += 1
    while end > start and not word[end - 1].isalpha():
        end -= 1
    return word[start:end].lower()


def grams(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of words: (word, feature) pairs and a hash of each whole word.

    With ^ and $ at its ends, a word's character pairs and triples hold its first and last one and two
    letters; the first and last three letters are added.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    text = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    borders = np.concatenate(([0], np.cumsum(lengths)))
    of = np.repeat(np.arange(len(words)), lengths)
    mask = np.uint64((1 << bits) - 1)
    two = text[:-1] * MULTIPLIERS[0] + text[1:] * MULTIPLIERS[1]
    three = two[:-1] * MULTIPLIERS[2] + text[2:] * MULTIPLIERS[0] + np.uint64(3)
    four = three[:-1] * MULTIPLIERS[1] + text[3:] * MULTIPLIERS[2] + np.uint64(4)
    in_two, in_three = of[:-1] == of[1:], of[:-2] == of[2:]
    head = borders[:-1][lengths >= 4]
    tail = borders[1:][lengths >= 4] - 4
    edge = np.concatenate((head, tail))
    side = np.concatenate((np.zeros(len(head), np.uint64), np.ones(len(tail), np.uint64)))
    owner = np.concatenate((of[:-1][in_two], of[:-2][in_three], of[edge]))
    found = np.concatenate((two[in_two], three[in_three], four[edge] + side * np.uint64(0x5851F42D4C957F2D)))
    powers = MULTIPLIERS[0] ** runs(lengths).astype(np.uint64)
    whole = np.add.reduceat(mix(text + np.uint64(1)) * powers, borders[:-1]) if len(words) else np.zeros(0, np.uint64)
    order = np.argsort(owner, kind="stable")
    return owner[order], (mix(found) & mask)[order].astype(np.int64), whole


@dataclass
class Field:
    """The learned field: weights of n-gram features, lexicon words, transitions and first labels."""

    labels: list[str]
    bits: int
    lexicon: np.ndarray
    grams: np.ndarray
    words: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        owner, found, whole = grams(words, self.bits)
        starts = np.searchsorted(owner, np.arange(len(words)))
        out = np.add.reduceat(self.grams[found], starts, axis=0)
        return out + self.words[lexicon_rows(self.lexicon, whole)]


def lexicon_rows(lexicon: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Row of each word in the lexicon weights; the last row is for words outside of it."""
    if not len(lexicon):
        return np.zeros(len(whole), np.int64)
    at = np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)
    return np.where(lexicon[at] == whole, at, len(lexicon))


def marginals(score: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Forward-backward over all sequences at once; also the expected moves and first labels."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    weight = np.exp(score - score.max(axis=1, keepdims=True))
    step, head = np.exp(moves), np.exp(first - first.max())
    alpha, beta = np.empty_like(weight), np.empty_like(weight)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(1, longest + 1), "right")
    a = weight[starts] * head
    a /= a.sum(1, keepdims=True)
    alpha[starts] = a
    for t in range(1, longest):
        at = starts[: active[t]] + t
        a = (a[: active[t]] @ step) * weight[at]
        a /= a.sum(1, keepdims=True)
        alpha[at] = a
    n = len(step)
    expected = np.zeros((n, n))
    beta[starts + lengths - 1] = 1
    for t in range(longest - 1, 0, -1):
        at = starts[: active[t]] + t
        after = beta[at] * weight[at]
        b = after @ step.T
        pair = alpha[at - 1].T @ (after / (alpha[at - 1] * b).sum(1, keepdims=True))
        expected += pair * step
        beta[at - 1] = b / b.sum(1, keepdims=True)
    both = alpha * beta
    both /= both.sum(1, keepdims=True)
    return both, expected


def fit(rows: list[tuple[str, str]], bits: int, rounds: int, switch: float, strength: float) -> Field | None:
    """Learn a field from whole texts and their labels.

    The sequences are sentences, ``switch`` of them followed by a sentence of another text, so that
    the transitions see changes of language.
    """
    labels = sorted({label for _, label in rows})
    if not labels:
        return None
    number = {label: i for i, label in enumerate(labels)}
    vocabulary: dict[str, int] = {}
    in_texts: dict[int, int] = {}
    sequences: list[tuple[list[int], int]] = []
    for text, label in rows:
        current: list[int] = []
        seen = set()
        for part in text.split():
            word = letters_of(part)
            if word:
                w = vocabulary.setdefault(word, len(vocabulary))
                current.append(w)
                seen.add(w)
            if part.endswith(ENDS) and current:
                sequences.append((current, number[label]))
                current = []
        if current:
            sequences.append((current, number[label]))
        for w in seen:
            in_texts[w] = in_texts.get(w, 0) + 1
    if not sequences:
        return None
    rng = np.random.default_rng(0)
    words, truth, starts = [], [], [0]
    order = rng.permutation(len(sequences))
    partner = rng.permutation(len(sequences))
    for i, j in zip(order, partner):
        chosen = [sequences[i]] + ([sequences[j]] if rng.random() < switch else [])
        for ids, label in chosen:
            words += ids
            truth += [label] * len(ids)
        starts.append(len(words))
    words, truth, starts = np.array(words), np.array(truth), np.array(starts)
    lengths = np.diff(starts)
    names = list(vocabulary)
    owner, found, whole = grams(names, bits)
    first_of = np.searchsorted(owner, np.arange(len(names)))
    often = np.array([in_texts[i] >= 2 for i in range(len(names))])
    lexicon = np.unique(whole[often])
    rows_of = lexicon_rows(lexicon, whole)
    n = len(labels)
    field = Field(
        labels, bits, lexicon, np.zeros((1 << bits, n), np.float32), np.zeros((len(lexicon) + 1, n), np.float32),
        np.zeros((n, n)), np.zeros(n),
    )
    parts = [field.grams, field.words, field.moves, field.first]
    squares = [np.full(p.shape, 1e-2, p.dtype) for p in parts]
    exact = np.zeros((len(words), n))
    exact[np.arange(len(words)), truth] = 1
    inner = np.ones(len(words), bool)
    inner[starts[:-1]] = False
    inner = np.flatnonzero(inner)
    moved = np.zeros((n, n))
    np.add.at(moved, (truth[inner - 1], truth[inner]), 1)
    began = np.bincount(truth[starts[:-1]], minlength=n)
    for _ in range(rounds):
        per_word = np.add.reduceat(field.grams[found], first_of, axis=0) + field.words[rows_of]
        likely, expected = marginals(per_word[words].astype(np.float64), starts[:-1], lengths, field.moves, field.first)
        gap = exact - likely
        by_word = np.stack([np.bincount(words, weights=gap[:, k], minlength=len(names)) for k in range(n)], 1)
        slopes = [
            np.stack([np.bincount(found, weights=by_word[owner, k], minlength=1 << bits) for k in range(n)], 1),
            np.stack([np.bincount(rows_of, weights=by_word[:, k], minlength=len(lexicon) + 1) for k in range(n)], 1),
            moved - expected,
            began - likely[starts[:-1]].sum(0),
        ]
        for part, square, slope in zip(parts, squares, slopes):
            slope = slope - strength * part
            square += (slope * slope).astype(part.dtype)
            part += (0.5 * slope / np.sqrt(square)).astype(part.dtype)
    return field


class Labeller:
    """Labels whole batches; emissions of words are kept for later batches, up to ``memory_words``."""

    def __init__(self, field: Field, memory_words: int):
        self.field, self.memory = field, memory_words
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.field.labels)), np.float32)
        self.lettered, self.ends = np.zeros(0, bool), np.zeros(0, bool)

    def learn_words(self, parts: list[str]) -> np.ndarray:
        if len(self.known) + len(parts) > self.memory:
            self.forget()
        new = [p for p in parts if p not in self.known]
        if new:
            words = [letters_of(p) for p in new]
            lettered = np.fromiter(map(bool, words), bool, len(words))
            scores = np.zeros((len(new), len(self.field.labels)), np.float32)
            if lettered.any():
                scores[lettered] = self.field.emissions([w for w in words if w])
            self.scores = np.concatenate((self.scores, scores))
            self.lettered = np.concatenate((self.lettered, lettered))
            self.ends = np.concatenate((self.ends, np.fromiter((p.endswith(ENDS) for p in new), bool, len(new))))
            for p in new:
                self.known[p] = len(self.known)
        return np.fromiter((self.known[p] for p in parts), np.int64, len(parts))

    def words(self, column: pa.Array):
        """Of all lettered words of the texts: label probabilities, and the words' borders by text."""
        lists = pc.utf8_split_whitespace(column.fill_null(""))
        coded = lists.flatten().dictionary_encode()
        slots = self.learn_words(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        borders = lists.offsets.to_numpy().astype(np.int64)
        borders = borders - borders[0]
        lettered = self.lettered[slots]
        # A sentence ends at its last word or before the next text.
        ends = self.ends[slots]
        before = np.concatenate(([0], np.cumsum(lettered)))
        cuts = np.concatenate((before[1:][ends], before[borders]))
        starts = np.unique(cuts)
        total = int(before[-1])
        starts = starts[starts < total]
        lengths = np.diff(np.append(starts, total))
        if not total:
            return np.zeros((0, len(self.field.labels)), np.float32), before[borders]
        likely, _ = marginals(self.scores[slots[lettered]], starts, lengths, self.field.moves.astype(np.float32), self.field.first.astype(np.float32))
        return likely, before[borders]


def detect_language(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    sample_rows: int = 150,
    sample_chars: int = 20_000,
    max_labels: int = 200,
    bits: int = 16,
    rounds: int = 25,
    switch: float = 0.15,
    strength: float = 0.02,
    batch_bytes: int = 1 << 20,
    memory_words: int = 300_000,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, n_words, n_switches`` of every row.

    The field is fitted on at most ``sample_rows`` labelled rows of each label, those with the smallest hash
    of id and text among rows of at most ``sample_chars`` characters whose crc32(id) mod 4 is not 2; the others are
    held out. Rows that repeat id, text and label count once there. Of more than ``max_labels`` labels those with
    the most such rows are learned, ties by name; this bounds what is fitted on the driver. A prediction reads the text alone. ``score`` is the mean probability of the predicted label
    over the words, ``n_switches`` the changes of the likeliest label from word to word. Texts that are NULL
    or hold no letter get ``und`` and 0; so do all when no row is labelled. NULL ids count as not
    held out; ties go to the label that sorts first; repeated rows repeat; an empty table gives no rows.
    Columns named in ``keep`` are carried along as ``keep_<name>``.
    """
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(label_col).cast("string").alias("label"),
        *(F.col(c).alias(f"keep_{c}") for c in keep),
    )
    kept = [f"keep_{c}" for c in keep]
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    able = rows.where(~held_out & F.col("label").isNotNull() & (F.length("text") <= sample_chars))
    # Ranked by a hash, so that only the chosen texts travel; each label has its own limit.
    mark = F.xxhash64("doc_id", "text")
    order = Window.partitionBy("label").orderBy("mark")
    marks = able.select("label", mark.alias("mark")).distinct()
    common = marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(max_labels)
    ranked = marks.withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_rows)
    tops = ranked.groupBy("label").agg(F.max("mark").alias("top")).join(common.select("label"), "label")
    limits = {r.label: r.top for r in tops.collect()}
    chosen = F.lit(False)
    for label, top in limits.items():
        chosen = chosen | ((F.col("label") == label) & (mark <= top))
    one = able.where(chosen).groupBy("label", mark.alias("mark")).agg(F.min("text").alias("text"))
    sample = one.orderBy("label", "mark").collect() if limits else []
    field = fit([(r.text, r.label) for r in sample], bits, rounds, switch, strength)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(field, memory_words) if field else None
        for batch in gathered(batches, "text", batch_bytes):
            n = batch.num_rows
            names, score = np.full(n, UNKNOWN, object), np.zeros(n)
            count, switches = np.zeros(n, np.int64), np.zeros(n, np.int64)
            if labeller:
                likely, borders = labeller.words(batch.column("text"))
                count = np.diff(borders)
                some = np.flatnonzero(count)
                if len(some):
                    sums = np.add.reduceat(likely.astype(np.float64), borders[:-1][some], axis=0)
                    best = sums.argmax(1)
                    names[some] = np.array(field.labels, object)[best]
                    score[some] = np.clip(sums[np.arange(len(some)), best] / count[some], 0, 1)
                    top = likely.argmax(1)
                    turn = np.concatenate(([0], top[1:] != top[:-1]))
                    turn[borders[:-1][some]] = 0
                    switches[some] = np.add.reduceat(turn, borders[:-1][some])
            found = [pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(count), pa.array(switches)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *found, *(batch.column(c) for c in kept)],
                names=["doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches", *kept],
            )

    rows = rows.select("doc_id", held_out.alias("held_out"), "text", *kept)
    types = "doc_id long, held_out boolean, lang_pred string, score double, n_words long, n_switches long"
    schema = StructType(StructType.fromDDL(types).fields + [rows.schema[c] for c in kept])
    return rows.mapInArrow(run, schema)
