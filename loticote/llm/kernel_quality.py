"""Document quality by kernel ridge regression on text statistics, calibrated to probabilities.

Each text becomes a vector of statistics, standardised by the mean and deviation over all documents. Random
Fourier features approximate a Gaussian kernel between these vectors, so that ridge regression needs only the
sums of products of features (the normal equations): tasks add up their rows, the sums of tasks are added by
Spark, and one small matrix per fold reaches the driver. The folds' matrices are subtracted from the total to
score every training row by a model that has not seen it; these scores calibrate the model by isotonic
regression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loticote.llm.common import sub_batches, text_rows, utf8
from loticote.llm.hashing import digests
from loticote.session import materialize

# Bytes are counted by these classes; what is in none of them is "other".
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "line": b"\n",
    "space": b" \t\x0b\x0c\r",
    "shout": b"!",
    "ask": b"?",
    "stop": b".",
    "comma": b",",
    "pause": b";:",
    "bar": b"|",
    "sign": b"#$%&*",
    "markup": b"<>{}[]\\/=_^~@+",
    "quote": b"\"'`()-",
    "wide": bytes(range(128, 256)),
}
CLASS = np.full(256, len(CLASSES), np.int64)
for _i, _bytes in enumerate(CLASSES.values()):
    CLASS[list(_bytes)] = _i
WHITE = np.zeros(256, bool)
WHITE[list(b" \t\n\x0b\x0c\r")] = True

SHARES = [c for c in CLASSES if c != "lower"]
STATISTICS = [
    "log_bytes", "log_words", "log_mean_word", "log_longest_word", "word_spread", "distinct_words", "word_variety",
    "same_as_before", "capitalised_words", "lines_per_word", "repeated_lines", *SHARES,
]

SLICE_BYTES = 2 << 20
GRID = 2048
STRIPES = 4
SALTS = 64


def pieces(data: np.ndarray, breaks: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes between breaks, never across two texts."""
    inner = ~breaks
    first, last = inner.copy(), inner.copy()
    new = doc[1:] != doc[:-1]
    first[1:] &= ~inner[:-1] | new
    last[:-1] &= ~inner[1:] | new
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def distinct(of: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Different keys of each of n texts."""
    order = np.lexsort((keys, of))
    of, keys = of[order], keys[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])
    return np.bincount(of[new], minlength=n)


def statistics(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text; shares are square roots, so that rare signs show."""
    n = len(borders) - 1
    sizes = np.diff(borders)
    doc = np.repeat(np.arange(n), sizes)
    kinds = len(CLASSES) + 1
    counts = np.bincount(doc * kinds + CLASS[data], minlength=n * kinds).reshape(n, kinds)
    share = dict(zip(CLASSES, np.sqrt(counts[:, :-1] / np.maximum(sizes, 1)[:, None]).T))

    start, end = pieces(data, WHITE[data], doc)
    of, length = doc[start], (end - start).astype(float)
    words = np.bincount(of, minlength=n)
    some = np.maximum(words, 1)
    keys = digests(data, start, end)
    mean = np.bincount(of, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(of, length**2, n) / some - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, of, length)
    different = distinct(of, keys, n)
    again = (keys[1:] == keys[:-1]) & (of[1:] == of[:-1])
    capital = (data[start] >= 65) & (data[start] <= 90)

    start, end = pieces(data, data == 10, doc)
    line_of = doc[start]
    lines = np.bincount(line_of, minlength=n)
    line_kinds = distinct(line_of, digests(data, start, end), n)

    columns = {
        "log_bytes": np.log1p(sizes),
        "log_words": np.log1p(words),
        "log_mean_word": np.log1p(mean),
        "log_longest_word": np.log1p(longest),
        "word_spread": spread / (1 + mean),
        "distinct_words": different / some,
        "word_variety": different / np.sqrt(some),
        "same_as_before": np.sqrt(np.bincount(of[1:][again], minlength=n) / some),
        "capitalised_words": np.bincount(of[capital], minlength=n) / some,
        "lines_per_word": np.sqrt(lines / some),
        "repeated_lines": np.sqrt((lines - line_kinds) / np.maximum(lines, 1)),
    }
    columns |= {name: share[name] for name in SHARES}
    return np.stack([columns[name] for name in STATISTICS], axis=1).astype(np.float32)


def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sub_batches(batches, limit=SLICE_BYTES):
        x = statistics(*utf8(batch.column("text")))
        listed = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATISTICS)).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), listed], names=["doc_id", "x"])


def fold_of(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text; a NULL id counts as the empty text, whose remainder is 0."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def document_vectors(df: DataFrame, folds: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, fold, x``: the statistics of every text."""
    found = text_rows(df, id_col, text_col).mapInArrow(vectors, "doc_id long, x array<float>")
    return found.select("doc_id", fold_of(F.col("doc_id"), folds).alias("fold"), "x")


@dataclass(frozen=True)
class FourierMap:
    """Statistics to a constant and ``size`` cosines; the directions follow from the seed."""

    mean: np.ndarray
    scale: np.ndarray
    size: int
    bandwidth: float
    seed: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        width = self.bandwidth * np.sqrt(len(self.mean))
        directions = rng.standard_normal((len(self.mean), self.size)) / width
        shift = rng.uniform(0, 2 * np.pi, self.size)
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / self.size) * np.cos(x @ directions + shift)
        return np.concatenate([np.ones((len(x), 1)), waves], axis=1)


def fourier_map(vectors: DataFrame, size: int, bandwidth: float, seed: int) -> FourierMap:
    """Mean and deviation of each statistic over all documents."""
    x = [F.col("x")[i].cast("double") for i in range(len(STATISTICS))]
    row = vectors.agg(*(F.avg(c) for c in x), *(F.stddev_pop(c) for c in x)).first()
    known = np.array([np.nan if v is None else v for v in row]).reshape(2, -1)
    mean, scale = np.nan_to_num(known[0]), np.nan_to_num(known[1])
    return FourierMap(mean, np.where(scale > 1e-6, scale, 1.0), size, bandwidth, seed)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1).astype(float)


SUMS = "fold int, stripe int, salt int, payload binary"


def products(transform: FourierMap) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of products of [features, target] over the rows of a task, one matrix per fold in stripes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z = np.column_stack([transform(matrix(batch.column("x"))), batch.column("y").to_numpy()])
            folds = batch.column("fold").to_numpy()
            for fold in np.unique(folds):
                rows = z[folds == fold]
                sums[int(fold)] = sums.get(int(fold), 0) + rows.T @ rows
        salt = TaskContext.get().partitionId() % SALTS
        for fold, total in sums.items():
            for stripe, part in enumerate(np.array_split(total, STRIPES)):
                rows = [{"fold": fold, "stripe": stripe, "salt": salt, "payload": part.tobytes()}]
                yield pa.RecordBatch.from_pylist(rows, schema=SUM_SCHEMA)

    return run


SUM_SCHEMA = pa.schema([("fold", pa.int32()), ("stripe", pa.int32()), ("salt", pa.int32()), ("payload", pa.binary())])


def add_payloads(table: pa.Table) -> pa.Table:
    """One row for the rows of a group; payloads are added in a fixed order."""
    parts = sorted(p.as_py() for p in table.column("payload"))
    total = np.sum([np.frombuffer(p) for p in parts], axis=0)
    first = table.slice(0, 1)
    return pa.table(
        [first.column("fold"), first.column("stripe"), first.column("salt"), pa.array([total.tobytes()], pa.binary())],
        schema=SUM_SCHEMA,
    )


def fold_sums(training: DataFrame, transform: FourierMap) -> dict[int, np.ndarray]:
    """The matrix of every fold: added per task, per salt and at last per stripe."""
    sums = training.select("fold", "x", "y").mapInArrow(products(transform), SUMS)
    sums = sums.groupBy("fold", "stripe", "salt").applyInArrow(add_payloads, SUMS)
    sums = sums.groupBy("fold", "stripe").applyInArrow(add_payloads, SUMS)
    stripes: dict[int, dict[int, np.ndarray]] = {}
    for row in sums.collect():
        stripes.setdefault(row.fold, {})[row.stripe] = np.frombuffer(row.payload)
    side = transform.size + 2
    return {fold: np.concatenate([s[i] for i in range(STRIPES)]).reshape(side, side) for fold, s in stripes.items()}


def ridge(sums: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of constant and features; the constant, whose square sum is the number of rows, is free."""
    rows = sums[0, 0]
    gram = sums[:-1, :-1] + penalty * max(rows, 1.0) * np.diag([1e-9] + [1.0] * (len(sums) - 2))
    return np.linalg.solve(gram, sums[:-1, -1])


def to_grid(score: np.ndarray) -> np.ndarray:
    """Cells of raw scores; scores that far outside of 0 to 1 are alike."""
    return np.clip(np.rint(score * GRID), -GRID, 2 * GRID).astype(np.int64)


def isotonic(score: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (mean score, mean target) of every block, both growing."""
    blocks: list[list[float]] = []
    for s, t, w in zip(score, target, weight):
        blocks.append([w, w * s, w * t])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    done = np.array(blocks).reshape(-1, 3)
    return done[:, 1] / done[:, 0], done[:, 2] / done[:, 0]


@dataclass(frozen=True)
class QualityModel:
    """Scores of 0 to 1 from statistics; without training rows every score is 0.5."""

    transform: FourierMap
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), 0.5)
        raw = self.transform(x) @ self.weights
        return np.clip(np.interp(raw, self.knots, self.values), 0.0, 1.0)


def training_rows(vectors: DataFrame, labels: DataFrame, held_out: int) -> DataFrame:
    """Rows of labelled documents outside of the held-out fold; ``y`` is the mean of an id's labels."""
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    said = said.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    return vectors.where(F.col("fold") != held_out).join(said, "doc_id")


def calibrated(training: DataFrame, transform: FourierMap, sums: dict[int, np.ndarray], penalty: float) -> QualityModel:
    """The model of all folds, calibrated by the scores that the other folds' models give each fold."""
    if not sums:
        return QualityModel(transform, np.zeros(0), np.zeros(0), np.zeros(0))
    total = np.sum(list(sums.values()), axis=0)
    others = {f: ridge(total - s if len(sums) > 1 else total, penalty) for f, s in sums.items()}

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, hits = np.zeros(3 * GRID + 1), np.zeros(3 * GRID + 1)
        for batch in batches:
            z = transform(matrix(batch.column("x")))
            folds, y = batch.column("fold").to_numpy(), batch.column("y").to_numpy()
            for fold in np.unique(folds):
                mine = folds == fold
                cell = to_grid(z[mine] @ others[int(fold)]) + GRID
                count += np.bincount(cell, minlength=len(count))
                hits += np.bincount(cell, y[mine], len(hits))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), pa.array(hits[used])], names=["cell", "n", "y"])

    counted = training.select("fold", "x", "y").mapInArrow(cells, "cell long, n double, y double")
    rows = counted.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).orderBy("cell").collect()
    cell, n, y = (np.array([r[i] for r in rows], float) for i in range(3))
    knots, values = isotonic((cell - GRID) / GRID, y / n, n)
    return QualityModel(transform, ridge(total, penalty), knots, values)


def quality_scores(
    df: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_out: int = 0,
    threshold: float = 0.3,
    features: int = 256,
    bandwidth: float = 1.0,
    penalty: float = 1e-4,
    seed: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; score is the probability of ``quality`` 1.

    Labels are learned from ids whose CRC-32 (as text) modulo ``folds`` is not ``held_out``; the other
    remainders are the folds of the calibration. All labelled rows are used, a score depends on the text alone.
    The calibration rounds raw scores to 1/2048, so at most 6145 sums reach the driver, and joins the blocks of
    the isotonic fit by straight lines, so that scores within a block keep their order.

    NULL texts are empty and scored like them. NULL ids belong to remainder 0 and have no labels. Repeated rows
    are scored, and if labelled trained on, each. Labels of one id are averaged, NULL labels left out. Without
    any label every score is 0.5; an empty table gives no rows. Further columns are not read.
    """
    vectors = materialize(document_vectors(df, folds, id_col, text_col), "quality-vectors")
    transform = fourier_map(vectors, features, bandwidth, seed)
    training = materialize(training_rows(vectors, labels, held_out), "quality-training")
    model = calibrated(training, transform, fold_sums(training, transform), penalty)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = pa.array(model(matrix(batch.column("x"))))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fold"), found], names=["doc_id", "fold", "score"])

    scored = vectors.mapInArrow(score, "doc_id long, fold int, score double")
    return scored.select(
        "doc_id",
        (F.col("fold") == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
