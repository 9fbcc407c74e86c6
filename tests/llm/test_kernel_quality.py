import os
import random
import zlib

import numpy as np
import pytest
from helpers import SCHEMA, awkward, frame

from loticote.llm import kernel_quality as kq
from loticote.llm import queries
from loticote.llm.hashing import digests

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string"


def arrays(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    return data, np.cumsum([0, *(len(t.encode()) for t in texts)])


def test_statistics():
    texts = ["", "One two two\nTWO two!\nOne two two", "é é\n", " \n\t", "x" * 1000, "a|b # 12,5;"]
    found = {name: column for name, column in zip(kq.STATISTICS, kq.statistics(*arrays(texts)).T)}
    for i, t in enumerate(texts):
        words, raw = t.split(), t.encode()
        sizes = [len(w.encode()) for w in words]
        lines = [x for x in t.split("\n") if x]
        some = max(len(words), 1)
        want = {
            "log_bytes": np.log1p(len(raw)),
            "log_words": np.log1p(len(words)),
            "log_mean_word": np.log1p(sum(sizes) / some),
            "log_longest_word": np.log1p(max(sizes, default=0)),
            "distinct_words": len(set(words)) / some,
            "same_as_before": np.sqrt(sum(a == b for a, b in zip(words, words[1:])) / some),
            "capitalised_words": sum(w[0] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for w in words) / some,
            "repeated_lines": np.sqrt((len(lines) - len(set(lines))) / max(len(lines), 1)),
            "upper": np.sqrt(sum(c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in raw) / max(len(raw), 1)),
            "wide": np.sqrt(sum(c > 127 for c in raw) / max(len(raw), 1)),
            "bar": np.sqrt(t.count("|") / max(len(raw), 1)),
        }
        for name, value in want.items():
            assert found[name][i] == pytest.approx(value, abs=1e-6), (name, t)


def test_statistics_do_not_depend_on_neighbours():
    texts = [r[1] or "" for r in awkward()]
    together = kq.statistics(*arrays(texts))
    for text, row in zip(texts, together):
        assert np.array_equal(kq.statistics(*arrays([text]))[0], row)


def test_digests():
    words = ["", "a", "b", "ab", "abcdefgh", "abcdefghi", "abcdefgh" * 2, "a" * 16, "a" * 17, "\x00", "\x00\x00"]
    thue = "a"
    for _ in range(11):
        thue += thue.translate(str.maketrans("ab", "ba"))
    words += [thue, thue.translate(str.maketrans("ab", "ba"))]
    data, borders = arrays(words)
    one = digests(data, borders[:-1], borders[1:])
    assert len(set(one.tolist())) == len(words)
    data, borders = arrays(["z" * 3, *words])
    assert np.array_equal(digests(data, borders[1:-1], borders[2:]), one)


def test_isotonic_against_definition():
    """Min-max formula of isotonic regression."""
    rng = np.random.default_rng(2)
    target, weight = rng.random(40), rng.integers(1, 5, 40).astype(float)
    score = np.arange(40.0)
    knots, values = kq.isotonic(score, target, weight)
    mean = lambda a, b: np.average(target[a : b + 1], weights=weight[a : b + 1])
    want = [max(min(mean(a, b) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    sizes = [np.sum(np.isclose(want, v)) for v in values]
    assert np.allclose(np.repeat(values, sizes), want) and np.all(np.diff(knots) > 0)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((30, 5))
    z = kq.FourierMap(np.zeros(5), np.ones(5), 20_000, 1.0, 3)(x)[:, 1:]
    distance = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * 5))).max() < 0.05


def test_normal_equations_are_those_of_all_rows(spark):
    """Sums over many tasks equal the sums over one table, and the weights minimise the penalised error."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, len(kq.STATISTICS))).astype(np.float32)
    y = (x[:, 0] > 0).astype(float)
    rows = [(int(i % 4 + 1), x[i].tolist(), float(y[i])) for i in range(300)]
    transform = kq.FourierMap(np.zeros(x.shape[1]), np.ones(x.shape[1]), 16, 1.0, 5)
    sums = kq.fold_sums(spark.createDataFrame(rows, "fold int, x array<float>, y double").repartition(7), transform)
    z = np.column_stack([transform(x), y])
    assert sorted(sums) == [1, 2, 3, 4]
    total = sum(sums.values())
    assert np.allclose(total, z.T @ z)
    weights = kq.ridge(total, 0.01)
    gradient = z[:, :-1].T @ (z[:, :-1] @ weights - y) + 0.01 * 300 * np.r_[1e-9, np.ones(16)] * weights
    assert np.abs(gradient).max() < 1e-6


def labelled(n=600):
    rng = random.Random(8)
    rows, said = [], []
    for i in range(n):
        good = rng.random() < 0.7
        pool = [f"word{j}" for j in range(300)] if good else ["BUY!!", "NOW!!", "CHEAP!!"]
        rows.append((i, " ".join(rng.choice(pool) for _ in range(rng.randint(20, 200))), None, None, 0, "clash", "clash"))
        if rng.random() < 0.7:
            said.append((i, int(good), 0, "clash"))
    return rows, said


def test_learns_and_keeps_to_its_folds(spark):
    rows, said = labelled()
    extra = [(None, "", None, None, None, None, None), (7000, None, None, None, None, None, None), rows[3], rows[3]]
    more = said + said[:30] + [(None, 1, 0, None), (10**8, 0, 0, None), (5, None, None, None)]
    table = frame(spark, rows + extra)
    got = kq.quality_scores(table, spark.createDataFrame(more, LABELS)).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
    truth = dict((i, q) for i, q, _, _ in said)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and sum(r.predicted == truth[r.doc_id] for r in held) > 0.97 * len(held)
    # Turning the labels of the held-out ids around changes nothing.
    turned = [(i, 1 - q if i is not None and q is not None and zlib.crc32(str(i).encode()) % 5 == 0 else q, t, x) for i, q, t, x in more]
    again = kq.quality_scores(table, spark.createDataFrame(turned, LABELS)).collect()
    assert np.allclose(sorted(r.score for r in again), sorted(r.score for r in got))


def test_without_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert kq.quality_scores(spark.createDataFrame([], SCHEMA), none).count() == 0
    got = kq.quality_scores(frame(spark, awkward()), none).collect()
    assert len(got) == len(awkward()) and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(4, 1, 0, None)], LABELS)
    assert all(r.score == pytest.approx(1) for r in kq.quality_scores(frame(spark, awkward()), one).collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy(spark):
    got = queries.QUERIES["op13_fourier_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
