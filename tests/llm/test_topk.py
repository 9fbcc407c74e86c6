import random

import pytest

from loticote.llm.topk import voronoi_topk

SCHEMA = "vec_id long, embedding array<double>, label int, cell string, v string"


def brute(rows, k=5, every=50):
    import math

    ok = {
        (r[0], tuple(math.floor(256 * x) for x in r[1]))
        for r in rows
        if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    }
    out = []
    for qid, q in ok:
        if qid % every == 0:
            scores = sorted(
                {(-sum(a * b for a, b in zip(q, v)), i) for i, v in ok if i != qid and len(v) == len(q)}
            )[:k]
            out += [(qid, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_all_pairs(spark, seed):
    rng = random.Random(seed)
    vector = lambda d: [rng.gauss(0, 1) * (1 + 5 * (rng.random() < 0.1)) for _ in range(d)]
    rows = [(i, vector(6), 0, None, None) for i in range(400)]
    rows += [(500 + i, [0.5] * 6, 0, None, None) for i in range(120)]  # one vector a third of the time
    rows += [(1000, None, 0, None, None), (1050, [1.0, None], 0, None, None), (None, [1.0] * 6, 0, None, None)]
    rows += [(1100, [float("nan")] * 6, 0, None, None), (1150, [float("inf")] * 6, 0, None, None)]
    rows += [(1200, [1.0, 2.0], 0, None, None), (1201, [2.0, 1.0], 0, None, None), (1250, [], 0, None, None)]
    rows += [rows[3], rows[50]]
    df = spark.createDataFrame(rows, SCHEMA)
    got = voronoi_topk(df, pivots=5, sample=20, block_queries=4, chunk_points=30).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_large_values_stay_exact(spark):
    rows = [(i * 50, [float(2**30 + i), float(i)], 0, None, None) for i in range(4)]
    got = voronoi_topk(spark.createDataFrame(rows, SCHEMA), scale=1, query_every=50).collect()
    want = {
        (q[0], v[0]): int(q[1][0]) * int(v[1][0]) + int(q[1][1]) * int(v[1][1]) for q in rows for v in rows
    }
    assert all(r.score == (want[r.query_id, r.vec_id]) for r in got)


def test_empty_table(spark):
    assert voronoi_topk(spark.createDataFrame([], SCHEMA)).count() == 0


def test_more_vector_lengths_than_are_sampled(spark):
    rng = random.Random(9)
    rows = []
    for dim in range(1, 71):
        for j in range(3):
            rows.append((len(rows) * 25, [rng.uniform(-1, 1) for _ in range(dim)], 0, None, None))
    df = spark.createDataFrame(rows, SCHEMA)
    got = voronoi_topk(df, sample=2, sampled_lengths=5)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))
