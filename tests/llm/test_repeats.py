import os
import random
from collections import Counter

import pytest
from helpers import SCHEMA, awkward, frame

from loticote.llm import exchange
from loticote.llm.repeats import remove_repeats


def brute(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans, i = [], 0
        while i < len(t):
            if gone[i]:
                j = i
                while j < len(t) and gone[j]:
                    j += 1
                spans.append((i, j))
                i = j
            else:
                i += 1
        out.append((repr(r[0]), len(t), tuple(spans), bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out)


def result(spark, rows, length):
    got = remove_repeats(frame(spark, rows), length=length).collect()
    return sorted((repr(r.doc_id), r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in got)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("length", [32, 200])
def test_equal_to_brute_force(spark, seed, length):
    rng = random.Random(seed)
    letters = ["abcdefgh ", "ab", "éü🙂x ", "abcdefghijklmnopqrstuvwxyz     "][seed]
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [make(rng.randint(length // 2, 3 * length)) for _ in range(6)]
    rows = awkward()
    for i in range(40):
        text = "".join(rng.choice([make(rng.randint(0, 2 * length)), rng.choice(passages)[rng.randint(0, 9) :]]) for _ in range(4))
        if i % 7 == 0 and i:
            old = rows[-1][1]
            text = old[: len(old) // 2] + "#" + old[len(old) // 2 :]
        rows.append((i * 300, text, None, None, None, None, None))
    rows.append((5, "a" * 3000, None, None, None, None, None))
    rows.append((99_999, make(50) + "a" * 250, None, None, None, None, None))
    # Exactly as long as a window, and one byte short of it.
    edge = make(length)
    rows += [(700 + i, t, None, None, None, None, None) for i, t in enumerate([edge, "z" + edge, edge[:-1], "y" + edge[:-1]])]
    assert result(spark, rows, length) == brute(rows, length)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = remove_repeats(docs).collect()
    have = sorted((repr(r.doc_id), r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in got)
    assert have == brute(rows, 200)


def test_hot_ids_and_no_ids(spark, monkeypatch):
    monkeypatch.setattr(exchange.block_of, "__defaults__", ("doc_id", "text", 16, 300))
    rng = random.Random(21)
    passages = ["".join(rng.choice("abcd ") for _ in range(70)) for _ in range(12)]
    rows = []
    for i in range(240):
        parts = [rng.choice(passages) if rng.random() < 0.4 else str(rng.random()) for _ in range(rng.randint(1, 9))]
        rows.append(((None, 5, 100 + i)[i % 3], "".join(parts), None, None, None, None, None))
    assert result(spark, rows, 32) == brute(rows, 32)
