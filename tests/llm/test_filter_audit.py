import os
import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from helpers import SCHEMA, awkward, frame

from loticote.llm import filter_audit, queries
from loticote.llm.filter_audit import add_words, audit_filters

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int, source string"
COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(rows, labels):
    """Every order applied to every document, one after another."""
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(r[0], first.get(r[1] or "", r[0]))
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    docs = []
    for r in rows:
        t = r[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": r[0] is not None and r[0] > first[t],
        }
        docs.append((r[3] or "", {k for k, v in fails.items() if v}, r[0] in good, r[0] in toxic))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            every = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                fails = [d for d in every if f in d[1]]
                out[part, order, step] = (len(left), len(gone), len(fails) - len(gone), sum(d[1] == {f} for d in every),
                                          sum(d[2] for d in gone), sum(d[3] for d in gone))
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def documents():
    rng = random.Random(5)
    words = ["alpha", "Beta", "GAMMA", "#tag", "a|b", "x", "y", "z1", "é", "日本"]
    rows = awkward()
    for i in range(400):
        n = rng.choice([3, 50, 199, 200, 201, 400])
        pool = rng.choice([words, [f"w{j}" for j in range(500)], words[5:] + [f"v{j}" for j in range(120)]])
        text = " ".join(rng.choice(pool) for _ in range(n))
        if rng.random() < 0.3 and len(rows) > 20:
            text = rng.choice(rows)[1]
        rows.append((rng.choice([None, 1000 + i, 1000 + i, 1000 + i, 900]), text, None, rng.choice(["hot", "hot", "p", None, ""]), 0, "s", "c"))
    return rows


def labels(rows):
    rng = random.Random(6)
    out = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 0, 1, None]), "clash") for r in rows if rng.random() < 0.6]
    return out + out[:20] + [(10**9, 1, 1, None), (None, 1, 1, None)]


def test_against_every_order(spark):
    rows = documents()
    said = labels(rows)
    got = audit_filters(frame(spark, rows), spark.createDataFrame(said, LABELS)).collect()
    assert tuple(got[0].asDict()) == COLUMNS
    want = brute(rows, said)
    assert len(got) == len(want)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want


def test_stretches(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(filter_audit, "STRETCH_ROWS", 10)
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 32, 100)
    batch = pa.RecordBatch.from_pydict({"part": ["a", "b"] * 50, "good": [True] * 100, "toxic": [False] * 100, "word": words})
    parts = list(filter_audit.count_words(iter([batch.slice(i, 7) for i in range(0, 100, 7)])))
    assert len(parts) > 3
    total = np.zeros(32, int)
    for p in parts:
        total += np.array([c for g, c in zip(p.column("part").to_pylist(), p.column("counts").to_pylist()) if g == "a"]).sum(axis=0)
    assert total.tolist() == [(words[::2] >> i & 1).sum() for i in range(32)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 31, 1000, 10_007])
def test_add_words(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    assert add_words(words).tolist() == [int((words >> np.uint32(i) & 1).sum()) for i in range(32)]


def test_empty(spark):
    none = spark.createDataFrame([], LABELS)
    assert audit_filters(spark.createDataFrame([], SCHEMA), none).count() == 0
    assert audit_filters(frame(spark, awkward()), none).where("good_lost + toxic_lost > 0").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_sql(spark):
    got = queries.QUERIES["op12_survival_audit"](spark, SF)
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = con.sql(queries.ORACLE["op12_survival_audit"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
