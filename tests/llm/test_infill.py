import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, awkward, frame
from pyspark.sql import functions as F

from loticote.llm import infill, queries
from loticote.llm.infill import cut_points, fill_in_middle, restore

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)
SF = "/root/testdata/sf0.001"


def brute(doc_id, text):
    """The definition, one text at a time."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    units = UNITS.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def special(start=1000):
    texts = ["<P> marked", "a<S>b", "<", "<<P", "P>" * 9, "\x00", "\x00" * 17, "zZ[{`@", "é", "日本🙂x", "🙂" * 9,
             "abcdefgh", "abcdefg", "abcdefghi", "a" * 4096, "ab\ncd\r\n", "x" * 7 + "é", "x" * 6 + "日" + "y" * 8]
    rng = random.Random(3)
    texts += ["".join(rng.choice("ab Z[é日🙂\n\x00<PSM>") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return [(start + i, t, None, None, None, "clash", None) for i, t in enumerate(texts)]


def test_against_definition(spark):
    rows = awkward() + special() + [(5, "many words and Units, " * 40_000, None, None, None, None, None)]
    got = fill_in_middle(frame(spark, rows))
    back = got.withColumn("text", restore(F.col("output"), F.col("form"))).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in back))) == sorted(repr(brute(r[0], r[1])) for r in rows)
    assert sorted(r.text for r in back) == sorted(r[1] or "" for r in rows)


def test_every_cut():
    text = "ab🙂 é日Zz9\x00 tail{of}[words]`@"
    units = UNITS.findall(text)
    n = len(units)
    data = np.frombuffer(text.encode(), np.uint8)
    size = len(data)
    for a in range(n + 1):
        b = np.arange(n + 1)
        texts, borders = np.tile(data, n + 1), np.arange(n + 2) * size
        got = cut_points(texts, borders, np.full(n + 1, a), b)
        for j in range(n + 1):
            low, high = min(a, j), max(a, j)
            assert [c[j] for c in got] == [n, len("".join(units[:low])), len("".join(units[low:high]))]


def test_slices(spark, monkeypatch):
    rows = special()
    monkeypatch.setattr(infill, "SLICE_BYTES", 16)
    texts = [r[1] for r in rows]
    ones = pa.array([7 * i for i in range(len(texts))])
    cut = infill.cut_texts.func(pa.array(texts), ones, ones).to_pylist()
    assert [c["n"] for c in cut] == [len(UNITS.findall(t)) for t in texts]


def test_empty_table(spark):
    assert fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_sql(spark):
    got = queries.QUERIES["op11_swar_infill"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(queries.ORACLE["op11_swar_infill"])
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r) for r in got.select(*want.columns).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, want.fetchall()))
    assert {r[want.columns.index("form")] for r in rows} == {"plain", "psm", "spm"}
