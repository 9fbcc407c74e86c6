import random

import numpy as np
import pytest
from helpers import SCHEMA, awkward, frame

from loticote.llm import decontaminate as d

LETTERS = "abcdefgh  "


def clean(text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return d.normalized(raw, np.array([0, len(raw)]))[0].tobytes()[:-1]


def distance_inside(pattern, text):
    """Least edits of the whole pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = text[:i] + rng.choice(["", "z", "zy"]) + text[i + rng.randint(0, 1) :]
    return text


def words(rng, n):
    return "".join(rng.choice(LETTERS) for _ in range(n))


@pytest.mark.parametrize("seed", range(4))
def test_windows_equal_full_alignment(seed):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.choice([20, 45, 80, 200]))) for i in range(8)] + [(50, "short"), (51, "")]
    docs = []
    for _ in range(30):
        _, item = rng.choice(items[:8])
        docs.append(words(rng, rng.randint(0, 60)) + edited(rng, item, rng.randint(0, len(item) // 6)) + words(rng, rng.randint(0, 60)))
    docs += ["", " ", "Ä" * 300]
    patterns = d.Patterns(items, 60, 30, 0.1)
    raw = [x.encode() for x in docs]
    data = np.frombuffer(b"".join(raw), np.uint8)
    borders = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    text, window, edits, start, end = patterns.find(data, borders)
    best = {}
    for t, w, e in zip(text.tolist(), window.tolist(), edits.tolist()):
        best[t, w] = min(best.get((t, w), 10**9), e)
    want = {}
    for t, x in enumerate(docs):
        for w, pattern in enumerate(patterns.windows):
            n = distance_inside(pattern.tobytes(), clean(x))
            if n <= patterns.budget[w]:
                want[t, w] = n
    assert best == want and len(want) > 5
    assert all(0 <= s < e <= len(raw[t]) for t, s, e in zip(text.tolist(), start.tolist(), end.tolist()))


def test_leaks_and_clean_rows(spark):
    rng = random.Random(1)
    item = words(rng, 250)
    long_text = words(rng, 60_000)
    rows = awkward() + [
        (200, "x " * 50 + item.upper().replace(" ", "\n - ") + " y", None, None, None, None, None),
        (201, long_text + item[:150] + long_text, None, None, None, None, None),
        (202, long_text, None, None, None, None, None),
        (203, item[:60], None, None, None, None, None),
        (204, item, None, None, None, None, None),
        (204, item, None, None, None, None, None),
    ]
    bench = spark.createDataFrame([(1, item, "a"), (1, item, "a"), (None, item, "b"), (2, None, "c"), (3, "", "d")], "item_id long, text string, doc_id string")
    df = frame(spark, rows)
    got = d.find_leaks(df, bench, block_bytes=100).collect()
    assert sorted(r.doc_id for r in got) == [200, 200, 201, 201, 204, 204, 204, 204]
    by_id = {r.doc_id: r for r in got if r.item_id == 1}
    assert by_id[204].start == 0 and by_id[204].end == len(item.rstrip()) and by_id[204].edits == 0
    kept = d.drop_leaks(df, bench)
    assert kept.columns == df.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(r[0]) for r in rows if r[0] not in (200, 201, 204))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.find_leaks(none, bench).count() == 0
    assert d.find_leaks(frame(spark, awkward()), bench).count() == 0
    assert d.drop_leaks(frame(spark, awkward()), bench).count() == len(awkward())
    assert d.find_leaks(none, spark.createDataFrame([(1, "some benchmark text of a length")], "item_id long, text string")).count() == 0


def test_parts_are_found_at_every_offset():
    rng = random.Random(5)
    item = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(60))
    other = [" ".join("".join(rng.choice("qrstuvwxyz") for _ in range(5)) for _ in range(40)) for _ in range(2)]
    patterns = d.Patterns([(1, item), (2, other[0])], 120, 60, 0.1, 68, 4)
    size = 71
    docs = [f"{other[1]} {item[i : i + size].strip()} {other[1]}" for i in range(len(item) - size + 1)]
    docs = [x for i, x in enumerate(docs) if item[i] != " " and item[i + size - 1] != " "] + [other[1]]
    raw = [x.encode() for x in docs]
    borders = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    text, window, edits, _, _ = patterns.find(np.frombuffer(b"".join(raw), np.uint8), borders)
    assert set(text[edits == 0].tolist()) == set(range(len(docs) - 1))
    assert {patterns.item_ids[i] for i in patterns.items[window].tolist()} == {1}


@pytest.mark.parametrize("seed", range(4))
def test_both_scales_equal_full_alignment(seed):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.choice([20, 45, 80, 200]))) for i in range(8)]
    docs = []
    for _ in range(30):
        _, item = rng.choice(items)
        a = rng.randint(0, len(item) // 2)
        docs.append(words(rng, rng.randint(0, 60)) + edited(rng, item[a : a + 60], rng.randint(0, 4)) + words(rng, rng.randint(0, 60)))
    patterns = d.Patterns(items, 60, 30, 0.1, 40, 7)
    raw = [x.encode() for x in docs]
    borders = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    text, window, edits, _, _ = patterns.find(np.frombuffer(b"".join(raw), np.uint8), borders)
    best = {}
    for t, w, e in zip(text.tolist(), window.tolist(), edits.tolist()):
        best[t, w] = min(best.get((t, w), 10**9), e)
    want = {}
    for t, x in enumerate(docs):
        for w, pattern in enumerate(patterns.windows):
            n = distance_inside(pattern.tobytes(), clean(x))
            if n <= patterns.budget[w]:
                want[t, w] = n
    assert best == want and len(want) > 5


def test_a_part_of_an_item_is_a_leak(spark):
    rng = random.Random(3)
    item = words(rng, 400)
    rows = [(1, words(rng, 500) + item[130:215] + words(rng, 500), None, None, None, None, None), (2, words(rng, 900), None, None, None, None, None)]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in d.find_leaks(frame(spark, rows), bench).collect()] == [(1, 7)]
    assert [r.doc_id for r in d.drop_leaks(frame(spark, rows), bench).collect()] == [2]
