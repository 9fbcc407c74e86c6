import random
import re

import pytest
from helpers import SCHEMA, awkward, frame
from pyspark.sql import functions as F

from loticote.llm import exchange
from loticote.llm.shingles import keep_one, similar_documents


def shingle_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = [shingle_set(r[1]) for r in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                up[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return sorted((repr(r[0]), len(sets[i]), repr(least.get(top(i)))) for i, r in enumerate(rows))


def change(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_all_pairs(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = awkward()
    for base in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([6, 12, 30, 75, 200]))]
        if base % 3 == 0:
            words += passage
        for copy in range(rng.choice([1, 2, 5, 40])):
            text = " ".join(change(rng, words, rng.choice([0, 1, 1, 2, 3])))
            rows.append((rng.randrange(10**6), text.upper() if copy % 2 else text, None, None, None, None, None))
    # A chain: neighbours are similar, the ends are not.
    chain = [rng.choice(vocabulary) for _ in range(120)]
    for i in range(20):
        rows.append((10**7 + i, " ".join(chain[: 100 - 4 * i] + [f"z{j}" for j in range(4 * i)]), None, None, None, None, None))
    # Changes from few words, so that copies share some of them.
    few = [rng.choice(vocabulary) for _ in range(90)]
    for i in range(40):
        words = list(few)
        for _ in range(i % 7):
            words[rng.choice([10, 25, 40, 55, 70, 85])] = rng.choice(["x", "y"])
        rows.append((2 * 10**7 + i, " ".join(words), None, None, None, None, None))
    # Without rounds, comparing what meets in the lists has to find every link.
    got = similar_documents(frame(spark, rows), rare=4, rounds=0 if seed == 1 else 2).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == brute(rows)


def test_one_row_of_each_group(spark):
    rows = awkward()
    df = frame(spark, rows)
    kept = keep_one(df)
    assert kept.columns == df.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [0, 1, 2, 3, 4, 5, 6, 7, 8] and sum(r.doc_id is None for r in kept.collect()) == 1


def test_empty_table(spark):
    assert similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_long_periodic_words_stay_apart(spark):
    word = thue_morse(2048)
    rows = [(1, word, *[None] * 5), (2, word.translate(str.maketrans("ab", "ba")), *[None] * 5)]
    assert {r.component_id for r in similar_documents(frame(spark, rows)).collect()} == {1, 2}


def hot_rows():
    """A third of all rows without an id, a third under one id, some long texts."""
    rng = random.Random(12)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(60)) for _ in range(40)]
    rows = []
    for i in range(900):
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 30])):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 10**9)}"
        rows.append(((None, 77, 1000 + i)[i % 3], " ".join(words), *[None] * 5))
    return rows


def test_hot_ids_and_no_ids(spark, monkeypatch):
    rows = hot_rows()
    monkeypatch.setattr(exchange, "BLOCK_IDS", 64)
    monkeypatch.setattr(exchange.block_of, "__defaults__", ("doc_id", "text", 64, 2000))
    got = similar_documents(frame(spark, rows)).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == brute(rows)
    kept = keep_one(frame(spark, rows)).collect()
    assert {repr(r.doc_id) for r in kept} - {"None"} == {i for _, _, i in brute(rows)} - {"None"}


@pytest.mark.parametrize("hot_ids", [1000, 0])
def test_blocks_are_bounded(spark, monkeypatch, hot_ids):
    monkeypatch.setattr(exchange, "HOT_IDS", hot_ids)
    rows = [((None, 77, i)[i % 3], f"text {i} " * 20) for i in range(6000)] + [(i, f"long {i} " * 500) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    block = exchange.block_of(df, ids=64, long_text=4000)
    sizes = df.groupBy(block.alias("b")).agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("rows")).collect()
    assert max(r.n for r in sizes) <= 64 * 4000 and max(r.rows for r in sizes) <= 3 * 64
    # The same row is in the same block, whoever reads it and in whatever order.
    again = df.orderBy(F.rand(3)).select(F.struct("doc_id", "text").alias("r"), block.alias("b")).distinct()
    assert again.count() == len(rows)
