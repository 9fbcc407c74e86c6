import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from helpers import SCHEMA, awkward, frame

from loticote.llm import mixing

SF = "/root/testdata/sf0.01"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", low) + [None]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_unigrams_equal_brute_force(spark):
    rows = awkward() + [(i, f"common words here and number {i % 9} Common", None, None, None, None, None) for i in range(300, 360)]
    got = mixing.score_texts(frame(spark, rows), batch_bytes=10_000).collect()
    counts = Counter(w for r in rows if not is_held(r[0]) for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        c = [counts[w] for w in words(r[1])]
        base = sum(math.log10((x + 1) / (n + v + 1)) for x in c)
        want.append((repr(r[0]), is_held(r[0]), len(c), sum(x > 0 for x in c), n, round(base, 6)))
    have = [(repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(have) == sorted(want) and any(r.held_out for r in got)
    assert all(r.score < 0 for r in got)


def plain_counts(texts):
    """Bytes after every context of the training texts."""
    out = {}
    for text in texts:
        data = bytes(8) + b" ".join(text.lower().encode().split()) + b"\xff"
        for i in range(8, len(data)):
            for order in mixing.ORDERS:
                out.setdefault(data[i - order : i], Counter())[data[i]] += 1
    return out


def plain_inputs(counts, data, i, own=0):
    """The gate and the inputs of the eight bits of a byte, each in favour of the bit that came."""
    seen = [counts.get(data[i - order : i], Counter()) for order in mixing.ORDERS]
    known = [sum(c.values()) - own > 0 for c in seen]
    inputs = []
    for d in range(8):
        bit = data[i] >> (7 - d) & 1
        row = []
        for c, k in zip(seen, known):
            here = Counter()
            for byte, n in c.items():
                if byte >> (8 - d) == data[i] >> (8 - d):
                    here[byte >> (7 - d) & 1] += n
            odds = math.log((here[bit] - own + 0.05) / (here[1 - bit] + 0.05)) if k else 0
            row.append(max(-127, min(127, round(odds * 12))) / 12)
        inputs.append([*row, 1 if bit else -1])
    return sum(known), inputs


def plain_bits(counts, text, weights, rate):
    """The model one bit at a time."""
    data = bytes(8) + b" ".join(text.lower().encode().split()) + b"\xff"
    refined = np.zeros((4, 8))
    change = np.zeros((4, 8))
    total = 0.0
    for i in range(8, len(data)):
        if (i - 8) % mixing.SPAN == 0:
            refined, change = refined + change, np.zeros((4, 8))
        gate, inputs = plain_inputs(counts, data, i)
        for d, x in enumerate(inputs):
            z = max(-12, min(30, sum((weights[gate, k, d] + refined[k, d]) * x[k] for k in range(4))))
            total += math.log2(1 + math.exp(-z))
            for k in range(4):
                change[k, d] += rate * x[k] / (1 + math.exp(z))
    return total


def sample_texts(rng):
    texts = ["the  Cat sat\n on the mat " * 4, "", " ", "\u00e9\U0001f642 xyz", "the mat is where the cat sat, é" * 3]
    texts += [" ".join("".join(map(chr, rng.integers(97, 102, 4))) for _ in range(n)) for n in (200, 20, 90)]
    return [*texts, texts[0], "".join(map(chr, rng.integers(33, 126, 150))), "\u00e9\U0001f642 xyzzy the cat"]


def test_bits_equal_the_plain_model(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_IDS", 4)
    monkeypatch.setattr(mixing, "LONG_TEXT", 400)
    texts = sample_texts(np.random.default_rng(0))
    df = frame(spark, [(i, t, None, None, None, None, None) for i, t in enumerate(texts)])
    assert any(is_held(i) for i in range(len(texts)))
    counts = plain_counts(t for i, t in enumerate(texts) if not is_held(i))
    monkeypatch.setattr(mixing, "HELD_GRAMS", 500)
    monkeypatch.setattr(mixing, "SIDE_BY_SIDE", 3)
    # Without texts to fit them to, the start weights are the constants.
    got = {r.doc_id: r for r in mixing.score_texts(df, fit_texts=0, batch_bytes=300, rate=0.02).collect()}
    for i, text in enumerate(texts):
        want = plain_bits(counts, text, mixing.first_weights(), 0.02)
        assert got[i].score == pytest.approx(-want * math.log10(2), rel=1e-3)


def table_of(texts, block, held=()):
    return pa.table({
        "doc_id": pa.array(range(len(texts)), pa.int64()),
        "text": texts,
        "held_out": [i in held for i in range(len(texts))],
        "block": pa.array([block] * len(texts), pa.int64()),
    })


def answered(tables, bits=2):
    # Small batches: a block asks in several messages.
    batches = [b for t in tables for b in t.to_batches(max_chunksize=3)]
    sent = pa.Table.from_batches([m for b in batches for m in mixing.asker(bits, 200)(iter([b]))])
    out = [mixing.answer(sent.filter(pc.equal(sent.column("bucket"), b))) for b in set(sent.column("bucket").to_pylist())]
    return pa.concat_tables(out)


def test_start_weights_are_fitted_without_own_counts():
    rng = np.random.default_rng(3)
    texts = sample_texts(rng)
    chosen = [texts[i] for i in (0, 4, 5, 7)]
    told = answered([table_of(texts, 0), table_of(chosen, mixing.FIT_BLOCK)])
    told = told.filter(pc.equal(told.column("block"), mixing.FIT_BLOCK))
    block = mixing.Block(table_of(chosen, mixing.FIT_BLOCK), told, 200)
    weights = mixing.fit_weights(block, ridge=2.0)
    counts = plain_counts(texts)
    slope = -2.0 * (weights - mixing.first_weights())
    for text in chosen:
        data = bytes(8) + b" ".join(text.lower().encode().split()) + b"\xff"
        for i in range(8, len(data)):
            gate, inputs = plain_inputs(counts, data, i, own=1)
            for d, x in enumerate(inputs):
                slope[gate, :, d] += np.array(x) / (1 + math.exp(weights[gate, :, d] @ x))
    # The slope of the penalized likelihood is zero at the fitted weights.
    assert np.abs(slope).max() < 1e-3


def test_start_weights_are_fitted_to_all_training_texts(spark, monkeypatch):
    texts = [*sample_texts(np.random.default_rng(3)), "long text " * 40]
    monkeypatch.setattr(mixing, "BLOCK_IDS", 4)
    monkeypatch.setattr(mixing, "LONG_TEXT", 300)
    fit_all, fitted = mixing.fit_all, []
    monkeypatch.setattr(mixing, "fit_all", lambda answers: fitted.append(fit_all(answers, ridge=2.0)) or fitted[-1])
    df = frame(spark, [(i, t, None, None, None, None, None) for i, t in enumerate(texts)])
    assert mixing.score_texts(df, batch_bytes=300).count() == len(texts)
    [weights] = fitted
    chosen = [t for i, t in enumerate(texts) if not is_held(i)]
    assert len(chosen) < len(texts)
    counts = plain_counts(chosen)
    slope = -2.0 * (weights - mixing.first_weights())
    for text in chosen:
        data = bytes(8) + b" ".join(text.lower().encode().split()) + b"\xff"
        for i in range(8, len(data)):
            gate, inputs = plain_inputs(counts, data, i, own=1)
            for d, x in enumerate(inputs):
                slope[gate, :, d] += np.array(x) / (1 + math.exp(weights[gate, :, d] @ x))
    assert np.abs(slope).max() < 1e-2


def test_probabilities_of_all_next_bytes_sum_to_one():
    texts = sample_texts(np.random.default_rng(5))
    tails = [b"the ca" + bytes([b]) for b in range(1, 128) if not mixing.SPACE[b] and not 65 <= b <= 90]
    told = answered([table_of(texts, 0), table_of([t.decode() for t in tails], 1, held=range(len(tails)))])
    told = told.filter(pc.equal(told.column("block"), 1))
    block = mixing.Block(table_of([t.decode() for t in tails], 1), told, 1 << 20)
    odds, mixed = mixing.gram_tables(block, mixing.first_weights())
    (batch, distinct, where, borders), = block.batches
    gram = np.searchsorted(block.grams, distinct)[where]
    rows = gram[borders[1:] - 2]  # the last byte of each text, before the end
    p = (1 / (1 + np.exp(-mixed[rows].astype(float)))).prod(1)
    assert 0.5 < p.sum() <= 1 + 1e-6


def test_different_contexts_have_different_keys():
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(0, 1 << (8 * mixing.GRAM), 200_000).astype(np.uint64))
    pairs = mixing.Pairs(grams)
    want = sum(len(np.unique(grams >> np.uint64(8 * (mixing.GRAM - 1 - order)))) for order in mixing.ORDERS)
    assert len(np.unique(pairs.keys)) == len(pairs.keys) == want


def test_blocks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_BYTES", 2000)
    texts = [f"text {i} " * (10 if i % 2 else 60) for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sizes = df.withColumn("block", mixing.text_block(df)).groupBy("block").agg({"text": "count"}).collect()
    assert max(r[1] for r in sizes) <= 2000 * 200 / sum(map(len, texts)) and sum(r[1] for r in sizes) == 200


def test_fit_rows_are_bounded(spark):
    rows = [(i % 50, f"text {i % 50}") for i in range(300)] + [(1, ""), (2, "x" * mixing.LONG_TEXT), (None, "without id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert mixing.fit_rows(df, 20).count() == 20 and mixing.fit_rows(df, 100).count() == 51
    assert mixing.fit_rows(df, 0).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_texts(spark):
    got = mixing.score_texts(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 10
    print(sum(r.score for r in held) / sum(r.base_score for r in held))
    assert np.mean([r.bits_per_byte for r in held]) < 2.2


def test_empty_table(spark):
    assert mixing.score_texts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_that_a_polynomial_takes_for_one(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(i, t, *[None] * 5) for i, t in enumerate([word, other, word])]
    got = mixing.score_texts(frame(spark, rows)).collect()
    held = [is_held(r[0]) for r in rows]
    counts = Counter(w for r, h in zip(rows, held) if not h for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    for r in got:
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(rows[r.doc_id][1]))
        assert r.train_tokens == n and r.base_score == pytest.approx(want)


def test_hot_ids_and_no_ids(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_IDS", 16)
    monkeypatch.setattr(mixing, "LONG_TEXT", 300)
    rows = [((None, 4, 100 + i)[i % 3], f"words {i % 11} and {i} " * (1 + i % 5), *[None] * 5) for i in range(180)]
    got = mixing.score_texts(frame(spark, rows), batch_bytes=5_000).collect()
    counts = Counter(w for r in rows if not is_held(r[0]) for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = sorted(round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(r[1])), 6) for r in rows)
    assert sorted(round(r.base_score, 6) for r in got) == want
