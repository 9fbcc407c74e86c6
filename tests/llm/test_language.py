import itertools
import os
import zlib

import numpy as np
import pytest
from helpers import SCHEMA, awkward, frame

from loticote.llm import language

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("seed", range(3))
def test_marginals_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    lengths = np.array([3, 1, 4, 2])
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    score, moves, first = rng.normal(size=(10, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, expected = language.marginals(score, starts, lengths, moves, first)
    want, pairs = np.zeros((10, 3)), np.zeros((3, 3))
    for s, n in zip(starts, lengths):
        paths = list(itertools.product(range(3), repeat=int(n)))
        mass = np.array([
            np.exp(first[p[0]] + sum(score[s + i, p[i]] for i in range(n)) + sum(moves[a, b] for a, b in zip(p, p[1:])))
            for p in paths
        ])
        mass /= mass.sum()
        for p, m in zip(paths, mass):
            for i in range(n):
                want[s + i, p[i]] += m
            for a, b in zip(p, p[1:]):
                pairs[a, b] += m
    assert np.allclose(got, want) and np.allclose(expected, pairs)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_accuracy_and_code_switching(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.detect_language(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    rows = [(r.text, r.lang) for r in docs.where("lang in ('en', 'de')").limit(200).collect()]
    field = language.fit(rows[:150], 16, 25, 0.15, 0.02)
    import pyarrow as pa

    mixed = {lang: next(t for t, l in rows[150:] if l == lang and len(t) > 2000).split()[:60] for lang in ("en", "de")}
    likely, _ = language.Labeller(field, 1000).words(pa.array([" ".join(mixed["en"]) + ". " + " ".join(mixed["de"])]))
    top = likely.argmax(1)
    truth = [field.labels.index("en")] * 60 + [field.labels.index("de")] * (len(top) - 60)
    assert len(top) <= 120 and np.mean(top == np.array(truth)[: len(top)]) > 0.9


def test_awkward_rows(spark):
    rows = awkward() + [(500 + i, "le chat noir dort ici. " * 3, "fr", "s", 0, None, None) for i in range(12)]
    rows += [(600, "... 123 !!", None, None, None, None, None)]
    got = language.detect_language(frame(spark, rows), keep=("shard",)).collect()
    assert len(got) == len(rows) and "keep_shard" in got[0].asDict()
    by_id = {r.doc_id: r for r in got}
    for i in (0, 1, 2, 600):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und") for r in got)
    assert by_id[505].lang_pred == "fr"


def test_no_labels_and_empty_table(spark):
    assert {r.lang_pred for r in language.detect_language(frame(spark, [(1, "abc", None, None, None, None, None)])).collect()} == {"und"}
    assert language.detect_language(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_label_is_learned(spark):
    """Copies of one row do not use up the places of another label."""
    german = "Der schnelle Fuchs springt über den faulen Hund und läuft dann nach Hause."
    rows = [(0, german, "de", None, None, None, None)] * 700
    french = ["le", "la", "maison", "est", "grande", "où", "été", "chat", "dans", "jardin", "avec", "être"]
    rng = np.random.default_rng(3)
    for i in range(300):
        rows.append((4000 + i, " ".join(rng.choice(french, 12)), "fr", None, None, None, None))
    got = language.detect_language(frame(spark, rows)).collect()
    assert len(got) == 1000
    assert {r.lang_pred for r in got if r.doc_id == 0} == {"de"}
    assert sum(r.lang_pred == "fr" for r in got if r.doc_id >= 4000) >= 295


def test_labels_beyond_the_bound(spark):
    rows = [(4 * i, f"word{i % 7} text{i % 7} more{i % 7}", f"l{i % 7}", None, None, None, None) for i in range(200)]
    rows += [(10_000 + i, "other words of a rare label", "rare", None, None, None, None) for i in range(3)]
    got = language.detect_language(frame(spark, rows), max_labels=7).collect()
    assert {r.lang_pred for r in got} <= {f"l{i}" for i in range(7)} and len(got) == len(rows)
