import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from helpers import SCHEMA, awkward, frame

from loticote.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_same_ids_as_the_library(spark, library):
    rows = awkward() + [
        (300 + i, t, None, None, None, None, None)
        for i, t in enumerate(["aaaa aaaaaaa  aaa", "   ", "a\x00b", "  lead", "trail  ", " private \U0010ffff"])
    ]
    got = pieces.encode_texts(frame(spark, rows), MODEL, batch_bytes=20_000, memory_words=50).collect()
    have = sorted((repr(r.doc_id), r.n_tokens, tuple(r.ids)) for r in got)
    want = [(repr(r[0]), tuple(library.encode(r[1] or ""))) for r in rows]
    assert have == sorted((i, len(ids), ids) for i, ids in want)
    assert all(r.round_trip for r in got)


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(library, seed):
    rng = random.Random(seed)
    letters = ["ab ", "the ing er on", "éèü ñ 日本🙂x", "aabb\n\t.,:;'0123"][seed]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    encoder = pieces.BatchEncoder(pieces.load(MODEL), 1000)
    ids, borders = encoder(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])] == library.encode(texts)
    assert pieces.decode(pieces.load(MODEL), ids, borders).to_pylist() == texts


def test_space_sign_is_decoded_as_space(spark):
    df = frame(spark, [(1, "a▁b", None, None, None, None, None)])
    assert [r.round_trip for r in pieces.encode_texts(df, MODEL).collect()] == [False]


def test_decoding(spark, library):
    texts = ["one two", "", "é🙂 x", " spaced  out "]
    rows = [(i, library.encode(t)) for i, t in enumerate(texts)]
    rows += [(10, None), (11, [None, 99_999_999, rows[0][1][0]]), (12, [3 + 0xFF])]
    got = {r.doc_id: r.text for r in pieces.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>"), MODEL).collect()}
    assert [got[i] for i in range(4)] == texts
    assert got[10] == "" and got[11] == "one" and got[12] == "�"


def test_suffix_order_and_search():
    encoder = pieces.Encoder(pieces.load(MODEL))
    text = "▁theretherethe"
    starts, sizes, found = encoder.edges(encoder.table.code_of[np.array([ord(c) for c in text])])
    table = encoder.table
    have = {(int(s), int(n), int(p)) for s, n, p in zip(starts, sizes, found)}
    want = {
        (i, len(t), p) for t, p in table.all_ids.items() if table.stable[p]
        for i in range(len(text)) if text.startswith(t, i)
    }
    assert have == want and len(starts) == len(want)


def test_empty_table(spark):
    assert pieces.encode_texts(spark.createDataFrame([], SCHEMA), MODEL).count() == 0
