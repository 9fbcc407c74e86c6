import random

import public_tokenizers
import pyarrow as pa
import pytest
from helpers import SCHEMA, awkward, frame
from tokenizers import Tokenizer

from loticote.llm.token_counts import OverlapCounter, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False))


@pytest.mark.parametrize("chunk", [65_536, 50])
def test_counts_equal_the_library(spark, tokenizer, chunk):
    rows = awkward()
    got = count_tokens(frame(spark, rows), PATH, limit=20, chunk_chars=chunk, overlap_chars=10).collect()
    want = sorted((repr(r[0]), len((r[1] or "").encode()), plain(tokenizer, r[1])) for r in rows)
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 20) for r in got)


@pytest.mark.parametrize("seed", range(6))
def test_splices(tokenizer, seed):
    rng = random.Random(seed)
    letters = "ab cé🙂\n1'sÉ. <|endoftext|>" if seed % 2 else "abcdefgh "
    text = "".join(rng.choice(letters) for _ in range(3000)) + "w" * 700 + " end"
    counter = OverlapCounter(tokenizer, rng.randint(20, 200), rng.randint(1, 19))
    assert counter.count(text) == plain(tokenizer, text)
    assert counter.widened > 0


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_chunks_of_many_texts_at_once(tokenizer):
    rng = random.Random(7)
    words = ["la", "maison", "Über", "été", "42", "x" * 90, "a.b", "東京", "\u0085", "-"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) + "\n" * (n % 3) for n in (0, 1, 5, 80, 300, 900, 40)]
    counter = OverlapCounter(tokenizer, 200, 40, memory_words=8)
    for _ in range(2):
        assert counter.counts(pa.array(texts)).tolist() == [plain(tokenizer, t) for t in texts]
