"""Small documents with the awkward cases that every operator has to take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, score string"


def awkward(seed: int = 7) -> list[tuple]:
    rng = random.Random(seed)
    words = ["alpha", "béta", "gamma", "Delta", "x1", "épsilon", "zeta,", "Ünder", "日本", "o'neil"]
    texts = [
        None,
        "",
        " ",
        "one",
        " ".join(rng.choice(words) for _ in range(30)),
        " ".join(rng.choice(words) for _ in range(3000)),
        "nospace" * 2000,
        "\n\t tabs\r\n and odd   spaces \x0b\x1c",
        "🙂 emoji é combining ́ <|endoftext|> done",
    ]
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), "clash", None) for i, t in enumerate(texts)]
    rows.append((None, "no id here", None, None, None, None, None))
    rows.append((100, texts[4], None, "src1", 5, None, None))
    rows.append((100, texts[4], None, "src1", 5, None, None))  # a repeated row
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
