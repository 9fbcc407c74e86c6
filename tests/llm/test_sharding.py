import zlib
from collections import defaultdict

import pytest
from helpers import SCHEMA, awkward, frame

from loticote.llm.sharding import minimax_shards


def best_capacity(sizes, shards):
    """The smallest capacity by trying every sum of neighbours."""
    sums = {sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)}
    for capacity in sorted(sums):
        used, load = 1, 0
        for s in sizes:
            if s > capacity:
                used = shards + 1
                break
            if load + s > capacity:
                used, load = used + 1, 0
            load += s
        if used <= shards:
            return capacity
    return 0


@pytest.mark.parametrize("shards", [1, 3, 8])
@pytest.mark.parametrize("extra", [0, 40])
def test_minimax(spark, shards, extra):
    rows = awkward() + [(200 + i, f"text {i % 25} " * (i % 7 + 1), None, "s", 0, None, None) for i in range(extra)]
    got = minimax_shards(frame(spark, rows), shards).collect()
    assert len(got) == len(rows)
    assert sorted((repr(r.doc_id), r.size, repr(r.text_crc32)) for r in got) == sorted(
        (repr(r[0]), len((r[1] or "").encode()) + 1, repr(None if r[1] is None else zlib.crc32(r[1].encode())))
        for r in rows
    )
    groups, of = defaultdict(int), defaultdict(set)
    for r in got:
        groups[r.group_key] += r.size
        of[r.group_key].add(r.shard)
    assert all(len(s) == 1 for s in of.values())
    order = sorted(groups)
    placed = [min(of[k]) for k in order]
    assert placed == sorted(placed) and set(placed) <= set(range(shards))
    load = defaultdict(int)
    for k in order:
        load[min(of[k])] += groups[k]
    assert max(load.values()) == best_capacity([groups[k] for k in order], shards)
    for s in set(placed):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_empty_table(spark):
    assert minimax_shards(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_text(spark):
    rows = [(i, "same", None, None, None, None, None) for i in range(20)]
    assert {r.shard for r in minimax_shards(frame(spark, rows), 4).collect()} == {0}
