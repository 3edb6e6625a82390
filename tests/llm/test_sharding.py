from __future__ import annotations

import zlib
from collections import Counter
from math import comb

import numpy as np
from hypothesis import given, settings, strategies as st

from stintlog.llm import sharding
from tests.llm.frames import SCHEMA, frame, texts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=6), st.integers(1, 5), st.integers(0, 99))
def test_matrix_has_its_sums(parts, targets, seed):
    sizes = [sum(parts) // targets + (i < sum(parts) % targets) for i in range(targets)]
    matrix = sharding.communication_matrix(parts, sizes, seed)
    assert matrix.sum(axis=1).tolist() == parts and matrix.sum(axis=0).tolist() == sizes and (matrix >= 0).all()


def test_matrix_is_hypergeometric():
    draws = [sharding.communication_matrix([6, 6], [4, 8], seed)[0, 0] for seed in range(3000)]
    assert abs(np.mean(draws) - 2) < 0.06 and abs(np.var(draws) - 4 * 0.5 * 0.5 * 8 / 11) < 0.08


def test_large_draws(monkeypatch):
    """Beyond the library's numbers: exact sums, and below them the library's distribution."""
    parts, targets = [3_000_000_000, 5, 2_000_000_000], [2_500_000_001, 2_500_000_000, 4]
    matrix = sharding.communication_matrix(parts, targets, 3)
    assert matrix.sum(axis=1).tolist() == parts and matrix.sum(axis=0).tolist() == targets and (matrix >= 0).all()
    assert abs(matrix[0, 0] / 3e9 - 0.5) < 1e-3
    monkeypatch.setattr(sharding, "LARGE", 0)
    rng = np.random.Generator(np.random.PCG64(1))
    for good, bad, n in ((5, 7, 6), (3, 1, 2), (40, 60, 30), (1, 9, 10), (9, 1, 1)):
        seen = Counter(sharding.drawn(rng, good, bad, n) for _ in range(20_000))
        for k in range(n + 1):
            want = comb(good, k) * comb(bad, n - k) / comb(good + bad, n) if k <= good and n - k <= bad else 0
            assert abs(seen[k] / 20_000 - want) < 0.015


def test_blocks_cover_shards():
    blocks = sharding.block_sizes(1000, 7, rows_per_block=50, most=70)
    sizes = Counter()
    for shard, start, size in blocks:
        assert start == sizes[shard]
        sizes[shard] += size
    assert sum(sizes.values()) == 1000 and max(sizes.values()) - min(sizes.values()) <= 1


def test_every_row_has_one_slot(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 7)
    rows = texts()
    got = sharding.shuffle_to_shards(frame(spark, rows, clash=True), shards=5).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = Counter(r.shard for r in got)
    assert set(slots) == set(range(5)) and max(slots.values()) - min(slots.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in slots.items())
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_seeds_differ_and_repeat(spark):
    docs = frame(spark, texts())
    places = [sorted((r.text_crc32, r.shard, r.slot) for r in sharding.shuffle_to_shards(docs, 4, seed).collect()) for seed in (1, 1, 2)]
    assert places[0] == places[1] != places[2]


def test_no_rows(spark):
    assert sharding.shuffle_to_shards(spark.createDataFrame([], SCHEMA)).count() == 0
