from __future__ import annotations

import random

import numpy as np

from stintlog.llm import minhash
from stintlog.llm.components import components
from tests.llm.frames import SCHEMA, frame, texts, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """doc_id -> (n_shingles by row, component, kept); ids are the nodes, rows of an id share it."""
    nodes = [("id", i) if i is not None else ("row", k) for k, (i, _) in enumerate(rows)]
    sets = [shingles(t) for _, t in rows]
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[find(nodes[a])] = find(nodes[b])
    lowest = {}
    for n in nodes:
        if n[0] == "id":
            lowest[find(n)] = min(lowest.get(find(n), n[1]), n[1])
    component = [lowest.get(find(n)) for n in nodes]
    return [(i, len(s), c, i == c) for (i, _), s, c in zip(rows, sets, component)]


def check(spark, rows, **kw):
    got = minhash.near_duplicates(frame(spark, rows, **kw)).collect()
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in got) == sorted(map(str, brute(rows)))


def test_equals_brute_force(spark):
    check(spark, texts(), clash=True)


def test_chains_and_hot_groups(spark):
    """Copies that drift apart: first and last share little, each is linked with the next."""
    rng = random.Random(2)
    own = words(rng, 200).split()
    rows = []
    for i in range(40):
        own[5 * i % 200] = f"new{i}"
        rows.append((1000 - i, " ".join(own)))
    base = words(rng, 80).split()
    for i in range(60):
        near = list(base)
        near[rng.randrange(80)] = f"other{i}"
        rows.append((2000 + i, " ".join(near)))
    check(spark, rows)


def test_large_buckets_are_cut_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rng = random.Random(4)
    passage = words(rng, 90)
    rows = [(i, f"{passage} {words(rng, rng.randrange(5, 60))}") for i in range(40)]
    rows += [(100 + i, t + " end") for i, t in rows[::3]]
    check(spark, rows)


def test_limit_is_exact(spark):
    base = [f"w{i}" for i in range(34)]  # 30 shingles
    at = base + [f"x{i}" for i in range(10)]  # 40, of which 30 are shared: 75 percent
    over = base + [f"y{i}" for i in range(11)]
    rows = [(1, " ".join(base)), (2, " ".join(at)), (3, " ".join(over))]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_no_rows(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_drop_near_copies(spark):
    rows = [(i, t) for i, t in texts() if i is not None]
    docs = frame(spark, rows, clash=True)
    left = minhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _, _, kept in brute(rows) if kept)


def test_estimate_is_close():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(40):
        both, a, b = (rng.integers(0, 2**63, size=n, dtype=np.uint64) for n in (600, 100, 100))
        one, two = np.unique(np.r_[both, a]), np.unique(np.r_[both, b])
        equal = np.array([(minhash.sketch(one) == minhash.sketch(two)).sum()])
        errors.append(minhash.corrected(equal, np.array([700]), np.array([700]))[0] - 0.75)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_registers_hold_zeros_and_mantissa():
    one = minhash.sketch(np.array([12345], dtype=np.uint64))
    for value, register in zip((np.uint64(12345) * minhash.MIXES).tolist(), one.tolist()):
        zeros = 64 - value.bit_length()
        assert register >> minhash.MANTISSA == zeros
        assert register & 1023 == (value << zeros >> 53 & 1023) if zeros < 53 else True


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {n: find(n) for e in edges for n in e if e[0] != e[1]}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == want and len(got) == len(want)
