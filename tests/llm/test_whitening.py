from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from stintlog.llm import queries
from stintlog.llm.whitening import bit_planes, cross_products, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors: list[list[float]], components: int = 8):
    """n, exact deviations, exact covariance and its eigenvalues, from Python's integers."""
    xs = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, dims = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(dims)]
    deviation = [sum((n * x[i] - sums[i]) ** 2 for i in range(dims)) for x in xs]
    cov = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in xs), n**3) for j in range(dims)] for i in range(dims)]
    values, axes = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    centred = np.array([[float(Fraction(n * x[i] - sums[i], n)) for i in range(dims)] for x in xs])
    order = np.argsort(-values)[:components]
    return n, deviation, values[order], centred @ axes[:, order] / np.sqrt(values[order]), sum(cov[i][i] for i in range(dims))


def check(rows, vectors, components=8):
    n, deviation, values, whitened, trace = brute([list(map(float, np.float32(v))) for _, v in vectors], components)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(got) == sorted(i for i, _ in vectors)
    signs = np.sign([got[vectors[0][0]][c + 1].whitened * whitened[0, c] for c in range(len(values))])
    for k, (i, _) in enumerate(vectors):
        assert sorted(got[i]) == list(range(1, len(values) + 1))
        for c, value in enumerate(values):
            r = got[i][c + 1]
            assert (r.n, int(r.deviation)) == (n, deviation[k])
            assert r.whitened == pytest.approx(signs[c] * whitened[k, c], rel=1e-6, abs=1e-7)
            assert r.explained == pytest.approx(value / float(trace), rel=1e-9)
            assert r.identity_error < 1e-9


def test_planes_give_exact_products():
    rng = np.random.Generator(np.random.PCG64(3))
    for bits in ([1, 5, 3, 1], [40, 2, 33], [62, 61]):
        y = np.array([[int(rng.integers(1 << b)) for b in bits] for _ in range(131)], dtype=np.uint64)
        got = cross_products(bit_planes(y, bits), bits)
        for i in range(len(bits)):
            for j in range(i, len(bits)):
                assert int(got[i, j]) == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))


def test_equals_brute_force(spark):
    rng = random.Random(5)
    vectors = [(i, [rng.gauss(0, 0.1 * (d + 1)) + d for d in range(11)]) for i in range(300)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(40)]  # copies of one vector
    odd = [(2000, None), (2001, [None] + [0.0] * 10), (2002, [float("nan")] * 11), (2003, [float("inf")] + [0.0] * 10)]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors + odd], SCHEMA)
    df = df.select("*", *[F.lit(-1).alias(c) for c in ("v", "n", "component", "dim", "limb", "part", "i", "j")])
    check(whiten(df.repartition(7)).collect(), vectors)


def test_wide_values_stay_exact(spark):
    rng = random.Random(6)
    vectors = [(i, [rng.choice([-1, 1]) * 2.0 ** rng.randrange(-12, 40), rng.random() * 1e9, rng.random()]) for i in range(50)]
    # The third dimension's variance is lost in doubles beside the others, so two components are left.
    check(whiten(spark.createDataFrame([(i, v, 1) for i, v in vectors], SCHEMA)).collect(), vectors, components=2)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(queries.QUERIES["op11_whitening"](spark, sf).collect(), [(r.vec_id, r.embedding) for r in table])


def test_odd_rows(spark):
    def run(rows):
        return whiten(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)).collect()

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [])]) == [] and run([(1, [0.5, 0.25])]) == []
    assert run([(i, [0.5, 0.25]) for i in range(4)]) == []  # no variance
    rows = run([(None, [1.0, 2.0]), (5, [2.0, 2.0]), (5, [4.0, 2.0])])  # null and repeated ids, a flat dimension
    assert {r.component for r in rows} == {1} and sorted((r.vec_id is None, r.vec_id) for r in rows) == [(False, 5), (False, 5), (True, None)]
    short = run([(1, [1.0]), (2, [2.0, 0.5]), (3, [3.0, -0.5])])  # a missing end counts as 0.0
    long = run([(1, [1.0, 0.0]), (2, [2.0, 0.5]), (3, [3.0, -0.5])])
    assert sorted(map(tuple, short)) == sorted(map(tuple, long)) and len(short) == 6
    huge = run([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 4.0])])
    assert len(huge) and all(math.isfinite(r.whitened) for r in huge)
