from __future__ import annotations

import numpy as np
import pytest

from stintlog.llm import neighbours as nb
from stintlog.llm.hilbert import hilbert_positions

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score double, class_id long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, -1, -1.0, -1) for i, v in rows], SCHEMA)


def exact(rows, most=20, every=20):
    usable = {i: np.asarray(v, dtype=np.float32).astype(float) for i, v in sorted(rows, reverse=True, key=lambda r: r[1] or [0]) if i is not None}
    ids = np.array(sorted(usable))
    matrix = np.stack([usable[i] for i in ids])
    out = {}
    for i in ids[ids % every == 0]:
        score = (matrix * usable[i]).sum(axis=1)
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != i][:most]
        out[int(i)] = [(int(ids[k]), float(score[k])) for k in order]
    return out


@pytest.mark.parametrize(("dims", "bits"), [(1, 6), (2, 5), (3, 4), (4, 3)])
def test_hilbert_neighbours_are_neighbours(dims, bits):
    side = np.arange(1 << bits)
    points = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    order = np.argsort(hilbert_positions(points, bits))
    assert sorted(hilbert_positions(points, bits)) == list(range(len(points)))
    assert (np.abs(np.diff(points[order], axis=0)).sum(axis=1) == 1).all()


def test_recall_and_order_on_the_given_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = {}
    for r in nb.nearest(vectors).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = exact(rows)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert np.mean(hits) / 20 >= 0.9
    by_id = {i: np.asarray(v, dtype=float) for i, v in rows}
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert np.allclose([s for _, s in found], [by_id[q] @ by_id[i] for i, _ in found], atol=1e-12)


def test_hot_vector_ties_and_rows_left_out(spark):
    rng = np.random.default_rng(4)
    hot = rng.normal(size=8).round(2).tolist()
    rows = [(i, hot) for i in range(0, 90)] + [(i, rng.normal(size=8).round(2).tolist()) for i in range(100, 200)]
    odd = [(300, None), (320, [0.0] * 8), (340, [None] + [1.0] * 7), (360, [float("nan")] * 8), (380, [float("inf")] + [0.0] * 7), (400, [1.0, 2.0]), (None, hot), (20, hot)]
    got = {}
    for r in nb.nearest(table(spark, rows + odd), most=20, every=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = exact(rows)
    assert set(got) == set(want)
    for q, found in want.items():
        if q < 90:  # the hot vector: its copies tie, smaller ids first
            assert [i for i, _ in got[q]] == [i for i, _ in found]
        assert got[q] == sorted(got[q], key=lambda f: (-f[1], f[0])) and len(got[q]) == 20
    hits = [len({i for i, _ in got[q]} & {i for i, _ in found}) / 20 for q, found in want.items()]
    assert np.mean(hits) >= 0.9


def test_few_rows(spark):
    got = nb.nearest(table(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])])).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 0.5), (0, 2, 2, 0.0)]
    assert nb.nearest(table(spark, [])).count() == 0
    assert nb.nearest(table(spark, [(7, [1.0, 0.0])])).count() == 0
