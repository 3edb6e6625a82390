from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from stintlog.llm.exact_dedup import drop_exact_copies, exact_groups
from tests.llm.frames import SCHEMA, frame, plain_rows, texts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = keep(known) if known else None
        done = False
        for i in ids:
            kept = i == best and not done
            done |= kept
            out.append((i, best, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups_equal_brute_force(spark, keep):
    rows = texts()
    got = plain_rows(exact_groups(frame(spark, rows, clash=True), keep=keep))
    want = brute(rows, min if keep == "smallest" else max)
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_only_a_to_z_is_lowered(spark):
    got = exact_groups(frame(spark, [(1, "É"), (2, "é"), (3, "A"), (4, "a")])).collect()
    assert {r.doc_id: r.group_size for r in got} == {1: 1, 2: 1, 3: 2, 4: 2}


def test_no_python_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_groups(empty).count() == 0
    plan = exact_groups(empty)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_drop_keeps_columns_and_one_row_each(spark):
    rows = texts()
    docs = frame(spark, rows, clash=True)
    left = drop_exact_copies(docs, keep="largest")
    assert left.columns == docs.columns
    assert sorted((r.text or "").translate(LOWER) for r in left.collect()) == sorted({(t or "").translate(LOWER) for _, t in rows})


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        exact_groups(frame(spark, []), keep="newest")
