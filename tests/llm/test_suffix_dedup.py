from __future__ import annotations

import random
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from stintlog.llm import suffix_dedup as sd
from tests.llm.frames import SCHEMA, frame, texts, words


def brute(datas, length):
    counts = Counter(d[i : i + length] for d in datas for i in range(len(d) - length + 1))
    return [sd.merged([(i, i + length) for i in range(len(d) - length + 1) if counts[d[i : i + length]] > 1]) for d in datas]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=30).map(str.encode), min_size=1, max_size=5).filter(any), st.integers(1, 6))
def test_transform_finds_repeats(datas, length):
    assert sd.repeats_between(datas, length) == brute(datas, length)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=60))
def test_suffix_array(data):
    symbols = np.array([*data, -1], dtype=np.int64) + 1
    assert sd.suffix_array(symbols).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())


def want(rows):
    datas = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), d, spans in zip(rows, datas, brute(datas, sd.LENGTH)):
        kept = b"".join(d[e:s] for e, s in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(d)]))
        out.append((i, len(d), len(d) - len(kept), len(spans), kept))
    return sorted(map(str, out))


def check(spark, rows, **kw):
    got = sd.remove_repeats(frame(spark, rows, **kw)).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in got) == want(rows)


def test_equals_brute_force(spark):
    check(spark, texts(), clash=True)


def test_passages_at_every_offset(spark):
    rng = random.Random(6)
    passage = words(rng, 120)
    rows = [(i, words(rng, 30) + passage[i * 7 : i * 7 + rng.randrange(190, 420)] + words(rng, 30)) for i in range(40)]
    rows += [(100, passage[:200]), (101, passage[:199]), (102, "q" * 500), (103, "rs" * 220 + passage[300:520])]
    check(spark, rows)


def test_crowded_anchors_are_extended(spark, monkeypatch):
    """A line shorter than a repeat, in texts that differ around it, and some that agree further."""
    monkeypatch.setattr(sd, "GROUP", 2)
    rng = random.Random(8)
    line = words(rng, 25)[:150]
    around = [(words(rng, 20), words(rng, 20)) for _ in range(12)]
    rows = [(i, f"{a} {line} {b}") for i, (a, b) in enumerate(around)]
    rows += [(50 + i, f"{a[-60:]} {line} {words(rng, 20)}") for i, (a, _) in enumerate(around)]
    rows += [(80 + i, f"{words(rng, 20)} {line} {b[:60]}") for i, (_, b) in enumerate(around)]
    check(spark, rows)


def test_long_texts_are_chunked_in_stretches(monkeypatch):
    monkeypatch.setattr(sd, "STRETCH", 300)
    rng = random.Random(9)
    data = words(rng, 400).encode()
    up, down = sd._powers(sd._BASE, 4096), sd._powers(sd._INVERSE, 4096)
    found, again = sd.chunks(data, up, down)
    starts = sorted((s, n) for _, _, s, n, _, _ in found)
    assert not again
    covered = [w for s, n in starts for w in range(s, s + n - sd.LENGTH + 1)]
    assert sorted(covered) == list(range(len(data) - sd.LENGTH + 1))


def test_no_rows_and_text_columns(spark):
    assert sd.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, t) for i, t in texts() if i is not None]
    docs = frame(spark, rows, clash=True)
    cut = sd.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
