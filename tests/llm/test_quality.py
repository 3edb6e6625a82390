from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stintlog.llm import quality, queries
from stintlog.llm.boosting import Forest, cuts_of, fit
from stintlog.llm.quality import STATISTICS, judge, learn, score_documents, statistics
from tests.llm.frames import frame, texts, words


def of(text: str) -> dict[str, float]:
    return dict(zip(STATISTICS, statistics(text)))


def test_statistics():
    held = "The cat, the CAT sat sat.\n\nA1 ### 9!!\nA1 ### 9!!"
    s = of(held)
    assert s["log characters"] == math.log1p(len(held)) and s["log words"] == math.log1p(12) and s["log lines"] == math.log1p(3)
    assert s["upper"] == 6 / len(held) and s["digits"] == 4 / len(held) and s["symbols"] == 6 / len(held)
    assert s["white space"] == sum(c.isspace() for c in held) / len(held) and s["stops"] == 5 / len(held)
    assert s["different words"] == 9 / 12 and s["commonest word"] == 2 / 12
    assert s["words in capitals"] == 1 / 12 and s["words of marks only"] == 2 / 12 and s["words with a digit"] == 4 / 12
    assert s["different lines"] == 2 / 3 and s["words in a line"] == 4
    counts = Counter(held)
    assert s["commonest character"] == pytest.approx(max(counts.values()) / len(held))
    assert s["entropy of characters"] == pytest.approx(-sum(c / len(held) * math.log(c / len(held)) for c in counts.values()))


def test_statistics_of_odd_texts():
    assert statistics("") == [0.0] * len(STATISTICS)
    for text in (" ", "\n\n", "x", "🙂漢字", "\x00\x01", "a" * 300_000, "\ud800", "\x1c\x85 ", "!!! ???"):
        values = statistics(text)
        assert len(values) == len(STATISTICS) and all(math.isfinite(v) for v in values)


def walked(forest: Forest, row) -> float:
    total = forest.base
    for at in forest.roots.tolist():
        while forest.left[at] != at:
            at = int(forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at])
        total += forest.value[at]
    return total


def test_flat_arrays_equal_a_walk():
    rng = np.random.Generator(np.random.PCG64(2))
    x = rng.normal(size=(400, 6))
    x[:, 3] = rng.integers(0, 3, 400)  # few values
    x[:, 4] = 1.0  # nothing to cut
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 3] == 1)).astype(float)
    forest = fit(x, y, trees=60)
    assert np.allclose(forest.margins(x), [walked(forest, row) for row in x])
    assert ((forest.probabilities(x) > 0.5) == y).mean() > 0.95
    assert not (forest.feature[forest.left != np.arange(len(forest.left))] == 4).any()
    first = fit(x, y, trees=1, depth=1, rate=1.0)
    # The first cut is the best of all cuts.
    p = 1 / (1 + math.exp(-first.base))
    best = 0.0
    for f, cuts in enumerate(cuts_of(x)):
        for c in cuts:
            low = x[:, f] <= c
            g = [(y - p)[low].sum(), (y - p)[~low].sum()]
            h = [low.sum() * p * (1 - p), (~low).sum() * p * (1 - p)]
            if min(h) >= 2:
                best = max(best, sum(a * a / (b + 2) for a, b in zip(g, h)))
    root = (x[:, first.feature[0]] <= first.threshold[0])
    got = sum((y - p)[m].sum() ** 2 / (m.sum() * p * (1 - p) + 2) for m in (root, ~root))
    assert got == pytest.approx(best)


def test_one_kind_of_labels():
    for y in (np.zeros(5), np.ones(5), np.zeros(0)):
        forest = fit(np.ones((len(y), 3)), y)
        assert len(forest.roots) == 0 and len({*forest.probabilities(np.ones((4, 3))).tolist()}) == 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op13_quality"](spark, sf)
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    assert rows.count() == docs.count()
    found = rows.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    assert all(r.predicted == (r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out]
    bad = [r for r in held if r.quality == 0]
    assert sum(r.predicted == 0 for r in bad) / len(bad) >= 0.95
    assert sum(r.predicted for r in held if r.quality) / (len(held) - len(bad)) >= 0.99


def labelled(rng):
    rows = [(i, words(rng, rng.randrange(30, 80)) + ".") for i in range(200)]
    rows += [(1000 + i, " ".join(w + "%%%" for w in words(rng, 50).split())) for i in range(60)]
    return rows, [(i, int(i < 1000), 0) for i, _ in rows]


LABELS = "doc_id long, quality int, toxic int"


def test_only_labels_outside_the_fold_count(spark):
    rows, labels = labelled(random.Random(3))
    docs = frame(spark, rows)

    def scores(pairs):
        return {r.doc_id: r.score for r in judge(docs, spark.createDataFrame(pairs, LABELS)).collect()}

    want = scores(labels)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    assert scores(turned) == want
    assert scores([*labels, *labels]) == want and scores(labels[::-1]) == want


def test_odd_rows(spark):
    rows, labels = labelled(random.Random(4))
    docs = frame(spark, rows + texts(), clash=True).withColumn("value", F.lit(-1)).withColumn("quality", F.lit(9))
    more = [(None, 1, 0), (5, None, 0), (5, 0, 0), (777_777, 0, 0), (3, 7, 0), *labels]
    table = spark.createDataFrame(more, LABELS).select("*", F.lit(1).alias("id"), F.lit("x").alias("text"))
    got = judge(docs, table).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[400].score == by_id[401].score  # null counts as empty
    same = [r.score for r in score_documents(frame(spark, [(1, "Same text."), (1, "Same text."), (None, "Same text.")]), learn(docs, table)).collect()]
    assert len(same) == 3 and len({*same}) == 1
    assert judge(frame(spark, []), table).count() == 0
    none = judge(docs, spark.createDataFrame([], LABELS)).collect()
    assert len({r.score for r in none}) == 1


def test_sample_bound_keeps_the_odds(spark):
    rows, labels = labelled(random.Random(5))
    docs, table = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    few = learn(docs, table, sample=40)
    assert few.base == pytest.approx(learn(docs, table).base, abs=0.1)
    got = {r.doc_id: r.predicted for r in score_documents(docs, few).collect()}
    assert sum(got[i] == q for i, q, _ in labels) / len(labels) > 0.97
    assert quality.SAMPLE >= 1_000
