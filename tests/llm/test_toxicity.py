from __future__ import annotations

import pickle
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from stintlog.llm import toxicity as tx
from stintlog.llm.string_kernel import DECAY, ORDER, LinearScore, codes, kernel, raw_kernel, windows
from tests.llm.frames import frame, words

SF = "/root/testdata/sf0.01"


def brute_kernel(s: str, t: str) -> float:
    """The definition: every common subsequence, decayed by what it spans in both."""

    def features(x):
        out = {}
        for at in combinations(range(len(x)), ORDER):
            key = "".join(x[i] for i in at)
            out[key] = out.get(key, 0.0) + DECAY ** (at[-1] - at[0] + 1)
        return out

    a, b = features(s), features(t)
    return sum(v * b[k] for k, v in a.items() if k in b)


def test_kernel_equals_definition():
    rng = random.Random(1)
    for _ in range(40):
        s, t = ("".join(rng.choice("abcd") for _ in range(rng.randrange(3, 10))) for _ in range(2))
        got = raw_kernel(codes([s]), codes([t]))[0]
        assert got == pytest.approx(brute_kernel(s, t), rel=1e-9, abs=1e-12)


def test_linear_score_equals_sum_of_kernels():
    rng = np.random.default_rng(2)
    landmarks = [windows(u)[0] for u in ("idiot", "clown", "worthless", "ab")]
    beta = rng.normal(size=len(landmarks))
    units = ["idxiot", "clowns", "worthles", "abc", "", "zzzzzz", "i"]
    want = kernel(codes([windows(u)[0] for u in units]), codes(landmarks)) @ beta - 1
    assert np.allclose(LinearScore(landmarks, beta, -1.0)(units), want)


def test_gaps_and_inserted_letters_stay_near():
    near = kernel(codes([windows(u)[0] for u in ("idiot", "idxiot", "idiiot", "thonre")]), codes([windows("idiot")[0]]))[:, 0]
    assert near[0] == pytest.approx(1) and near[1] > 0.4 and near[2] > 0.4 and near[3] < 0.05


def test_long_units_are_cut_in_windows():
    score = LinearScore([windows("idiot")[0]], np.ones(1), 0.0)
    with_insult, without = score(["abcefghjklm" * 40 + "idiot" + "npqrsuvwz" * 40, "abcefghjklm" * 40 + "npqrsuvwz" * 40])
    assert with_insult > without == 0


def corpus(n: int = 400, seed: int = 3):
    rng = random.Random(seed)
    insults = ["idiot", "clown", "worthless", "moron", "stupid"]
    docs, labels = [], []
    for i in range(n):
        text = words(rng, rng.randrange(20, 60)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(insults))
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_learns_insults_and_leaves_clean_texts_alone(spark):
    docs, labels = corpus()
    table = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    got = tx.detect(frame(spark, docs, clash=True), table).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in docs if __import__("zlib").crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    model = tx.learn(frame(spark, docs), table)
    scorer = tx.Scorer(model)
    bent = ["you i.d.i.o.t", "such an id-iot", "i d i o t", "an idiott here", "the mo*ron"]
    assert (model.probability(scorer.margins(bent)) > 0.5).mean() >= 0.8
    assert (model.probability(scorer.margins(["", "   ", "abc", "12 34", "one clean text"])) < 0.5).all()


def test_held_out_accuracy_on_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = tx.detect(docs, labels).filter("held_out").join(labels, "doc_id").toPandas()
    assert (got["predicted"] == got["toxic"]).mean() > 0.9


def test_odd_rows(spark):
    docs, labels = corpus(150)
    rows = [*docs, (900, None), (901, ""), (None, docs[0][1]), (902, "idiot " * 5000), (903, docs[0][1]), (903, docs[0][1])]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = tx.detect(frame(spark, rows), table)
    assert got.count() == len(rows)
    by_id = {r.doc_id: r.predicted for r in got.collect()}
    assert by_id[900] == by_id[901] == 0 and by_id[902] == 1
    left = tx.drop_toxic(frame(spark, rows, clash=True), tx.learn(frame(spark, docs), table))
    assert left.columns == frame(spark, rows, clash=True).columns and 902 not in {r.doc_id for r in left.collect()}


@pytest.mark.parametrize("kinds", [[], [0], [1]])
def test_nothing_to_learn(spark, kinds):
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(kinds * 3)], "doc_id long, toxic int")
    got = tx.detect(frame(spark, [(i, "some text") for i in range(5)]), labels).collect()
    assert {r.predicted for r in got} == {0}
    assert tx.detect(frame(spark, []), labels).count() == 0


def test_labels_and_ids_are_no_inputs(spark):
    docs, labels = corpus(100)
    model = tx.learn(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int"))
    one = tx.score_documents(frame(spark, docs), model).collect()
    two = tx.score_documents(frame(spark, docs).withColumns({"doc_id": F.lit(1), "lang": F.lit("xx"), "source": F.lit("s")}), model).collect()
    assert sorted(r.score for r in one) == sorted(r.score for r in two)


def test_words_count_as_often_as_they_occur(spark):
    rng = random.Random(8)
    stems = [words(rng, 1) for _ in range(30)]
    docs, labels = [], []
    for i in range(500):
        text = words(rng, rng.randrange(40, 60)).split()
        for _ in range(5 if i % 5 == 0 else i % 2):  # every other clean text has one such word as well
            text.insert(rng.randrange(len(text)), "qrstuvw" + rng.choice(stems))
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    got = tx.detect(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")).filter("held_out").collect()
    hit = sum(r.predicted and r.doc_id % 5 == 0 for r in got)
    assert hit / sum(r.doc_id % 5 == 0 for r in got) > 0.9 and hit / max(1, sum(r.predicted for r in got)) > 0.9


def test_what_is_broadcast_needs_no_package(spark, monkeypatch):
    """Executors unpickle a broadcast by name, so it holds plain values only."""
    sent, kind = [], type(spark.sparkContext)
    real = kind.broadcast
    monkeypatch.setattr(kind, "broadcast", lambda self, value: (sent.append(value), real(self, value))[1])
    tx.scorer_of(spark, tx.ToxicityModel(["\x02idiot\x03"], np.ones(1), -1.0, 1.0, 0.0))
    assert len(sent) == 1 and b"stintlog" not in pickle.dumps(sent)


def test_the_driver_gets_no_words_of_the_sample(spark, monkeypatch):
    rows, labels = corpus()
    docs, table, got = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), []
    for name in ("collect", "toArrow", "toPandas"):
        real = getattr(type(docs), name)
        monkeypatch.setattr(type(docs), name, lambda self, real=real: (got.append({*self.columns}), real(self))[1])
    assert tx.learn(docs, table).landmarks
    assert got and not [columns for columns in got if {"unit", "text"} & columns]
