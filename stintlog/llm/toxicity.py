"""Toxicity: a support vector machine over a subsequence string kernel with Nystroem landmarks.

The kernel's strings are single words without marks inside, and runs of at least four single
letters with one space between them; they stand in for the sentences that the method is meant
for. Gaps or inserted letters in a word cost little; insults across a space, or of several
ordinary words, do not match. The machine is trained on words of a bounded sample of labelled
documents; which words of a toxic document are meant is found by turns with the fit.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlog.llm.common import documents, per_worker
from stintlog.llm.string_kernel import END, START, LinearScore, codes, kernel, windows

# Labelled documents that the machine is fitted on, the first in an order by hash.
TOXIC_SAMPLE, CLEAN_SAMPLE = 800, 1_600
LANDMARKS, CLEAN_LANDMARKS = 48, 16
GRAM = 5
GRAMS = 4_000  # grams that landmarks are chosen by, those with the best evidence
EVIDENCE = 6.0  # of a gram that a landmark stands for: toxic documents times log of the odds
RATIO = 4.0  # how much oftener a word must be in toxic documents to be what is meant
ROUNDS = 3
NEGATIVES = 2_000  # units of clean documents in a fit: at first any, then those scored highest
PENALTY = 10.0
OFFSET = -1.0
BENT = 2  # copies of each insult with an inserted letter that a fit sees

# Bytes of words, with what Python adds to each, whose score a Python worker remembers; a full memory
# is emptied. Longer words are not remembered.
REMEMBERED, EACH, LONGEST = 128 << 20, 150, 256

_MARKS = re.compile(r"[\W_]+")
# Added to a text's mean before the logarithm: a text without insults is far from one with few.
LEAST_MEAN = 1e-3
_SPELLED = re.compile(r"(?<!\S)\w(?:\s\w){3,}(?!\S)")


def words_of(text: str) -> list[str]:
    """The words of a whole text with their repeats, and runs of single letters joined, in lower case."""
    low = text.lower()
    return [*low.split(), *(re.sub(r"\s", "", run) for run in _SPELLED.findall(low))]


def unit_of(word: str) -> str:
    return _MARKS.sub("", word)


@dataclass
class ToxicityModel:
    """What workers need to score: landmarks, their weights, and the calibration of a margin."""

    landmarks: list[str]
    beta: np.ndarray
    bias: float
    slope: float
    shift: float

    def key(self) -> str:
        parts = (self.landmarks, self.beta.tolist(), self.bias, self.slope, self.shift)
        return hashlib.md5(repr(parts).encode()).hexdigest()

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


class Scorer:
    """Margins of texts; each word is scored once as long as it is remembered.

    What a word adds is its margin where that is above 0. A sentence has the sum over its words, a
    text the sum over its sentences for each word it has: how often, not only whether, it insults.
    """

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.score = LinearScore(model.landmarks, model.beta, model.bias)
        self._seen: dict[str, float] = {}
        self._held = 0

    def margins(self, texts: list[str]) -> np.ndarray:
        """The logarithm of what a word of each text adds in the mean; lowest for a text without words."""
        words = [words_of(t) for t in texts]
        seen = self._seen
        if self._held > REMEMBERED:
            seen.clear()
            self._held = 0
        new: set[str] = set()
        for ws in words:
            new |= set(ws).difference(seen)
        units: dict[str, list[str]] = defaultdict(list)
        for w in new:
            unit = w if w.isalnum() else unit_of(w)
            known = seen.get(unit)
            if known is None:
                units[unit].append(w)
            else:  # with other marks it was scored before
                seen[w] = known
        for unit, score in zip(units, np.maximum(self.score(list(units)), 0).tolist()):
            seen.update(dict.fromkeys([unit, *units[unit]], score))
        new.update(units)
        self._held += sum(map(len, new)) + EACH * len(new)
        mean = [sum(map(seen.__getitem__, ws)) / max(1, len(ws)) for ws in words]
        for w in [w for w in new if len(w) > LONGEST]:
            del seen[w]
            self._held -= len(w) + EACH
        return np.log(np.array(mean, dtype=np.float64) + LEAST_MEAN)


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton steps; y is 1 or -1.

    The offset is fixed: a word that shares nothing with any landmark lies on the clean margin.
    """
    w = np.zeros(x.shape[1])
    cost = PENALTY * weight

    def loss(v: np.ndarray) -> float:
        return 0.5 * v @ v + 0.5 * (cost * np.maximum(0, 1 - y * (x @ v + OFFSET)) ** 2).sum()

    for _ in range(50):
        active = y * (x @ w + OFFSET) < 1
        a, c = x[active], cost[active]
        step = np.linalg.solve(np.eye(len(w)) + (a * c[:, None]).T @ a, (a * c[:, None]).T @ (y[active] - OFFSET)) - w
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def _grams(marked: str) -> set[str]:
    return {marked[i : i + GRAM] for i in range(max(1, len(marked) - GRAM + 1))}


def _calibrated(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins, with softened targets."""
    n_pos, n_neg = (y > 0).sum(), (y <= 0).sum()
    goal = np.where(y > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    design, w = np.c_[margin, np.ones(len(margin))], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (goal - p) - 1e-3 * w)
        w = w + step / max(1.0, np.abs(step).max() / 5)
    return float(max(w[0], 1e-3)), float(w[1])


def train(units_of: dict[int, set[str]], toxic: dict[int, int]) -> ToxicityModel:
    """A model from the units of each labelled document, not calibrated yet.

    A long unit takes part with all its windows, as in scoring. Without documents of both kinds there
    is nothing to learn: every score is 0.
    """
    units_of = {d: {w for u in us for w in windows(u)} for d, us in units_of.items()}
    pos = sorted(d for d, y in toxic.items() if y and units_of.get(d))
    neg = sorted(d for d, y in toxic.items() if not y and units_of.get(d))
    if not pos or not neg:
        return ToxicityModel([], np.zeros(0), 0.0, 1.0, -30.0)
    rng = np.random.Generator(np.random.PCG64(1))
    n_toxic = Counter(u for d in pos for u in units_of[d])
    n_clean = Counter(u for d in neg for u in units_of[d])
    # Documents that have a gram, counted; the documents themselves only for the best grams.
    in_toxic: Counter = Counter()
    for d in pos:
        in_toxic.update({g for u in units_of[d] for g in _grams(u)})
    in_clean: Counter = Counter()
    for d in neg:
        in_clean.update({g for u in units_of[d] for g in _grams(u) if g in in_toxic})
    evidence = {}
    for g, n in in_toxic.items():
        value = n * np.log((n + 0.5) / len(pos) / ((in_clean[g] + 0.5) / len(neg)))
        if value > 0:
            evidence[g] = float(value)
    del in_clean
    ranked = sorted(evidence, key=lambda g: (-evidence[g], g))[:GRAMS]
    docs_with: dict[str, set[int]] = {g: set() for g in ranked}
    with_gram: dict[str, set[str]] = {g: set() for g in ranked}
    for d in pos:
        for u in units_of[d]:
            for g in _grams(u):
                if g in docs_with:
                    docs_with[g].add(d)
                    with_gram[g].add(u)

    # Landmarks: words with the best evidence, as long as they explain documents that few explain.
    covered: Counter = Counter()
    chosen: list[str] = []
    for g in ranked:
        gain = sum(covered[d] < 6 for d in docs_with[g])
        if evidence[g] >= EVIDENCE and gain >= max(2, 0.004 * len(pos)) or not chosen:
            best = max(with_gram[g], key=lambda u: (n_toxic[u] - len(neg) * n_clean[u], u))
            if best not in chosen:
                chosen.append(best)
                covered.update(docs_with[g])
        if len(chosen) == LANDMARKS:
            break
    clean_units = sorted(n_clean)
    chosen += [clean_units[i] for i in rng.permutation(len(clean_units))[:CLEAN_LANDMARKS]]
    landmarks = list(dict.fromkeys(chosen))
    marked = codes(landmarks)
    values, vectors = np.linalg.eigh(kernel(marked, marked))
    keep = values > 1e-6
    whiten = vectors[:, keep] / np.sqrt(values[keep])

    def features(units: list[str]) -> np.ndarray:
        return kernel(codes(units), marked) @ whiten

    def strength(u: str) -> float:
        return max(evidence.get(g, 0.0) for g in _grams(u))

    # A toxic document without any word that is rare in clean ones explains nothing.
    candidates = {d: sorted(u for u in units_of[d] if n_toxic[u] / len(pos) > RATIO * n_clean[u] / len(neg)) for d in pos}
    candidates = {d: us for d, us in candidates.items() if us}
    if not candidates:
        return ToxicityModel([], np.zeros(0), 0.0, 1.0, -30.0)
    meant = {d: max(us, key=lambda u: (strength(u), u)) for d, us in candidates.items()}
    hard = [u for u, _ in n_clean.most_common(NEGATIVES // 4)]
    hard = list(dict.fromkeys([*hard, *(clean_units[i] for i in rng.permutation(len(clean_units))[:NEGATIVES])]))
    score = None
    for turn in range(ROUNDS):
        count = Counter(meant.values())
        shown = sorted(count)
        # Each meant unit again with a letter inserted: what gaps and inserted letters look like.
        letters = sorted({c for u in shown for c in u} - {START, END}) or ["x"]
        bent = []
        for u in shown * BENT:
            i, c = int(rng.integers(2, max(3, len(u) - 1))), letters[int(rng.integers(len(letters)))]
            bent.append(u[:i] + c + u[i:])
        units = [*shown, *bent, *hard]
        y = np.r_[np.ones((1 + BENT) * len(shown)), -np.ones(len(hard))]
        each = np.array([count[u] for u in shown], dtype=float)
        often = np.sqrt([n_clean[u] for u in hard])
        weight = np.r_[each / each.sum(), np.tile(each / each.sum() / BENT, BENT), 2 * often / often.sum()] * len(hard) / 10
        w = fit_svm(features(units), y, weight)
        score = LinearScore(landmarks, whiten @ w, OFFSET)
        if turn < ROUNDS - 1:
            toxic_units = sorted({u for us in candidates.values() for u in us})
            of = dict(zip(toxic_units, score.of_windows(toxic_units).tolist()))
            meant = {d: max(us, key=lambda u: (of[u], u)) for d, us in candidates.items()}
            of_clean = score.of_windows(clean_units)
            hardest = np.argsort(-of_clean, kind="stable")[: NEGATIVES // 2]
            said = set(meant.values())
            hard = list(dict.fromkeys([*hard, *(clean_units[i] for i in hardest if clean_units[i] not in said)]))
    return ToxicityModel(landmarks, whiten @ w, OFFSET, 1.0, 0.0)


def learn(docs: DataFrame, labels: DataFrame, held_out: int = 0, folds: int = 5) -> ToxicityModel:
    """A model from labelled documents whose fold is not ``held_out``.

    The sample is bounded (``TOXIC_SAMPLE``, ``CLEAN_SAMPLE`` documents); its words go to one task,
    which fits. Labels without id or value are left out, a document labelled both ways counts as toxic.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("id"), labels["toxic"].cast("int").alias("toxic"))
    known = known.filter(F.col("id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("id"), folds) != held_out))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    by_hash = [F.xxhash64("id"), F.col("id")]
    sample = known.filter("toxic = 1").orderBy(*by_hash).limit(TOXIC_SAMPLE)
    sample = sample.union(known.filter("toxic = 0").orderBy(*by_hash).limit(CLEAN_SAMPLE))

    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(d, y, u) for d, y, t in zip(frame["doc_id"], frame["toxic"], frame["text"]) for u in {*map(unit_of, words_of(t))} if u]
            yield pd.DataFrame(rows, columns=["doc_id", "toxic", "unit"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: dict[int, int] = {}
        units_of: dict[int, set[str]] = defaultdict(set)
        same: dict[str, str] = {}  # each different word once, however many documents have it
        for batch in batches:
            for d, y, u in zip(*(batch[c].to_pylist() for c in ("doc_id", "toxic", "unit"))):
                toxic[d] = y
                units_of[d].add(same.setdefault(u, u))
        made = train(units_of, toxic)
        columns = [[made.landmarks], [made.beta.tolist()], [made.bias]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["landmarks", "beta", "bias"])

    kinds = [pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64()]
    chosen = documents(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("id"))
    rows = chosen.select("doc_id", "toxic", "text").mapInPandas(words, "doc_id long, toxic int, unit string")
    # One task fits, since the sample is bounded; the driver gets the landmarks and their weights only.
    made = rows.repartition(1).mapInArrow(fitted, "landmarks array<string>, beta array<double>, bias double").collect()
    if not made:  # no partition at all, as of an empty sample
        return train({}, {})
    model = ToxicityModel(made[0].landmarks, np.array(made[0].beta), made[0].bias, 1.0, 0.0)
    if not model.landmarks:
        return replace(model, shift=-30.0)
    # Calibrated on the margins of the whole texts, words counted as in scoring.
    margin = margins_of(docs.sparkSession, model)
    rows = chosen.select("toxic", margin(F.col("text")).alias("margin")).toPandas().sort_values(["toxic", "margin"])
    slope, shift = _calibrated(rows["margin"].to_numpy(), rows["toxic"].to_numpy(dtype=float))
    return replace(model, slope=slope, shift=shift)


def fold(doc_id, folds: int = 5):
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def margins_of(spark: SparkSession, model: ToxicityModel) -> Callable[[Column], Column]:
    """A function from a text column to its margin."""
    return _column_of(spark, model, lambda scorer, margin: margin)


def scorer_of(spark: SparkSession, model: ToxicityModel) -> Callable[[Column], Column]:
    """A function from a text column to its score, a double from 0 to 1."""
    return _column_of(spark, model, lambda scorer, margin: scorer.model.probability(margin))


def _column_of(spark: SparkSession, model: ToxicityModel, told: Callable[[Scorer, np.ndarray], np.ndarray]) -> Callable[[Column], Column]:
    # Plain values: a class would be looked up by name in workers that have no copy of this package.
    sent = spark.sparkContext.broadcast((model.landmarks, model.beta.tolist(), model.bias, model.slope, model.shift))
    key = ("toxicity", model.key())

    def scorer_of_worker() -> Scorer:
        landmarks, beta, *rest = sent.value
        return Scorer(ToxicityModel(landmarks, np.array(beta), *rest))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = per_worker(key, scorer_of_worker)
        for batch in texts:
            rows = batch.tolist()
            margin = [scorer.margins(rows[i : i + 400]) for i in range(0, len(rows), 400)]
            yield pd.Series(told(scorer, np.concatenate(margin or [np.empty(0)])))

    return score


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row of ``docs``, from the whole text alone.

    A null or empty text, or one without words, gets the score of a text without insults. Null and
    repeated ids pass through; an empty table gives no rows.
    """
    score = scorer_of(docs.sparkSession, model)
    scored = documents(docs, id_col, text_col).select("doc_id", score(F.col("text")).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score under a half, with all their columns."""
    score = scorer_of(docs.sparkSession, model)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.withColumn("__score", score(text)).filter(F.col("__score") < 0.5).select(*docs.columns)


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; learned from rows not held out."""
    scored = score_documents(docs, learn(docs, labels))
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
