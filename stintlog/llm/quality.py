"""Quality: boosted trees over statistics of a document's whole text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlog.llm.boosting import Forest, fit
from stintlog.llm.common import documents

# Labelled documents of each label that the trees are fitted on, the first in an order by hash.
SAMPLE = 6_000
KEEP = 0.7  # the least score of a document that is predicted to be good

# Kinds of characters.
LOWER, UPPER, OTHER_LETTER, DIGIT, SPACE, STOP, COMMA, QUOTE, SYMBOL, CONTROL = range(10)
_CHARACTERS = 0x3000  # beyond it: other letters

STATISTICS = [
    "log characters", "log words", "log lines", "lower", "upper", "other letters", "digits", "white space", "stops",
    "commas", "quotes", "symbols", "controls", "characters in a word", "spread of word length", "different words",
    "commonest word", "words like the one before", "words in capitals", "words with a mark at the end",
    "words of marks only", "words with a digit", "words over 20 characters", "words in a sentence", "different lines",
    "words in a line", "commonest character", "different pairs of words", "entropy of characters",
]


def _kinds() -> np.ndarray:
    out = np.empty(_CHARACTERS + 1, dtype=np.int64)
    for code in range(_CHARACTERS):
        c = chr(code)
        if c.isspace():
            kind = SPACE
        elif c.islower():
            kind = LOWER
        elif c.isupper():
            kind = UPPER
        elif c.isalpha():
            kind = OTHER_LETTER
        elif c.isdigit():
            kind = DIGIT
        elif c in ".!?…":
            kind = STOP
        elif c in ",;:":
            kind = COMMA
        elif c in "\"'()-‐‑–—‘’“”«»":
            kind = QUOTE
        elif code < 32 or 127 <= code < 160:
            kind = CONTROL
        else:
            kind = SYMBOL
        out[code] = kind
    out[_CHARACTERS] = OTHER_LETTER
    return out


KINDS = _kinds()
_KINDS_OF_MARK = np.isin(np.arange(10), [STOP, COMMA, QUOTE, SYMBOL, CONTROL])


def statistics(text: str) -> list[float]:
    """The values of ``STATISTICS`` for a whole text; all 0 for an empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"), _CHARACTERS)
    n = len(codes)
    kinds = KINDS[codes]
    by_kind = np.bincount(kinds, minlength=10) / n
    by_code = np.bincount(codes)
    by_code = by_code[by_code > 0] / n
    entropy = float(-(by_code * np.log(by_code)).sum())

    # Words are runs without white space, as places in the codes.
    space = kinds == SPACE
    edge = np.flatnonzero(np.diff(np.r_[True, space, True]))
    start, end = edge[::2], edge[1::2]
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    length = end - start
    counts = Counter(words)
    before = Counter(zip(words, words[1:]))
    same = sum(c for (a, b), c in before.items() if a == b)

    def in_words(kind: np.ndarray) -> np.ndarray:
        held = np.r_[0, np.cumsum(kind)]
        return held[end] - held[start]

    if len(start):
        last = kinds[end - 1]
        marks = in_words(_KINDS_OF_MARK[kinds])
        capitals = ((in_words(kinds == UPPER) >= 2) & (in_words(kinds == LOWER) == 0)).sum()
        odd_end = ((last == SYMBOL) | ((last == STOP) & (length > 1) & (kinds[np.maximum(end - 2, 0)] == STOP))).sum()
        by_word = [
            length.mean(), length.std(), len(counts) / n_words, max(counts.values(), default=0) / n_words, same / n_words,
            capitals / n_words, odd_end / n_words, (marks == length).sum() / n_words,
            (in_words(kinds == DIGIT) > 0).sum() / n_words, (length > 20).sum() / n_words,
            n_words / max(1, (last == STOP).sum()),
        ]
    else:
        by_word = [0.0] * 11
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), *by_kind.tolist(), *map(float, by_word),
        len(set(lines)) / n_lines, len(words) / n_lines, float(by_code.max()), len(before) / n_words, entropy,
    ]


def _scored(docs: DataFrame, of_rows, value: str) -> DataFrame:
    """doc_id and what ``of_rows`` makes of a matrix of statistics, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            x = np.array([statistics(t) for t in texts.to_pylist()]).reshape(len(ids), len(STATISTICS))
            yield pa.RecordBatch.from_arrays([ids, of_rows(x)], ["doc_id", "value"])

    return docs.mapInArrow(run, f"doc_id long, value {value}")


def fold(doc_id, folds: int):
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def learn(docs: DataFrame, labels: DataFrame, held_out: int = 2, folds: int = 4, sample: int = SAMPLE) -> Forest:
    """Trees fitted on at most ``sample`` documents of each label outside the held-out fold.

    Labels without id or value are left out, a document labelled both ways counts as bad. Of several
    documents of one id one is taken. The sample's statistics come to the driver, no texts. Each
    label weighs what it has in the whole table, also where only part of it is in the sample.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("id"), labels["quality"].cast("int").alias("quality"))
    known = known.filter(F.col("id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("id"), folds) != held_out))
    known = known.groupBy("id").agg(F.min("quality").alias("quality"))
    by_hash = [F.xxhash64("id"), F.col("id")]
    chosen = known.filter("quality = 1").orderBy(*by_hash).limit(sample)
    chosen = chosen.union(known.filter("quality = 0").orderBy(*by_hash).limit(sample))
    texts = documents(docs)
    # At most twice the sample's rows are broadcast.
    texts = texts.join(F.broadcast(chosen.select("id")), F.col("doc_id") == F.col("id"), "left_semi")
    values = _scored(texts, lambda x: pa.array(list(x), pa.list_(pa.float64())), "array<double>")
    rows = values.groupBy("doc_id").agg(F.min("value").alias("value")).join(chosen, F.col("doc_id") == F.col("id"))
    found = rows.select("doc_id", "quality", "value").toArrow().sort_by("doc_id")
    y = found["quality"].to_numpy().astype(float)
    x = found["value"].combine_chunks().flatten().to_numpy().reshape(len(y), len(STATISTICS))
    forest = fit(x, y)
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    used = {1: y.sum(), 0: len(y) - y.sum()}
    if all(counts.get(k) and used[k] for k in (0, 1)):
        # Documents of the two labels may be sampled unevenly: back to the table's odds.
        forest.base += float(np.log(counts[1] / counts[0]) - np.log(used[1] / used[0]))
    return forest


def score_documents(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row of ``docs``, from the whole text alone.

    A null or empty text has statistics of 0 and is scored like others. Null and repeated ids pass
    through; an empty table gives no rows; other columns are not read.
    """
    parts = dict(vars(forest))
    scored = _scored(documents(docs, id_col, text_col), lambda x: pa.array(Forest(**parts).probabilities(x)), "double")
    return scored.select("doc_id", F.col("value").alias("score"), (F.col("value") >= KEEP).cast("int").alias("predicted"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; learned from rows not held out.

    Without labels of both kinds every document has the same score.
    """
    scored = score_documents(docs, learn(docs, labels))
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
