"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

Each block is main text or not. Features are the tags and names around it and the shape of its
text; the field adds how likely either kind follows the other. It is trained on labelled pages and
decoded by the Viterbi algorithm.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlog.llm.common import per_worker
from stintlog.llm.dom_blocks import Block, leaf_blocks
from stintlog.llm.labelled_pages import labelled_page

PAGES, EPOCHS, SEED = 600, 6, 7
RATE, PENALTY = 0.3, 1e-4

_LEGAL = re.compile(r"©|copyright|all rights reserved", re.I)


def features(blocks: list[Block]) -> list[list[str]]:
    """The names of the features that hold for each block."""
    out = []
    for i, b in enumerate(blocks):
        n = len(b.text)
        share = b.linked / n
        last = b.text[-1]
        found = [
            "one",
            f"in {b.tag}" if b.tag else "in nothing",
            f"length {min(9, n.bit_length())}",
            f"links {'all' if share > 0.9 else 'many' if share > 0.4 else 'some' if share > 0 else 'none'}",
            f"ends {'stop' if last in '.!?' else 'colon' if last in ':;' else 'word' if last.isalnum() else 'mark'}",
        ]
        found += [f"tag {t}" for t in sorted(b.tags)]
        found += [f"name {w}" for w in sorted(b.names)]
        if not b.names:
            found.append("no name")
        if not {"article", "main"} & b.tags:
            found.append("no holder")
        if _LEGAL.search(b.text):
            found.append("legal")
        if i == 0:
            found.append("first")
        if i == len(blocks) - 1:
            found.append("last")
        out.append(found)
    return out


class Field:
    """Weights of features and of transitions; label 1 is main text."""

    def __init__(self, weights: dict[str, float], moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def potentials(self, blocks: list[Block]) -> list[float]:
        weights = self.weights
        return [sum([weights.get(f, 0.0) for f in found]) for found in features(blocks)]

    def decode(self, blocks: list[Block]) -> list[int]:
        """The likeliest labels of a page's blocks together (Viterbi)."""
        if not blocks:
            return []
        (m00, m01), (m10, m11) = self.moves.tolist()
        zero, one = 0.0, 0.0
        back: list[tuple[int, int]] = []
        for k, p in enumerate(self.potentials(blocks)):
            if k:
                from0, from1 = zero + m00 >= one + m10, zero + m01 > one + m11
                back.append((0 if from0 else 1, 0 if from1 else 1))
                zero, one = max(zero + m00, one + m10), max(zero + m01, one + m11)
            one += p
        label = int(one > zero)
        out = [label]
        for choice in reversed(back):
            label = choice[label]
            out.append(label)
        return out[::-1]

    def text(self, page: str) -> str:
        """The main text of a whole page, blocks joined by line ends; empty if there is none."""
        blocks = leaf_blocks(page)
        return "\n".join([b.text for b, y in zip(blocks, self.decode(blocks)) if y])


def _marginals(potential: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(label = 1) of each block, and the expected number of each transition."""
    n = len(potential)
    score = np.zeros((n, 2))
    score[:, 1] = potential
    ahead, behind = np.empty((n, 2)), np.zeros((n, 2))
    ahead[0] = score[0]
    for k in range(1, n):
        ahead[k] = score[k] + np.logaddexp(ahead[k - 1, 0] + moves[0], ahead[k - 1, 1] + moves[1])
    for k in range(n - 2, -1, -1):
        after = score[k + 1] + behind[k + 1]
        behind[k] = np.logaddexp(moves[:, 0] + after[0], moves[:, 1] + after[1])
    total = np.logaddexp(ahead[-1, 0], ahead[-1, 1])
    pairs = np.zeros((2, 2))
    if n > 1:
        joint = ahead[:-1, :, None] + moves[None] + (score + behind)[1:, None, :] - total
        pairs = np.exp(joint).sum(axis=0)
    return np.exp(ahead[:, 1] + behind[:, 1] - total), pairs


def fit(pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, seed: int = SEED) -> Field:
    """Weights that raise the likelihood of the labels, by stochastic gradients with adapted rates."""
    index = {f: i for i, f in enumerate(sorted({f for found, _ in pages for fs in found for f in fs}))}
    rng = np.random.Generator(np.random.PCG64(seed))
    w, w_sum = np.zeros(len(index)), np.full(len(index), 1e-6)
    moves, m_sum = np.zeros((2, 2)), np.full((2, 2), 1e-6)
    coded = [([np.array([index[f] for f in fs]) for fs in found], np.array(y)) for found, y in pages if y]
    for _ in range(epochs):
        for i in rng.permutation(len(coded)):
            found, y = coded[i]
            p, pairs = _marginals(np.array([w[fs].sum() for fs in found]), moves)
            grad = np.zeros_like(w)
            for fs, g in zip(found, y - p):
                grad[fs] += g
            grad -= PENALTY * w
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[:-1], y[1:]), 1)
            w_sum += grad**2
            w += RATE * grad / np.sqrt(w_sum)
            m_sum += (seen - pairs) ** 2
            moves += RATE * (seen - pairs) / np.sqrt(m_sum)
    return Field(dict(zip(index, w.tolist())), moves)


def trained(pages: int = PAGES, seed: int = SEED) -> Field:
    """A field fitted on labelled pages of many layouts; always the same for the same arguments."""
    rng = np.random.Generator(np.random.PCG64(seed))
    made = [labelled_page(rng) for _ in range(pages)]
    return fit([(features(leaf_blocks(page)), labels) for page, labels in made])


def main_text(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``.

    A null or empty page, or one without main text, has an empty text. Null ids and urls and
    repeated rows pass through; an empty table gives no rows. Pages are read where they lie.
    """
    sent = pages.sparkSession.sparkContext.broadcast((field.weights, field.moves))
    key = ("field", hashlib.md5(repr((sorted(field.weights.items()), field.moves.tolist())).encode()).hexdigest())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = per_worker(key, lambda: Field(*sent.value))
        for frame in frames:
            texts = [made.text(page) for page in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"),
        pages[url_col].cast("string").alias("url"),
        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"),
    )
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
