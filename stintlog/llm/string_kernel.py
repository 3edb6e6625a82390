"""The gap-weighted subsequence kernel, and linear scores of its feature space."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

ORDER = 4  # letters of a subsequence
DECAY = 0.7  # weight of each letter that a subsequence spans, so gaps are tolerated at a price
WINDOW = 20  # characters of a unit that are compared at once; longer units give several windows

START, END = "\x02", "\x03"
_REST = np.uint64(44)
_rng = np.random.Generator(np.random.PCG64(1))
_PLACES = _rng.integers(1 << 63, size=ORDER, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def windows(unit: str) -> list[str]:
    """A unit between marks of its start and end, in overlapping windows if it is long."""
    marked = START + unit + END
    if len(marked) <= WINDOW:
        return [marked]
    return [marked[i : i + WINDOW] for i in range(0, len(marked) - WINDOW // 2, WINDOW // 2)]


def codes(texts: list[str]) -> np.ndarray:
    """Code points, one row for each text, 0 behind its end."""
    wide = max(map(len, texts), default=1)
    return np.array([[*map(ord, t), *[0] * (wide - len(t))] for t in texts], dtype=np.uint32).reshape(len(texts), wide)


def _decays(n: int) -> np.ndarray:
    apart = np.arange(n)[:, None] - np.arange(n)
    return np.where(apart >= 0, DECAY ** np.maximum(apart, 0), 0.0)


def raw_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The kernel of each row of ``s`` with the same row of ``t``, not normalised."""
    match = ((s[:, :, None] == t[:, None, :]) & (s[:, :, None] != 0)) * DECAY**2
    ahead, behind = _decays(s.shape[1]), _decays(t.shape[1]).T
    ends = match
    for _ in range(ORDER - 1):
        # What ends anywhere before both letters, decayed up to them.
        sums = ahead @ ends @ behind
        ends = np.zeros_like(match)
        ends[:, 1:, 1:] = match[:, 1:, 1:] * sums[:, :-1, :-1]
    return ends.sum(axis=(1, 2))


def norms(s: np.ndarray) -> np.ndarray:
    """The root of the kernel of each row with itself; 1 for those without a subsequence."""
    out = np.concatenate([raw_kernel(s[i : i + 2048], s[i : i + 2048]) for i in range(0, len(s), 2048)] or [np.empty(0)])
    return np.where(out > 0, np.sqrt(out), 1.0)


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The normalised kernel of every row of ``s`` with every row of ``t``."""
    out = np.empty((len(s), len(t)))
    lengths, of_t = (s != 0).sum(axis=1), norms(t)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        cut = s[rows, : max(length, 1)]
        of_s = norms(cut)
        for j, row in enumerate(t):
            row = row[: max(1, int((row != 0).sum()))]
            out[rows, j] = raw_kernel(cut, np.broadcast_to(row, (len(rows), len(row)))) / of_s / of_t[j]
    return out


@cache
def _choices(n: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """How choices of i + 1 of ``n`` places follow from those of i: which of these, and the further
    place; and the decay of each choice of ``ORDER`` places."""
    steps, before = [], [(i,) for i in range(n)]
    for size in range(2, ORDER + 1):
        now = [*combinations(range(n), size)]
        number = {c: i for i, c in enumerate(before)}
        steps.append(
            (np.array([number[c[:-1]] for c in now], dtype=np.int64), np.array([c[-1] for c in now], dtype=np.int64))
        )
        before = now
    return steps, np.array([DECAY ** (c[-1] - c[0] + 1.0) for c in before])


class LinearScore:
    """sum of beta * normalised kernel with each landmark, as weights of subsequences.

    The kernel is the inner product over all subsequences of ``ORDER`` letters, each weighted by
    ``DECAY`` to the letters it spans. Summing the landmarks there first gives the same score for
    the cost of one.
    """

    def __init__(self, landmarks: list[str], beta: np.ndarray, bias: float):
        self.bias = bias
        weights: dict[int, float] = {}
        marked = codes(landmarks)
        for row, share in zip(marked, beta / norms(marked)):
            keys, decay = self._subsequences(row[None, : int((row != 0).sum())])
            for key, d in zip(keys[0].tolist(), decay.tolist()):
                weights[key] = weights.get(key, 0.0) + share * d
        self._table(weights)

    def _table(self, weights: dict[int, float]) -> None:
        """Weights by the first bits of a subsequence's key. The few keys whose first bits another has
        already taken are kept sorted beside the table."""
        keys = np.array(sorted(weights) or [0], dtype=np.uint64)
        values = np.array([weights.get(k, 0.0) for k in keys.tolist()])
        slots = keys >> _REST
        first = np.r_[True, slots[1:] != slots[:-1]]
        self.slot_key, self.slot_weight = np.zeros(1 << 20, dtype=np.uint64), np.zeros(1 << 20)
        self.slot_key[slots[first]], self.slot_weight[slots[first]] = keys[first], values[first]
        # Most subsequences of a text are in no landmark: their first bits already tell.
        self.taken, self.shared = np.zeros(1 << 20, dtype=bool), np.zeros(1 << 20, dtype=bool)
        self.taken[slots], self.shared[slots[~first]] = True, True
        self.more_keys, self.more_weights = keys[~first], values[~first]

    def _weights(self, keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        out = np.where(self.slot_key[slots] == keys, self.slot_weight[slots], 0.0)
        if len(self.more_keys):
            also = np.flatnonzero(self.shared[slots])
            place = np.minimum(np.searchsorted(self.more_keys, keys[also]), len(self.more_keys) - 1)
            out[also] += np.where(self.more_keys[place] == keys[also], self.more_weights[place], 0.0)
        return out

    @staticmethod
    def _subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A key for every subsequence of each row, and its decay: a column for each choice of places."""
        steps, decay = _choices(rows.shape[1])
        wide = rows.astype(np.uint64)
        keys = wide * _PLACES[0]
        for i, (shorter, last) in enumerate(steps, start=1):
            # A subsequence is a shorter one with a further letter.
            keys = keys[:, shorter] + (wide * _PLACES[i])[:, last]
        return keys, decay

    def __call__(self, units: list[str]) -> np.ndarray:
        """The score of each unit, the largest of its windows."""
        parts = [windows(u) for u in units]
        scores = self.of_windows([w for part in parts for w in part])
        first = np.cumsum([0, *map(len, parts)])[:-1]
        return np.maximum.reduceat(scores, first) if units else scores

    def of_windows(self, marked: list[str]) -> np.ndarray:
        """The score of each window as it stands; those without a subsequence have the bias."""
        out = np.full(len(marked), self.bias)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(marked):
            by_length.setdefault(len(w), []).append(i)
        for length, same in by_length.items():
            if length < ORDER:
                continue
            step = max(1, 400_000 // length**3)
            for k in range(0, len(same), step):
                part = same[k : k + step]
                rows = codes([marked[i] for i in part])
                keys, decay = self._subsequences(rows)
                slots = keys >> _REST
                row, at = np.nonzero(self.taken[slots])
                hit = self._weights(keys[row, at], slots[row, at])
                # A subsequence spans its letters in the unit as in the landmark.
                total = np.bincount(row, weights=hit * decay[at], minlength=len(rows))
                out[part] += total / norms(rows)
        return out
