"""Positions on Hilbert curves, for arrays of points at once."""

from __future__ import annotations

import numpy as np


def hilbert_positions(points: np.ndarray, bits: int) -> np.ndarray:
    """The position of each point on the Hilbert curve through a grid of 2 ** bits cells a side.

    ``points`` has one row of non-negative integers under 2 ** bits for each point;
    columns * bits must be 63 at most. Neighbouring positions are neighbouring cells.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    if dims * bits > 63:
        raise ValueError("a position must fit into 63 bits")
    # Undo the rotations and reflections of each level, from the coarsest on.
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    # What is left is a Gray code over the bits of all columns.
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[dims - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << 1 | (x[i] >> level) & 1
    return out
