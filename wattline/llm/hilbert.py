"""Hilbert keys of points on a grid, for whole batches at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Position of each grid point on the Hilbert curve.

    ``grid`` is (rows, dims) of unsigned integers below ``2 ** bits``; ``dims * bits`` is at most 63,
    so that the key is a non-negative long. The transposed form is built as in J. Skilling,
    "Programming the Hilbert curve" (2004), then its bits are interleaved.
    """
    rows, dims = grid.shape
    if dims * bits > 63:
        raise ValueError("a Hilbert key holds 63 bits")
    x = [grid[:, i].astype(np.int64) for i in range(dims)]
    for level in range(bits - 1, 0, -1):
        bit, below = np.int64(1 << level), np.int64((1 << level) - 1)
        for i in range(dims):
            inverts = (x[i] & bit) != 0
            swap = np.where(inverts, 0, (x[0] ^ x[i]) & below)
            x[0] = np.where(inverts, x[0] ^ below, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(rows, np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros(rows, np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | (((x[i] ^ turn) >> level) & 1)
    return key
