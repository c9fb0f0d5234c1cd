"""Positions on a Hilbert curve, for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the curve of integer cells (rows of coordinates below 2^bits); dimensions x bits at most 62.

    Works from the highest bit down: the coordinates are reflected and exchanged as the sub-cube that holds the
    point requires, and the Gray code of the remaining bits is undone at the end.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            here = (x[d] >> bit) & 1 == 1
            swap = np.where(here, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(here, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flips = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flips
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            out = out << 1 | ((x[d] >> bit) & 1)
    return out
