"""Places on a Hilbert curve through a grid of any number of dimensions (NumPy).

The transform works on the transposed form of the place: one word per dimension,
whose bit planes, read from the highest down, are the place's digits.
"""

from __future__ import annotations

import numpy as np


def curve_bits(dims: int) -> int:
    """Bits a dimension for keys of some 256 bits."""
    return min(max(256 // max(dims, 1), 2), 16)


def curve_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """(n, bytes) uint8: the place of each cell (n, dims) of the grid with
    ``2**bits`` cells a side, highest digit first, so that byte order is curve order."""
    n, dims = cells.shape
    if not n or not dims:
        return np.zeros((n, 0), np.uint8)
    x = np.ascontiguousarray(cells.T).astype(np.uint32)
    for bit in range(bits - 1, 0, -1):
        q, low = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for i in range(dims):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.uint32)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint32(1 << bit), np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turn
    planes = [(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).astype(np.uint8).T, axis=1)
