"""Keys along the Hilbert curve for points of any number of dimensions."""

from __future__ import annotations

import numpy as np


def keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``points`` (n x d integers below 2**bits) on the curve; d * bits is at most 63.

    Skilling's transform: undo the turns of the sub-cubes from the coarsest bit down, Gray-code
    the axes, and read the bits of all axes across.
    """
    x = np.array(points, np.int64).T.copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(d):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(turned, p, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t ^= np.where((x[d - 1] >> b) & 1, (1 << b) - 1, 0)
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | ((axis >> b) & 1)
    return key
