"""Golomb coding (divisors that are powers of two) of sorted distinct integers."""

from __future__ import annotations

import struct

import numpy as np


def encode(values: np.ndarray, low: int) -> bytes:
    """Sorted distinct integers, none below ``low``: the gaps' quotients in unary, then their rests in k bits."""
    n = len(values)
    if not n:
        return struct.pack("<IB", 0, 0)
    gaps = np.diff(values.astype(np.int64), prepend=low - 1) - 1
    k = max(0, int(gaps.mean() * 0.69 + 1).bit_length() - 1)
    quotients = gaps >> k
    unary = np.zeros(int(quotients.sum()) + n, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1  # a one ends each quotient
    rests = ((gaps[:, None] >> np.arange(k - 1, -1, -1)) & 1).astype(np.uint8)
    return struct.pack("<IB", n, k) + np.packbits(np.concatenate([unary, rests.ravel()])).tobytes()


def decode(data: bytes, low: int) -> np.ndarray:
    n, k = struct.unpack_from("<IB", data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8, offset=5))
    ends = np.flatnonzero(bits)[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    rests = bits[ends[-1] + 1 : ends[-1] + 1 + n * k].reshape(n, k).astype(np.int64)
    gaps = (quotients << k) + (rests << np.arange(k - 1, -1, -1)).sum(axis=1)
    return np.cumsum(gaps + 1) + low - 1
