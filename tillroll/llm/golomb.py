"""Golomb-Rice codes of sorted 64-bit values: unary quotients and fixed-width remainders of the gaps."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QBQ")


def encode(values: np.ndarray) -> bytes:
    """Code a sorted array of distinct uint64 values; about 2 bits each above log2 of the mean gap."""
    n = len(values)
    if not n:
        return _HEAD.pack(0, 0, 0)
    first, gaps = int(values[0]), np.diff(values)
    mean = float(gaps.astype(np.float64).mean()) if n > 1 else 1.0
    width = max(0, int(np.log2(max(mean, 1.0))))
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n - 1, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    shifts = np.arange(width, dtype=np.uint64)
    bits = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return (
        _HEAD.pack(n, width, first)
        + len(unary).to_bytes(8, "little")
        + np.packbits(unary).tobytes()
        + np.packbits(bits.ravel()).tobytes()
    )


def decode(blob: bytes) -> np.ndarray:
    n, width, first = _HEAD.unpack_from(blob)
    if not n:
        return np.empty(0, dtype=np.uint64)
    at = _HEAD.size
    n_unary = int.from_bytes(blob[at : at + 8], "little")
    at += 8
    size = (n_unary + 7) // 8
    raw = np.frombuffer(blob, dtype=np.uint8)
    ends = np.flatnonzero(np.unpackbits(raw[at : at + size], count=n_unary))
    quotients = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(raw[at + size :], count=(n - 1) * width).reshape(n - 1, width)
    weights = np.uint64(1) << np.arange(width, dtype=np.uint64)
    gaps = (quotients.astype(np.uint64) << np.uint64(width)) + bits.astype(np.uint64) @ weights
    return np.concatenate([[np.uint64(first)], np.uint64(first) + np.cumsum(gaps, dtype=np.uint64)])
