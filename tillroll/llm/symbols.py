"""Texts as sequences of 128 symbols, and counts of symbol triples.

A fixed, small alphabet bounds every table over triples by 128 ** 3 entries, whatever the corpus.
"""

from __future__ import annotations

import numpy as np

N_SYMBOLS = 128
N_TRIPLES = N_SYMBOLS**3


def code_points(texts: list[bytes], gap: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with ``gap`` before each and after the last; start and end of each."""
    decoded = [text.decode() for text in texts]
    joined = gap + "".join(text + gap for text in decoded)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
    sizes = np.fromiter(map(len, decoded), dtype=np.int64, count=len(decoded))
    ends = np.cumsum(sizes + len(gap))
    return points, ends - sizes, ends


def triples(symbols: np.ndarray) -> np.ndarray:
    """For every place from the third on, the number of the triple that ends there."""
    wide = symbols.astype(np.int32)
    return (wide[:-2] * N_SYMBOLS + wide[1:-1]) * N_SYMBOLS + wide[2:]


def log_probabilities(counts: np.ndarray, strength: float) -> np.ndarray:
    """Natural logarithms of p(third | first two) for all triples, given counts of triples.

    Longer contexts are backed by shorter ones: each level adds ``strength`` pseudo-counts spread as
    the level below says, the lowest being uniform. Every context's probabilities sum to one.
    """
    n3 = np.asarray(counts, dtype=np.float64).reshape(N_SYMBOLS, N_SYMBOLS, N_SYMBOLS)
    n2 = n3.sum(axis=0)
    n1 = n2.sum(axis=0)
    p1 = (n1 + strength / N_SYMBOLS) / (n1.sum() + strength)
    p2 = (n2 + strength * p1) / (n2.sum(axis=1, keepdims=True) + strength)
    p3 = (n3 + strength * p2[None]) / (n3.sum(axis=2, keepdims=True) + strength)
    return np.log(p3).reshape(-1)
