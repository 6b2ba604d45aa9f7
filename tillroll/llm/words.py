"""Words of many texts at once, as numpy arrays: where they start and end, and 64-bit hashes.

White space is what ``[\\x20\\x09-\\x0D]`` matches, so that words are runs of other bytes of the
UTF-8 text. A block of texts is one buffer with a line feed between texts; no word crosses one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
SMALL_BLOCK = 512 << 10  # for operators with many temporary arrays
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
_LONG_WORD = 64
_PAD = 80
_TAIL_MASK = np.array([(1 << (8 * n)) - 1 if n < 8 else 2**64 - 1 for n in range(9)], dtype=np.uint64)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit over all others."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def text_blocks(
    batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of rows ``[start, stop)`` of a batch with the bytes of their texts; NULL is empty.

    A run holds about ``limit`` bytes, or a single longer text, so that temporary arrays stay small.
    """
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    start, size, held = 0, 0, []
    for row, value in enumerate(texts):
        raw = value.as_py() or b""
        if held and size + len(raw) > limit:
            yield start, row, held
            start, size, held = row, 0, []
        held.append(raw)
        size += len(raw)
    if held:
        yield start, start + len(held), held


@dataclass
class Words:
    """Words of a block in order: byte range ``starts:ends`` in ``data`` and the text's number.

    Text ``i`` has the words ``bounds[i]:bounds[i + 1]`` and the bytes from ``text_starts[i]`` up to
    ``text_ends[i]``.
    """

    data: np.ndarray
    raw: bytes
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    bounds: np.ndarray
    text_starts: np.ndarray
    text_ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def find_words(texts: Sequence[bytes], lower_ascii: bool = False) -> Words:
    raw = b"\n".join(texts)
    if lower_ascii:
        raw = raw.lower()
    n = len(raw)
    data = np.zeros(n + _PAD, dtype=np.uint8)
    data[:n] = np.frombuffer(raw, dtype=np.uint8)
    data[n:] = 10
    inside = ~SPACE[data[: n + 1]]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_ends = np.cumsum(lengths + 1) - 1
    text_starts = text_ends - lengths
    bounds = np.append(np.searchsorted(starts, text_starts), len(starts))
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return Words(data, raw, starts, ends, text, bounds, text_starts, text_ends)


def hash_ranges(data: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; the same bytes hash alike in every process."""
    size = ends - starts
    result = mix(size.astype(np.uint64))
    lanes = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    active = np.flatnonzero((size > 0) & (size <= _LONG_WORD))
    offset = 0
    while len(active):
        rest = np.minimum(size[active] - offset, 8)
        lane = lanes[starts[active] + offset] & _TAIL_MASK[rest]
        result[active] = mix(result[active] ^ lane)
        offset += 8
        active = active[size[active] > offset]
    for i in np.flatnonzero(size > _LONG_WORD):
        digest = hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8).digest()
        result[i] = np.frombuffer(digest, dtype="<u8")[0]
    return result


def word_hashes(words: Words) -> np.ndarray:
    return hash_ranges(words.data, words.raw, words.starts, words.ends)


def window_hashes(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``size`` words that lie in one text, and where each starts."""
    if len(hashes) < size:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    at = np.flatnonzero(text[size - 1 :] == text[: len(text) - size + 1])
    result = np.full(len(at), np.uint64(size))
    for k in range(size):
        result = mix(result ^ hashes[at + k])
    return result, at
