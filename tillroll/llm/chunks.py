"""Token ids of many chunks of text at once: every distinct chunk is encoded once per worker."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

from tillroll.llm.words import hash_ranges


_Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
_AT_ONCE = 16_384
_MARKS = b"!#$%&*,.:;?"
_MOST_MARKS = 8
_CAPITAL, _LETTER, _MARK, _PLAIN = (np.zeros(256, dtype=bool) for _ in range(4))
_CAPITAL[65:91] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[*_MARKS]] = True
_PLAIN[[*range(65, 91), *range(97, 123), *range(48, 58), *_MARKS]] = True
# In UTF-8, the letters of Latin-1 beyond ASCII are this byte and a second one; its capitals are 32 below.
_LEAD = 0xC3
_SECOND, _SECOND_CAPITAL = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_SECOND[0x80:0xC0] = True
_SECOND_CAPITAL[0x80:0x9F] = True
_SECOND[[0x97, 0xB7]] = _SECOND_CAPITAL[0x97] = False
_PLAIN_TEXT = re.compile(rb"(?:[A-Za-z0-9%s]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*" % re.escape(_MARKS))
_WORD = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def is_word(chunk: bytes) -> bool:
    """Whether a chunk has only letters, those of Latin-1."""
    return _WORD.fullmatch(chunk) is not None


def is_plain(text: bytes) -> bool:
    """Whether a text has only letters of Latin-1, digits and the marks that :func:`split_all_marks` cuts off."""
    return _PLAIN_TEXT.fullmatch(text) is not None


def split_marks(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges with a comma or full stop after a letter at their end cut in two.

    Tokenizers that keep letters and marks apart encode the parts as they do the whole, and there are
    fewer distinct parts.
    """
    last = data[ends - 1]
    cut = np.flatnonzero(((last == 44) | (last == 46)) & (ends - starts > 1) & _LETTER[data[ends - 2]])
    return _cut_in_two(starts, ends, text, cut, ends[cut] - 1)


def split_all_marks(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like :func:`split_marks` for more marks, up to eight of them, after a letter of Latin-1."""
    kept = ends.copy()
    active = np.arange(len(ends))
    for _ in range(_MOST_MARKS):
        active = active[(kept[active] - starts[active] > 1) & _MARK[data[kept[active] - 1]]]
        kept[active] -= 1
    cut = np.flatnonzero(kept < ends)
    last, before = data[kept[cut] - 1], data[np.maximum(kept[cut] - 2, 0)]
    cut = cut[_LETTER[last] | ((before == _LEAD) & _SECOND[last])]
    return _cut_in_two(starts, ends, text, cut, kept[cut])


def _cut_in_two(
    starts: np.ndarray, ends: np.ndarray, text: np.ndarray, cut: np.ndarray, place: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(cut):
        return starts, ends, text
    at = cut + 1
    shorter = ends.copy()
    shorter[cut] = place
    return np.insert(starts, at, place), np.insert(shorter, at, ends[cut]), np.insert(text, at, text[cut])


def lower_plain(data: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, bytes]:
    """``data`` and ``raw`` with small letters in the ranges that :func:`is_plain`; the others stay."""
    plain, capital = _PLAIN[data], _CAPITAL[data]
    second = np.flatnonzero(data[:-1] == _LEAD) + 1
    second = second[_SECOND[data[second]]]
    plain[second] = plain[second - 1] = True
    capital[second] = _SECOND_CAPITAL[data[second]]
    # how many bytes that are not plain lie before each place
    odd = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum(~plain, out=odd[1:])
    keeps = np.flatnonzero(odd[ends] > odd[starts])
    if len(keeps):
        edges = np.zeros(len(data) + 1, dtype=np.int8)
        edges[starts[keeps]] += 1
        edges[ends[keeps]] -= 1
        capital &= np.cumsum(edges[:-1], dtype=np.int8) == 0
    lowered = data + (capital.view(np.uint8) << 5)
    return lowered, lowered[: len(raw)].tobytes()


def gather(flat: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of rows ``bounds[r]:bounds[r + 1]``, one row after the other, and each row's size."""
    sizes = bounds[rows + 1] - bounds[rows]
    ends = np.cumsum(sizes)
    source = np.repeat(bounds[rows] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
    return flat[source], sizes


class ChunkCoder:
    """Remembers ids by the hash of a chunk's bytes; ``limit`` bounds the bytes that a worker keeps.

    ``encode`` gives the ids of distinct chunks, one after the other, and their number per chunk.
    Python workers are reused, so that later batches and tasks find most of their chunks known. What
    is known lies in plain arrays, some 30 bytes a chunk.
    """

    def __init__(self, encode: _Encode | None = None, limit: int = 32 << 20):
        self._encode, self._limit = encode, limit
        self._clear()

    def using(self, encode: _Encode) -> ChunkCoder:
        """This coder, with what encodes unknown chunks from now on."""
        self._encode = encode
        return self

    def held_bytes(self) -> int:
        return sum(h.nbytes + r.nbytes for h, r in self._levels) + self._bounds.nbytes + self._ids.nbytes

    def _clear(self) -> None:
        # Sorted hashes and their rows, in levels of falling size, so that adding is cheap.
        self._levels: list[tuple[np.ndarray, np.ndarray]] = []
        self._bounds = np.zeros(1, dtype=np.int64)
        self._ids = np.empty(0, dtype=np.int32)

    def __len__(self) -> int:
        return len(self._bounds) - 1

    def _rows(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where it is not known."""
        result = np.full(len(hashes), -1, dtype=np.int32)
        for held, rows in self._levels:
            at = np.minimum(np.searchsorted(held, hashes), len(held) - 1)
            found = held[at] == hashes
            result[found] = rows[at[found]]
        return result

    def _add(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        coded = [self._encode(chunks[i : i + _AT_ONCE]) for i in range(0, len(chunks), _AT_ONCE)]
        flat, sizes = (np.concatenate(part) for part in zip(*coded))
        self._levels.append((hashes, len(self) + np.arange(len(hashes), dtype=np.int32)))
        self._bounds = np.concatenate([self._bounds, self._bounds[-1] + np.cumsum(sizes)])
        self._ids = np.concatenate([self._ids, flat.astype(np.int32)])
        while len(self._levels) > 1 and len(self._levels[-2][0]) < 2 * len(self._levels[-1][0]):
            held, rows = (np.concatenate(part) for part in zip(*self._levels[-2:]))
            order = np.argsort(held)
            self._levels[-2:] = [(held[order], rows[order])]

    def __call__(
        self, data: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks ``starts:ends`` in order, and the number of ids of each chunk."""
        hashes = hash_ranges(data, raw, starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if self.held_bytes() > self._limit:
            self._clear()
        rows = self._rows(distinct)
        unknown = np.flatnonzero(rows < 0)
        if len(unknown):
            new = first[unknown]
            rows[unknown] = len(self) + np.arange(len(new), dtype=np.int32)
            self._add(distinct[unknown], [raw[s:e] for s, e in zip(starts[new].tolist(), ends[new].tolist())])
        return gather(self._ids, self._bounds, rows.astype(np.int64)[inverse])
