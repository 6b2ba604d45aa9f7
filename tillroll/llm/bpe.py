"""Byte-level BPE by a pair occurrence index, and its decoding.

A text is cut where a run of white space begins; what lies between is encoded on its own, as no token
crosses such a place. Of all distinct pieces of a batch, every pair that some merge joins is listed
with all its positions. The active ranks are applied in ascending order: a merge replaces all its
positions from left to right and adds the pairs it makes to their lists, so that work follows the
number of merges and not the length of a piece times its merges.

Defined cases: a NULL text is encoded as an empty one and has no ids; repeated rows give repeated
rows; an empty table gives no rows; only the columns asked for are kept.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tillroll.llm.chunks import ChunkCoder, gather, split_marks
from tillroll.llm.words import find_words, text_blocks

# Fixed value: how byte-level vocabularies split a text before merging.
PRETOKEN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"""
    r"""|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""
)
_ID_BITS = 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary: itself if printable, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        if byte in printable:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class ByteBpe:
    """Vocabulary and merges of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._byte_id = np.array([vocab[c] for c in letters], dtype=np.int32)
        self._merge = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        self._rank = {(a << _ID_BITS) | b: r for r, (a, b, _) in reversed(list(enumerate(self._merge)))}
        byte_of = {c: i for i, c in enumerate(letters)}
        by_id = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if all(c in byte_of for c in t)}
        by_id |= {i: t.encode() for t, i in self.special.items()}
        self.token_bytes = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self._first_rank = np.full((256, 256), -1, dtype=np.int32)
        own = {int(i): byte for byte, i in enumerate(self._byte_id)}
        for rank, (a, b, _) in reversed(list(enumerate(self._merge))):
            if a in own and b in own:
                self._first_rank[own[a], own[b]] = rank

    # ------------------------------------------------------------------------------- encoding

    def encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, and their number per chunk; special tokens become their ids."""
        index: dict[bytes, int] = {}
        place = index.setdefault
        steps: list[int] = []
        counts: list[int] = []
        for chunk in chunks:
            # Letters with a space before them or not are one piece.
            if (chunk[1:] if chunk[0] == 32 else chunk).isalpha():
                steps.append(place(chunk, len(index)))
                counts.append(1)
                continue
            text = chunk.decode()
            if (text[1:] if text[0] == " " else text).isalpha():
                steps.append(place(chunk, len(index)))
                counts.append(1)
                continue
            before = len(steps)
            for part in self._split.split(text) if self._split else [text]:
                if part in self.special:
                    steps.append(-1 - self.special[part])
                else:
                    steps.extend([place(piece.encode(), len(index)) for piece in PRETOKEN.findall(part)])
            counts.append(len(steps) - before)
        flat, bounds = self.merge_pieces(list(index))
        special = sorted(self.special.values())
        row = {-1 - i: len(index) + k for k, i in enumerate(special)}
        flat = np.concatenate([flat, special])
        bounds = np.concatenate([bounds, bounds[-1] + 1 + np.arange(len(special))])
        rows = np.array(steps, dtype=np.int64)
        for code, at in row.items():
            rows[rows == code] = at
        ids, sizes = gather(flat, bounds, rows)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(ends)

    def merge_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Apply all merges to pieces, rank by rank over the positions where each pair occurs.

        Returns all ids, and the bounds of each piece's ids.
        """
        if not pieces:
            return np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        n = len(raw)
        following, preceding = np.arange(1, n + 1), np.arange(-1, n - 1)
        following[bounds[1:] - 1] = -1
        preceding[bounds[:-1]] = -1
        symbols = self._byte_id[raw].tolist()
        places = self._occurrences(raw, following)
        self._apply(symbols, following.tolist(), preceding.tolist(), places)
        done = np.array(symbols, dtype=np.int64)
        live = done >= 0
        return done[live], np.concatenate([[0], np.cumsum(live)])[bounds]

    def _occurrences(self, raw: np.ndarray, following: np.ndarray) -> dict[int, list[int]]:
        """The positions of every pair of bytes that a merge joins, by the merge's rank."""
        at = np.flatnonzero(following[:-1] >= 0)
        ranks = self._first_rank[raw[at], raw[at + 1]]
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        found, starts = np.unique(ranks, return_index=True)
        ends = np.append(starts[1:], len(ranks))
        return {r: at[i:j].tolist() for r, i, j in zip(found.tolist(), starts.tolist(), ends.tolist())}

    def _apply(self, symbols, following, preceding, places) -> None:
        active = list(places)
        heapq.heapify(active)
        rank_of = self._rank.get
        while active:
            rank = heapq.heappop(active)
            a, b, joined = self._merge[rank]
            for p in places.pop(rank):
                q = following[p]
                if symbols[p] != a or q < 0 or symbols[q] != b:
                    continue
                symbols[p], symbols[q] = joined, -1
                after, before = following[q], preceding[p]
                following[p] = after
                if after >= 0:
                    preceding[after] = p
                    made = rank_of((joined << _ID_BITS) | symbols[after])
                    if made is not None:
                        if made in places:
                            places[made].append(p)
                        else:
                            places[made] = [p]
                            heapq.heappush(active, made)
                if before >= 0:
                    made = rank_of((symbols[before] << _ID_BITS) | joined)
                    if made is not None:
                        if made in places:
                            places[made].append(before)
                        else:
                            places[made] = [before]
                            heapq.heappush(active, made)


_loaded: dict[str, tuple[ByteBpe, ChunkCoder]] = {}


def _coder(path: str) -> tuple[ByteBpe, ChunkCoder]:
    """Read once per Python worker."""
    if path not in _loaded:
        bpe = ByteBpe(path)
        _loaded[path] = (bpe, ChunkCoder(bpe.encode_chunks))
    return _loaded[path]


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before a position is white space outside ASCII, in UTF-8."""
    one, two, three = data[at - 1], data[at - 2], data[at - 3]
    return (
        ((two == 0xC2) & np.isin(one, [0x85, 0xA0]))
        | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
        | ((three == 0xE2) & (two == 0x80) & ((one >= 0x80) & (one <= 0x8A) | np.isin(one, [0xA8, 0xA9, 0xAF])))
        | ((three == 0xE2) & (two == 0x81) & (one == 0x9F))
        | ((three == 0xE3) & (two == 0x80) & (one == 0x80))
    )


def _chunk_ranges(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """White space and the word after it, in order, as byte ranges with their text.

    White space at the end of a text is a chunk of its own. Two neighbours are one chunk where a run
    of white space would be cut in two.
    """
    starts = words.ends.copy()
    starts[1:] = words.ends[:-1]
    has = words.counts() > 0
    first = words.bounds[:-1][has]
    starts[first] = words.text_starts[has]
    ends, text = words.ends, words.text
    last_end = words.text_starts.copy()
    last_end[has] = words.ends[words.bounds[1:][has] - 1]
    tail = np.flatnonzero(last_end < words.text_ends)
    starts = np.concatenate([starts, last_end[tail]])
    ends = np.concatenate([ends, words.text_ends[tail]])
    text = np.concatenate([text, tail])
    order = np.argsort(starts, kind="stable")
    starts, ends, text = starts[order], ends[order], text[order]
    inner = np.flatnonzero((starts > words.text_starts[text]) & (words.data[starts - 1] >= 0x80))
    if len(inner):
        glued = inner[_after_wide_space(words.data, starts[inner])]
        if len(glued):
            keep = np.ones(len(starts), dtype=bool)
            keep[glued] = False
            opens = np.flatnonzero(keep)
            closes = np.append(opens[1:], len(starts)) - 1
            starts, ends, text = starts[opens], ends[closes], text[opens]
    return starts, ends, text


def _lists(ids: np.ndarray, sizes: np.ndarray, text: np.ndarray, n_texts: int) -> pa.ListArray:
    per_text = np.bincount(text, weights=sizes, minlength=n_texts).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))


def encode(docs: DataFrame, tokenizer_path: str, keep: str = "doc_id") -> DataFrame:
    """``keep`` and ``ids``, the token ids of the whole ``text``, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer_path)[1]
        for batch in batches:
            for start, stop, texts in text_blocks(batch):
                words = find_words(texts)
                starts, ends, text = split_marks(words.data, *_chunk_ranges(words))
                ids, sizes = coder(words.data, words.raw, starts, ends)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), _lists(ids, sizes, text, len(texts))],
                    names=[keep, "ids"],
                )

    kind = docs.schema[keep].dataType.simpleString()
    return docs.select(keep, "text").mapInArrow(run, f"`{keep}` {kind}, ids array<int>")


def decode(coded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``coded`` with ``decoded``: the bytes of its ``ids`` as text, special tokens included.

    Bytes that are no UTF-8 become the replacement character; ids outside the vocabulary are left
    out.
    """
    place = coded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _coder(tokenizer_path)[0].token_bytes
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        table = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        for batch in batches:
            for part in _parts(batch, place):
                lists = part.column(place)
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                known = (ids >= 0) & (ids < len(tokens))
                if not known.all():
                    held = np.concatenate([[0], np.cumsum(known)])
                    ends = np.cumsum(counts)
                    counts, ids = held[ends] - held[ends - counts], ids[known]
                letters, width = gather(table, bounds, ids)
                raw = letters.tobytes()
                at = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
                texts = [raw[i:j].decode("utf-8", "replace") for i, j in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema)
    return coded.mapInArrow(run, f"{fields}, decoded string")


def _parts(batch: pa.RecordBatch, place: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` ids, or one longer row."""
    counts = batch.column(place).value_lengths().fill_null(0).to_pylist()
    start, held = 0, 0
    for row, count in enumerate(counts):
        if row > start and held + count > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += count
    if start < len(counts):
        yield batch.slice(start)
