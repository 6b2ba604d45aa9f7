"""Best-fit packing of token ids into sequences, repacked until a lower bound certifies the count.

1. Documents are tokenized with an end id; only those longer than a sequence are cut.
2. Pieces are dealt to partitions of bounded size. Each partition is packed best fit decreasing, and
   dual feasible functions give a lower bound of its number of sequences.
3. The bound of all pieces together comes from the histogram of their lengths. While the count is
   above it, partitions with a gap exchange the pieces of their loosely filled sequences: these
   pieces are dealt anew, to as few partitions as hold them, and packed again. A repacking that
   saves nothing is not taken and ends the exchange.

No partition has more than about ``partition_pieces`` pieces, however large the corpus, and only the
histogram, of at most one row per length, goes to the driver.

Defined cases: a NULL or empty text is the end id alone; repeated rows and ties are packed like any
others; a NULL id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.chunks import ChunkCoder, gather, is_plain, is_word, lower_plain, split_all_marks
from tillroll.llm.memory import tidied
from tillroll.llm.staging import staged
from tillroll.llm.words import SMALL_BLOCK, find_words, text_blocks

SEQUENCE, END_ID = 2048, 0
PARTITION_PIECES = 20_000
_MAX_EXCHANGES = 8
_BATCH = 4096
_WORDS = 128
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Ids that a worker remembers from task to task; the tokenizer itself goes with the task.
_known: dict[str, ChunkCoder] = {}


@dataclass(frozen=True)
class _Traits:
    """What the file of a tokenizer says of it."""

    lowers: bool
    """Whether plain chunks have the same ids in small letters."""
    suffix: str | None
    """What the last token of a word ends in, if words can be told apart by that."""


@cache
def _traits(path: str) -> _Traits:
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    normalizer = told.get("normalizer") or {}
    steps = normalizer.get("normalizers", [normalizer]) if normalizer else []
    known = all(
        step["type"] in ("NFC", "Lowercase") or (step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"})
        for step in steps
    )
    # an added token is looked for before all else, and nothing that is lowered or joined may become one
    apart = not any(is_plain(token["content"].replace(" ", "").encode()) for token in told.get("added_tokens", []))
    lowers = known and apart and any(step["type"] == "Lowercase" for step in steps)
    return _Traits(lowers, (told["model"].get("end_of_word_suffix") or None) if known and apart else None)


class _Encoder:
    """Ids of chunks by a tokenizer that is read when the first unknown chunk comes.

    Words are encoded many at a time, with blanks between, where the tokenizer marks the last token of a word.
    A text that does not give as many last tokens as it has words is encoded word by word.
    """

    def __init__(self, path: str):
        self._path, self._tokenizer, self._ends = path, None, np.zeros(0, dtype=bool)

    def _load(self):
        # A task has one core; more threads would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(self._path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        suffix = _traits(self._path).suffix
        if suffix is not None:
            vocabulary = self._tokenizer.get_vocab()
            self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self._ends[[at for token, at in vocabulary.items() if token.endswith(suffix)]] = True

    def close(self) -> None:
        self._tokenizer = None

    def __call__(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self._tokenizer is None:
            self._load()
        words = [at for at, chunk in enumerate(chunks) if is_word(chunk)] if self._ends.any() else []
        runs = [words[at : at + _WORDS] for at in range(0, len(words), _WORDS)]
        order, flat, sizes = [], [], []
        for run, ids in zip(runs, self._texts([b" ".join([chunks[at] for at in run]) for run in runs])):
            ids = np.array(ids, dtype=np.int32)
            last = np.flatnonzero(self._ends[ids])
            if len(last) == len(run) and last[-1] == len(ids) - 1:
                order.extend(run)
                flat.append(ids)
                sizes.append(np.diff(last, prepend=-1))
        done = set(order)
        rest = [at for at in range(len(chunks)) if at not in done]
        coded = [*self._texts([chunks[at] for at in rest])]
        flat.append(np.array([*chain.from_iterable(coded)], dtype=np.int32))
        sizes.append(np.array([*map(len, coded)], dtype=np.int64))
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return gather(np.concatenate(flat), bounds, np.argsort(order + rest))

    def _texts(self, texts: list[bytes]) -> Iterator[list[int]]:
        for at in range(0, len(texts), _BATCH):
            some = [text.decode() for text in texts[at : at + _BATCH]]
            yield from (e.ids for e in self._tokenizer.encode_batch_fast(some, add_special_tokens=False))


def token_pieces(
    docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    For tokenizers that encode what lies between white space on its own, letters apart from marks; where they lower the
    text, the ids of a word are remembered for all its spellings. ``ids_crc32`` is the check
    sum of the piece's ids as little-endian 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lowers = _Encoder(tokenizer_path), _traits(tokenizer_path).lowers
        coder = _known.setdefault(tokenizer_path, ChunkCoder()).using(encoder)
        for batch in batches:
            for start, stop, texts in text_blocks(batch, limit=SMALL_BLOCK):
                words = find_words(texts)
                starts, ends, text = split_all_marks(words.data, words.starts, words.ends, words.text)
                data, raw = lower_plain(words.data, words.raw, starts, ends) if lowers else (words.data, words.raw)
                ids, sizes = coder(data, raw, starts, ends)
                bounds = np.searchsorted(text, np.arange(len(texts) + 1))
                done = np.concatenate([[0], np.cumsum(sizes)])[bounds]
                ids = ids.astype("<i4")
                rows: list[tuple[int, int, int, int, int]] = []
                held: list[np.ndarray] = []
                for i, (a, b) in enumerate(zip(done[:-1].tolist(), done[1:].tolist())):
                    whole = np.append(ids[a:b], np.int32(end_id))
                    for piece, first in enumerate(range(0, len(whole), size)):
                        part = whole[first : first + size]
                        rows.append((i, piece, first, len(part), zlib.crc32(part.tobytes())))
                        if with_ids:
                            held.append(part)
                at, piece, first, length, crc = map(np.array, zip(*rows))
                columns = [
                    batch.column(0).slice(start, stop - start).take(pa.array(at)),
                    pa.array(piece, pa.int32()),
                    pa.array(first, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array(held, pa.list_(pa.int32())))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        encoder.close()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(tidied(run), _PIECE + (", ids array<int>" if with_ids else ""))


def lower_bound(lengths: np.ndarray, counts: np.ndarray, size: int) -> int:
    """No packing needs fewer sequences: the best bound of two families of dual feasible functions.

    One counts pieces above ``size - k`` as whole sequences and leaves out those below ``k``; the
    other rounds pieces to the nearest multiple of ``size / k`` that keeps the sum feasible.
    """
    if not len(lengths):
        return 0
    lengths, counts = np.asarray(lengths, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    best = -(-int((lengths * counts).sum()) // size)
    for k in range(1, size // 2 + 1):
        value = np.where(lengths > size - k, size, np.where(lengths >= k, lengths, 0))
        best = max(best, -(-int((value * counts).sum()) // size))
    for k in range(1, 33):
        scaled = (k + 1) * lengths
        exact = scaled % size == 0
        # In units of size * k, so that all values are whole numbers.
        value = np.where(exact, lengths * k, (scaled // size) * size)
        best = max(best, -(-int((value * counts).sum()) // (size * k)))
    return best


def best_fit_decreasing(lengths: list[int], size: int) -> tuple[list[int], list[int], list[int]]:
    """For lengths in falling order: sequence and offset of each, and the free space per sequence."""
    by_free: list[list[int]] = [[] for _ in range(size + 1)]
    open_free = 0  # bit f: a sequence with f free tokens exists
    free: list[int] = []
    sequence, offset = [], []
    for length in lengths:
        fitting = open_free >> length
        if fitting:
            left = (fitting & -fitting).bit_length() - 1 + length
            at = by_free[left].pop()
            if not by_free[left]:
                open_free &= ~(1 << left)
        else:
            at, left = len(free), size
            free.append(size)
        sequence.append(at)
        offset.append(size - left)
        left -= length
        free[at] = left
        if left:
            by_free[left].append(at)
            open_free |= 1 << left
    return sequence, offset, free


def _pack_partition(size: int, number: int):
    """Pack one partition; ``free`` is that of the piece's sequence, ``gap`` that of the partition."""

    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        sequence, offset, free = best_fit_decreasing(pieces["length"].tolist(), size)
        lengths, counts = np.unique(pieces["length"].to_numpy(), return_counts=True)
        bound = lower_bound(lengths, counts, size)
        at = np.array(sequence, dtype=np.int64)
        part = int(pieces["part"].iat[0])
        pieces["sequence_id"] = at + (part << 24) + (number << 56)
        pieces["offset"] = np.array(offset, dtype=np.int64)
        pieces["free"] = np.array(free, dtype=np.int64)[at]
        pieces["gap"] = len(free) - bound
        return pieces.drop(columns="part")

    return run


_ROW = _PIECE + ", row long"
_PLACED = _ROW + ", sequence_id long, offset long, free long, gap long"
_ROW_COLUMNS = [field.split()[0] for field in _ROW.split(", ")]


def _pack(rows: DataFrame, size: int, partition_pieces: int, number: int) -> DataFrame:
    n = rows.count()
    parts = max(1, -(-n // partition_pieces))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(parts)))
    return staged(dealt.groupBy("part").applyInPandas(_pack_partition(size, number), _PLACED), "packed")


def _sequences(placed: DataFrame) -> int:
    return placed.where("offset = 0").count()


def pack(pieces: DataFrame, size: int = SEQUENCE, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    A loosely filled sequence is one with more than a 64th of its tokens free.
    """
    columns = [field.split()[0] for field in _PIECE.split(", ")]
    rows = staged(pieces.select(*columns).withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = rows.groupBy("length").count().toPandas()
    bound = lower_bound(histogram["length"].to_numpy(), histogram["count"].to_numpy(), size)
    current = _pack(rows, size, partition_pieces, 0)
    total, kept = _sequences(current), []
    for number in range(1, _MAX_EXCHANGES + 1):
        if total <= bound:
            break
        # If every partition is certified, only joining partitions can still save sequences.
        gaps = current.where("gap > 0")
        loose = F.col("free") > size // 64
        if not gaps.isEmpty() and number == 1:
            loose = loose | ((F.col("gap") > 0) & (F.col("free") > 0))
        pool = current.where(loose)
        before = _sequences(pool)
        repacked = _pack(pool.select(*_ROW_COLUMNS), size, partition_pieces, number)
        after = _sequences(repacked)
        if after >= before:
            break
        kept.append(current.where(~loose))
        current, total = repacked, total - before + after
    placed = reduce(DataFrame.unionByName, kept, current)
    return placed.select(*columns, "sequence_id", "offset")
