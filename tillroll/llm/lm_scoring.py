"""Cross-entropy difference of each document between a target and a background language model.

Both are models of words given the word before, over one vocabulary: the words of all documents. They
are matched: same vocabulary, order and smoothing, and the background counts are scaled to the target's
number of tokens, so that smoothing weighs alike. A token's loss is its negative log probability in
bits; the first word follows a start mark. A document's score is the mean loss under the target model
minus that under the background model: the lower, the more like the target. ``corpus_loss`` is the mean
loss under the background with its counts as they are. A document is scored by models of the *other*
documents: its own counts are taken out of both.

A word's probability is ``(k n(w) + s / V) / (k N + s)`` by itself and, after ``v``,
``(k n(v, w) + s p(w)) / (k n(v) + s)``, with the strength ``s``, the scale ``k`` and ``V`` the number of
tokens in all documents, which the number of different words cannot exceed; what is left over belongs
to words not seen and to the end of a text.

The counts of words and pairs grow with the corpus and stay with Spark. Documents are dealt to blocks of
bounded size. A block counts its own keys (64-bit hashes) and sends them, sorted and compressed, to the
owners of their ranges; an owner adds up what the blocks sent and answers each block in the order of
its keys, and the block, hashed again, looks up its tokens. A frequent word is one key of each block, so
that no owner has more of it than there are blocks. What goes through the driver is one sum. Every step
depends on ids and texts alone, so that a lost task gives the same again.

Defined cases: a NULL or empty text, or one of white space, has no tokens, losses of 0 and a score of 0;
where no other document is a target, both models are the background and the score is 0; a document
listed more than once as a target counts once; repeated rows count and are scored each, and each is
another document to the others; a NULL id is no target; an empty table gives no rows; other columns are
ignored. Rows that share one id share a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.words import find_words, mix, word_hashes

STRENGTH = 8.0
# Bytes of text per block and per owner of a range of keys.
BLOCK_BYTES = 4 << 20
OWNER_BYTES = 8 << 20
_START, _WORD, _PAIR, _TOTAL = (np.uint64(x) for x in (0x5374617274, 0x576F7264, 0x50616972, 0x546F74616C))
_DIGITS = 6


def _pack(values: np.ndarray) -> bytes:
    """Integers by planes of equal bytes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, size: int, kind: str) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    raw = pa.decompress(packed, decompressed_size=size * wide, codec="zstd", asbytes=True)
    return np.frombuffer(raw, dtype=np.uint8).reshape(wide, size).T.copy().view(kind).reshape(-1)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(packed: bytes, size: int) -> np.ndarray:
    return np.cumsum(_unpack(packed, size, "<u8"), dtype=np.uint64)


class _Block:
    """Documents of a block, and its distinct keys in order with their counts.

    ``pair``, ``word`` and ``before`` are the places in ``keys`` of each token's pair, word and last word;
    the last key place, ``total``, counts tokens.
    """

    def __init__(self, rows: pa.Table) -> None:
        ids, listed = rows.column("doc_id"), rows.column("is_listed").to_numpy(zero_copy_only=False).astype(bool)
        listed_ids = set(ids.filter(pa.array(listed)).to_pylist())
        self.docs = rows.filter(pa.array(~listed))
        self.ids = self.docs.column("doc_id")
        self.is_target = np.array([i is not None and i in listed_ids for i in self.ids.to_pylist()], dtype=bool)
        words = find_words([text.as_py() or b"" for text in self.docs.column("text").cast(pa.binary())])
        self.text, self.sizes = words.text, words.counts()
        n = len(words)
        self.first = np.zeros(n, dtype=bool)
        self.first[words.bounds[:-1][self.sizes > 0]] = True
        spelled = word_hashes(words)
        last = np.roll(spelled, 1)
        last[self.first] = _START
        pairs = mix(mix(last ^ _PAIR) ^ spelled)
        single = mix(np.append(spelled, _START) ^ _WORD)
        self.keys, where = np.unique(np.concatenate([pairs, single, mix(np.array([_TOTAL]))]), return_inverse=True)
        self.pair, self.word, self.start, self.total = where[:n], where[n : 2 * n], where[2 * n], where[2 * n + 1]
        self.before = np.roll(self.word, 1)
        self.before[self.first] = self.start
        target = self.is_target[self.text]
        self.n, self.n_target = (
            self._counted(chosen, docs) for chosen, docs in ((slice(None), self.sizes > 0), (target, (self.sizes > 0) & self.is_target))
        )

    def _counted(self, chosen, docs: np.ndarray) -> np.ndarray:
        size = len(self.keys)
        n = np.bincount(self.pair[chosen], minlength=size) + np.bincount(self.word[chosen], minlength=size)
        n[self.start], n[self.total] = docs.sum(), len(self.pair[chosen])
        return n

    def own(self, places: np.ndarray) -> np.ndarray:
        """How often each token's key occurs in its document."""
        _, where, n = np.unique(self.text * len(self.keys) + places, return_inverse=True, return_counts=True)
        return n[where]


_SENT = "owner int, block long, size long, keys binary, counts binary"


def _send(n_owners: int):
    """Of each block, one message to the owner of each range of keys that it has."""

    def send(rows: pa.Table) -> pa.Table:
        block, number = _Block(rows), rows.column("block")[0].as_py()
        limits = np.arange(1, n_owners, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // n_owners)
        edges = [0, *np.searchsorted(block.keys, limits), len(block.keys)]
        sent = []
        for owner, (start, stop) in enumerate(zip(edges[:-1], edges[1:])):
            if start < stop:
                counts = np.concatenate([block.n[start:stop], block.n_target[start:stop]])
                sent.append((owner, number, stop - start, _pack_sorted(block.keys[start:stop]), _pack(counts)))
        columns = list(zip(*sent))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        names = [part.split()[0] for part in _SENT.split(", ")]
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    return send


def _answer(sent: pa.Table) -> pa.Table:
    """To each block that sent keys, their counts in all blocks, in the block's order."""
    sizes = sent.column("size").to_numpy()
    keys = np.concatenate([_unpack_sorted(p.as_py(), n) for p, n in zip(sent.column("keys"), sizes)])
    counts = [_unpack(p.as_py(), 2 * n, "<i8") for p, n in zip(sent.column("counts"), sizes)]
    known, where = np.unique(keys, return_inverse=True)
    sums = np.zeros((2, len(known)), dtype=np.int64)
    for k in (0, 1):
        np.add.at(sums[k], where, np.concatenate([c.reshape(2, -1)[k] for c in counts]))
    places = np.split(where, np.cumsum(sizes)[:-1])
    replies = pa.array([_pack(np.concatenate([sums[0][at], sums[1][at]])) for at in places], pa.binary())
    return sent.select(["owner", "block", "size"]).append_column("counts", replies)


_SCORED = "doc_id long, n_tokens long, target_loss double, background_loss double, score double, corpus_loss double"


def _score(rows: pa.Table, replies: pa.Table) -> pa.Table:
    block = _Block(rows)
    ordered = replies.sort_by("owner")
    parts = [
        _unpack(p.as_py(), 2 * n.as_py(), "<i8").reshape(2, -1)
        for p, n in zip(ordered.column("counts"), ordered.column("size"))
    ]
    n_all = np.concatenate(parts, axis=1) if parts else np.zeros((2, len(block.keys)), dtype=np.int64)
    tokens = np.maximum(n_all[0][block.total], 1)
    own_pair, own_word = block.own(block.pair), block.own(block.word)
    own_before = np.roll(own_word, 1)
    own_before[block.first] = 1
    sizes, text = block.sizes, block.text

    def loss(model: int, out: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """Mean loss of each document; ``out`` says whose own counts are in the model."""
        left = out[text]
        pair, word, before = (
            scale[text] * (n_all[model][at] - own * left)
            for at, own in ((block.pair, own_pair), (block.word, own_word), (block.before, own_before))
        )
        rest = (scale * (n_all[model][block.total] - sizes * out))[text]
        alone = (word + STRENGTH / tokens) / (rest + STRENGTH)
        bits = -np.log2((pair + STRENGTH * alone) / (before + STRENGTH))
        return np.round(np.bincount(text, weights=bits, minlength=len(sizes)) / np.maximum(sizes, 1), _DIGITS)

    every, ones = np.ones(len(sizes), dtype=np.int64), np.ones(len(sizes))
    n_target = n_all[1][block.total] - sizes * block.is_target
    n_background = n_all[0][block.total] - sizes
    scale = np.where(n_target > 0, n_target / np.maximum(n_background, 1), 1.0)
    background = loss(0, every, scale)
    target = np.where(n_target > 0, loss(1, block.is_target.astype(np.int64), ones), background)
    columns = [sizes.astype(np.int64), target, background, np.round(target - background, _DIGITS), loss(0, every, ones)]
    names = [part.split()[0] for part in _SCORED.split(", ")]
    return pa.table([block.ids.cast(pa.int64()), *[pa.array(c) for c in columns]], names=names)


def _parts(total: int, size: int) -> int:
    return max(1, -(-total // size))


def _dealt(docs: DataFrame, target_ids: DataFrame, n_blocks: int) -> DataFrame:
    """Documents and listed ids by block; a listed id meets the documents that have it."""

    def block(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n_blocks)).alias("block")

    by_text = F.coalesce("doc_id", F.xxhash64("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select(block(by_text), "doc_id", "text", F.lit(False).alias("is_listed"))
    listed = target_ids.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return rows.unionAll(
        listed.select(block(F.col("doc_id")), "doc_id", F.lit(None).cast("string").alias("text"), F.lit(True).alias("is_listed"))
    )


def cross_entropy_difference(
    docs: DataFrame, target_ids: DataFrame, *, block_bytes: int = BLOCK_BYTES, owner_bytes: int = OWNER_BYTES
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, target_loss, background_loss, score, corpus_loss``.

    A task holds one block of texts or one range of keys at a time, besides a single longer document;
    with more memory, larger ones mean fewer and fuller messages.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    dealt = _dealt(docs, target_ids, _parts(total, block_bytes))
    sent = dealt.groupBy("block").applyInArrow(_send(_parts(total, owner_bytes)), _SENT)
    replies = sent.groupBy("owner").applyInArrow(_answer, "owner int, block long, size long, counts binary")
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_score, _SCORED)
