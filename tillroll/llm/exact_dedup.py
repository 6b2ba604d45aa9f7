"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Each partition reads its texts once, deletes white space and takes a 64-bit fingerprint. It sorts
   the distinct fingerprints and sends one Golomb-coded message to each owner of a fingerprint range.
2. An owner merges the messages it gets and returns one bitmap per message: a bit is set where a
   fingerprint also came from another partition. Fingerprints that repeat within a partition need
   no message; the partition has marked them itself.
3. Rows whose bit is set, or that repeat within their partition, are suspects. Only texts whose
   fingerprint is that of a suspect are shuffled, combined per task first, and grouped by their
   whole bytes. Partitions pick them by a Bloom filter of fixed size; a false hit costs a row in the
   shuffle and changes nothing.

All other rows are alone in their group. Nothing but the filter, of ``FILTER_BYTES`` at most, is
broadcast, and no group of copies is collected.

Defined cases: a NULL text counts as empty; texts without any other character than white space are
equal to each other; of equal texts the one with the most code points stays, then the smallest id, a
NULL id last. Rows with equal id and equal length of one group cannot be told apart and are all
kept or all dropped. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import golomb
from tillroll.llm.key_filter import FILTER_BYTES, broadcast_filter, possible
from tillroll.llm.memory import tidied
from tillroll.llm.staging import staged

WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_ROWS = (
    "doc_id long, n_chars long, fingerprint long, text_sha256 string, part long, owner int, "
    "place int, repeated boolean, message binary"
)


def _stripped(texts: pa.ChunkedArray | pa.Array) -> Iterator[tuple[bytes, int]]:
    """Per text: its bytes without white space, and its length in code points."""
    for value in texts:
        text = value.as_py() or ""
        yield text.encode().translate(None, WHITE_SPACE), len(text)


def _fingerprint(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _fingerprints(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # 48 bytes a row, and the ids as they came
        ids: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        digests: list[np.ndarray] = []
        for batch in batches:
            ids.append(pa.concat_arrays([batch.column(0)]))
            blob, sizes = bytearray(), np.empty(len(batch), dtype=np.int64)
            for i, (raw, n_chars) in enumerate(_stripped(batch.column(1))):
                blob += hashlib.sha256(raw).digest()
                sizes[i] = n_chars
            lengths.append(sizes)
            digests.append(np.frombuffer(bytes(blob), dtype=np.uint8).reshape(-1, 32))
        if ids:
            yield from _messages(owners, pa.concat_arrays(ids), np.concatenate(lengths), np.concatenate(digests))

    return run


_ROWS_AT_ONCE = 20_000
_MESSAGE_BYTES = 1 << 20


def _messages(owners, ids: pa.Array, lengths: np.ndarray, digests: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per document with its place in the message to its owner, then the messages."""
    part = TaskContext.get().partitionId()
    prints = np.ascontiguousarray(digests[:, :8]).view("<i8").ravel()
    values, inverse, counts = np.unique(
        prints.view(np.uint64), return_inverse=True, return_counts=True
    )
    span = np.uint64(-(-(1 << 64) // owners) if owners > 1 else (1 << 64) - 1)
    value_owner = np.minimum(values // span, np.uint64(owners - 1)).astype(np.int32)
    bounds = np.searchsorted(value_owner, np.arange(owners + 1))
    place = (np.arange(len(values)) - bounds[value_owner]).astype(np.int32)
    names = [field.split()[0] for field in _ROWS.split(", ")]
    for start in range(0, len(ids), _ROWS_AT_ONCE):
        rows = slice(start, start + _ROWS_AT_ONCE)
        at = inverse[rows]
        n = len(at)
        yield pa.RecordBatch.from_arrays(
            [
                ids.slice(start, n),
                pa.array(lengths[rows]),
                pa.array(prints[rows]),
                pa.array([digest.tobytes().hex() for digest in digests[rows]], pa.string()),
                pa.array(np.full(n, part, dtype=np.int64)),
                pa.array(value_owner[at]),
                pa.array(place[at]),
                pa.array(counts[at] > 1),
                pa.nulls(n, pa.binary()),
            ],
            names=names,
        )
    to, held = [], []
    for owner in np.flatnonzero(np.diff(bounds)).tolist():
        to.append(owner)
        held.append(golomb.encode(values[bounds[owner] : bounds[owner + 1]]))
        if sum(map(len, held)) >= _MESSAGE_BYTES:
            yield _message_rows(part, to, held, names)
            to, held = [], []
    if held:
        yield _message_rows(part, to, held, names)


def _message_rows(part: int, to: list[int], messages: list[bytes], names: list[str]) -> pa.RecordBatch:
    n = len(to)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = [
        *(pa.nulls(n, kind) for kind in kinds),
        pa.array(np.full(n, part, dtype=np.int64)),
        pa.array(to, pa.int32()),
        pa.nulls(n, pa.int32()),
        pa.nulls(n, pa.bool_()),
        pa.array(messages, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _answers(messages: pd.DataFrame) -> pd.DataFrame:
    """What the owner of a range returns: per message, a bitmap of the values others sent too."""
    decoded = [golomb.decode(blob) for blob in messages["message"]]
    values, counts = np.unique(np.concatenate(decoded), return_counts=True)
    shared = values[counts > 1]
    bitmaps = []
    for own in decoded:
        bits = np.zeros(-(-len(own) // 64) * 64, dtype=np.uint8)
        bits[: len(own)] = np.isin(own, shared, assume_unique=True)
        bitmaps.append(np.packbits(bits, bitorder="little").view(np.int64))
    return pd.DataFrame({"part": messages["part"], "owner": messages["owner"], "bitmap": bitmaps})


def _possible_suspects(suspects):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_stripped(batch.column(1)))
            prints = [_fingerprint(hashlib.sha256(raw).digest()) for raw, _ in found]
            hits = np.flatnonzero(possible(suspects.value, np.array(prints, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(hits)),
                    pa.array([found[i][1] for i in hits], pa.int64()),
                    pa.array([found[i][0] for i in hits], pa.binary()),
                ],
                names=["doc_id", "n_chars", "bare"],
            )

    return run


def exact_duplicates(
    docs: DataFrame, owners: int | None = None, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``owners`` is the number of fingerprint ranges, by default that of shuffle partitions.
    ``filter_bytes`` is the size of the Bloom filter, a power of two.
    """
    spark = docs.sparkSession
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = staged(texts.mapInArrow(tidied(_fingerprints(owners)), _ROWS), "exact-dedup")
    rows = sent.where("message IS NULL")
    bitmaps = (
        sent.where("message IS NOT NULL")
        .select("part", "owner", "message")
        .groupBy("owner")
        .applyInPandas(_answers, "part long, owner int, bitmap array<long>")
    )
    elsewhere = F.expr("getbit(bitmap[place div 64], place % 64) = 1")
    suspects = rows.join(bitmaps, ["part", "owner"]).where(F.col("repeated") | elsewhere)
    wanted = broadcast_filter(suspects, "fingerprint", filter_bytes)
    verified = (
        texts.mapInArrow(
            tidied(_possible_suspects(wanted)), "doc_id long, n_chars long, bare binary"
        )
        .groupBy("bare")
        .agg(
            F.count("*").alias("group_size"),
            F.max(F.struct("n_chars", (-F.col("doc_id")).alias("minus_id"))).alias("best"),
        )
        .where("group_size > 1")
        .select(
            F.sha2("bare", 256).alias("text_sha256"),
            "group_size",
            (-F.col("best.minus_id")).alias("keep_id"),
            F.col("best.n_chars").alias("keep_chars"),
        )
    )
    groups = staged(verified, "exact-groups")
    joined = rows.select("doc_id", "n_chars", "text_sha256").join(groups, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars")))).alias("kept"),
        "text_sha256",
    )
