"""A quality classifier of supervised subword embeddings.

A text's features are its words, the runs of 2 to 4 characters within words (white space marks a word's
ends), words that repeat the one before, and one feature that every text has. Each is hashed into one of
``BUCKETS`` rows of a table of learned vectors. The average of a text's vectors goes through a learned
linear map and softmax. Vectors and map are trained together by numpy stochastic gradient descent on
cross-entropy.

Features of the labelled texts are counted where the texts lie; training takes one task and no more
than ``MOST_EXAMPLES`` examples, those with the least hashed ids. Every text is scored, whole.

The linear map of an average is the average of the mapped vectors, so that scoring needs one number per
bucket: the difference of its two mapped values. These, ``BUCKETS`` numbers, are broadcast.

Defined cases: a NULL text is empty and is scored by the feature that all texts have; of rows with one
id, the features of one (the least as bytes) are trained on; a label that is NULL is none; without
any label, or with both equally likely, the score is 0.5; an empty table gives no rows; other columns
are kept if asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.words import text_blocks

_BITS = 17
_ALWAYS, _REPEATED, _RESERVED = 0, 1, 2
BUCKETS = (1 << _BITS) + _RESERVED
DIMENSIONS = 8
MOST_EXAMPLES = 4_000
EPOCHS = 6
RATE = 0.5
SHORTEST, LONGEST = 2, 4
_BLOCK = 1 << 20
_MULTIPLIER = np.uint32(0x9E3779B1)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _bucket(hashes: np.ndarray, salt: int) -> np.ndarray:
    mixed = _spread(hashes + np.uint32(salt * 0x632BE5AB & 0xFFFFFFFF))
    return (mixed >> np.uint32(32 - _BITS)).astype(np.int32) + np.int32(_RESERVED)


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The features of a block of texts in parts: the number of the text and the bucket of each.

    White space of any kind and length reads as one space. Texts of a block do not mix.
    """
    decoded = [raw.decode("utf-8", "replace") for raw in texts]
    lengths = np.fromiter(map(len, decoded), dtype=np.int64, count=len(decoded))
    points = np.frombuffer("\n".join(["", *decoded, ""]).encode("utf-32-le"), dtype=np.uint32)
    inner = (points != 32) & ((points < 9) | (points > 13))
    # The line feed after a text goes with it, and the very first with the first text.
    text = np.repeat(np.arange(len(texts), dtype=np.int32), lengths + 1)
    text = np.concatenate([np.zeros(1, dtype=np.int32), text])
    yield np.arange(len(texts), dtype=np.int32), np.full(len(texts), _ALWAYS, dtype=np.int32)

    # Runs of characters, of which the first and the last may be white space, but not both.
    spread = _spread(np.where(inner, points, np.uint32(32)) + np.uint32(1))
    rolling, unbroken = spread, np.ones(len(points), dtype=bool)
    for size in range(2, LONGEST + 1):
        rolling = rolling[:-1] * _MULTIPLIER + spread[size - 1 :]
        unbroken = unbroken[:-1] if size == 2 else unbroken[:-1] & inner[size - 2 : -1]
        if size >= SHORTEST:
            at = np.flatnonzero(unbroken & (inner[: len(unbroken)] | inner[size - 1 :]))
            yield text[at + ~inner[at]], _bucket(rolling[at], size)

    # Words: sums of spread characters, each with its place in the word.
    starts = np.flatnonzero(inner[1:] & ~inner[:-1]) + 1
    if not len(starts):
        return
    first = np.zeros(len(points), dtype=np.uint32)
    first[starts] = starts
    place = np.arange(len(points), dtype=np.uint32) - np.maximum.accumulate(first)
    words = np.add.reduceat(np.where(inner, _spread(points * _MULTIPLIER + place), np.uint32(0)), starts, dtype=np.uint32)
    owner = text[starts]
    yield owner, _bucket(words, 1)
    again = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1])) + 1
    yield owner[again], np.full(len(again), _REPEATED, dtype=np.int32)


def feature_counts(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: the buckets of its features, ascending, and how many features each has."""
    owner, bucket = (np.concatenate(x) for x in zip(*features(texts)))
    keys, counts = np.unique(owner.astype(np.int64) * BUCKETS + bucket, return_counts=True)
    bounds = np.searchsorted(keys, np.arange(len(texts) + 1) * BUCKETS)
    return [
        ((keys[a:b] % BUCKETS).astype(np.int32), counts[a:b].astype(np.float32)) for a, b in zip(bounds, bounds[1:])
    ]


# ------------------------------------------------------------------------------------ training


@dataclass
class QualityModel:
    """Learned vectors per bucket, and the map to the two classes."""

    vectors: np.ndarray
    output: np.ndarray

    def evidence(self) -> np.ndarray:
        """Per bucket, how much more its mapped vector speaks for label 1 than for label 0."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(examples: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = EPOCHS, rate: float = RATE) -> QualityModel:
    """Stochastic gradient descent over the examples, in a fixed random order, at a falling rate."""
    rng = np.random.default_rng(1)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    shares = [counts / counts.sum() for _, counts in examples]
    step, steps = 0, max(1, epochs * len(examples))
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            now = np.float32(rate * (1 - step / steps))
            step += 1
            buckets, share = examples[i][0], shares[i]
            hidden = share @ vectors[buckets]
            error = _softmax(hidden @ output).astype(np.float32)
            error[labels[i]] -= 1
            back = output @ error
            output -= now * np.outer(hidden, error)
            vectors[buckets] -= now * share[:, None] * back
    return QualityModel(vectors, output)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop, texts in text_blocks(batch, limit=_BLOCK):
            found = feature_counts(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, stop - start),
                    pa.array([b.tobytes() + c.tobytes() for b, c in found], pa.binary()),
                ],
                names=["doc_id", "features"],
            )


def _train_task(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["order", "doc_id", "label"])
    examples = []
    for blob in rows["features"]:
        half = len(blob) // 2
        examples.append((np.frombuffer(blob[:half], dtype=np.int32), np.frombuffer(blob[half:], dtype=np.float32)))
    model = train(examples, rows["label"].tolist())
    return pd.DataFrame({"vectors": [model.vectors.tobytes()], "output": [model.output.tobytes()]})


def train_quality_model(docs: DataFrame, labels: DataFrame, most_examples: int = MOST_EXAMPLES) -> QualityModel:
    """A model from the texts of ``docs`` whose ids ``labels`` marks as ``label`` 0 or 1.

    ``labels`` is shuffled by nothing but the choice of its ``most_examples`` least hashed ids.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    marked = marked.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    order = F.xxhash64("doc_id").alias("order")
    chosen = F.broadcast(marked.select("*", order).orderBy("order", "doc_id", "label").limit(most_examples))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = texts.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
    counted = wanted.mapInArrow(_count_features, "doc_id long, features binary").groupBy("doc_id").agg(
        F.min("features").alias("features")
    )
    examples = counted.join(chosen, "doc_id").select("doc_id", "features", "label", "order")
    learned = examples.groupBy().applyInPandas(_train_task, "vectors binary, output binary").collect()
    if not learned:
        return train([], [])
    vectors, output = (np.frombuffer(learned[0][k], dtype=np.float32).reshape(-1, n) for k, n in ((0, DIMENSIONS), (1, 2)))
    return QualityModel(vectors, output)


# -------------------------------------------------------------------------------------- scores


def _scores(texts: list[bytes], evidence: np.ndarray) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for owner, bucket in features(texts):
        total += np.bincount(owner, weights=evidence[bucket], minlength=len(texts))
        count += np.bincount(owner, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / count, -50, 50)))


def score_quality(docs: DataFrame, model: QualityModel, keep: list[str] | None = None, score: str = "score") -> DataFrame:
    """``keep`` columns of every document (by default ``doc_id``) and the probability of label 1."""
    keep = keep if keep is not None else ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model.evidence())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in text_blocks(batch, limit=_BLOCK):
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(_scores(texts, shared.value))], names=[*part.schema.names[1:], "score"]
                )

    kinds = dict(docs.select(*[F.col(f"`{name}`") for name in keep]).dtypes)
    inputs = docs.select("text", *[F.col(f"`{name}`").alias(f"kept_{i}") for i, name in enumerate(keep)])
    fields = [f"kept_{i} {kinds[name]}" for i, name in enumerate(keep)]
    return inputs.mapInArrow(run, ", ".join([*fields, "score double"])).toDF(*keep, score)
