"""Features against a plain version, scores against the embeddings they stand for, held-out accuracy."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import HARD_TEXTS, LONG, TESTDATA, documents, needs_tables, with_clashes
from tillroll.llm import quality_classifier as qc
from tillroll.llm.queries import QUERIES


def spread(x):
    x = ((x ^ (x >> 16)) * 0x85EBCA6B) & 0xFFFFFFFF
    x = ((x ^ (x >> 13)) * 0xC2B2AE35) & 0xFFFFFFFF
    return x ^ (x >> 16)


def bucket(value, salt):
    return (spread((value + (salt * 0x632BE5AB & 0xFFFFFFFF)) & 0xFFFFFFFF) >> (32 - 17)) + 2


def plain_features(text):
    """The multiset of features of a text, word by word."""
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
    found = Counter([0])
    found[1] = sum(a == b for a, b in zip(words, words[1:]))
    for word in words:
        marked = f" {word} "
        for n in range(2, 5):
            for i in range(len(marked) - n + 1):
                if marked[i] == " " == marked[i + n - 1]:
                    continue
                value = 0
                for c in marked[i : i + n]:
                    value = (value * 0x9E3779B1 + spread(ord(c) + 1)) & 0xFFFFFFFF
                found[bucket(value, n)] += 1
        whole = sum(spread((ord(c) * 0x9E3779B1 + k) & 0xFFFFFFFF) for k, c in enumerate(word)) & 0xFFFFFFFF
        found[bucket(whole, 1)] += 1
    return +found


def test_features():
    texts = [t or "" for t in HARD_TEXTS] + ["a a a", " a  a\tb", "b\nb", "\x1c\x1d x\x85y", "😀😀 😀😀"]
    counted = qc.feature_counts([t.encode() for t in texts])
    for text, (buckets, counts) in zip(texts, counted):
        assert dict(zip(buckets.tolist(), counts.tolist())) == dict(plain_features(text)), text[:40]


def toy(n, seed=0):
    rng = random.Random(seed)
    good, bad = ["the", "cat", "sat", "on", "a", "mat"], ["$$buy", "now!!", "###", "win%%"]
    return [(" ".join(rng.choices(good if i % 2 else bad, k=30)), i % 2) for i in range(n)]


def test_score_is_softmax_of_the_mean_vector():
    texts = [t.encode() for t, _ in toy(40)]
    examples = qc.feature_counts(texts)
    model = qc.train(examples, [y for _, y in toy(40)], epochs=3)
    scores = qc._scores(texts, model.evidence())
    for (buckets, counts), score in zip(examples, scores):
        hidden = (counts / counts.sum()) @ model.vectors[buckets]
        assert score == pytest.approx(qc._softmax(hidden @ model.output)[1], abs=1e-4)


def test_gradient_lowers_the_loss():
    examples, labels = qc.feature_counts([t.encode() for t, _ in toy(60)]), [y for _, y in toy(60)]
    few, more = (qc.train(examples, labels, epochs=e) for e in (1, 8))

    def loss(model):
        s = qc._scores([t.encode() for t, _ in toy(60)], model.evidence())
        return -np.mean(np.log(np.where(np.array(labels) == 1, s, 1 - s)))

    assert loss(more) < loss(few) < np.log(2)


def test_defined_cases(spark):
    docs = documents(spark)
    labels = with_clashes(spark.createDataFrame([(5, 1), (6, 0), (7, None), (5, 1), (None, 1)], "doc_id long, label int"))
    twice = docs.unionByName(docs)
    rows = qc.score_quality(twice, qc.train_quality_model(twice, labels), keep=["doc_id", "kept"]).collect()
    assert len(rows) == 2 * len(HARD_TEXTS) and all(0 <= r["score"] <= 1 and r["kept"] == "clash" for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], set()).add(r["score"])
    assert all(len(s) == 1 for s in by_id.values()) and by_id[0] == by_id[1]
    again = qc.score_quality(docs, qc.train_quality_model(docs, labels)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {i: next(iter(s)) for i, s in by_id.items()}
    assert qc.score_quality(documents(spark, []), qc.train_quality_model(docs, labels)).count() == 0


def test_without_labels_every_score_is_a_half(spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    rows = qc.score_quality(documents(spark), qc.train_quality_model(documents(spark), none)).collect()
    assert {r["score"] for r in rows} == {0.5}


def test_a_bounded_number_of_examples(spark):
    docs = documents(spark, [t for t, _ in toy(50)])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(toy(50))], "doc_id long, label int")
    full, part = (qc.train_quality_model(docs, labels, most_examples=n) for n in (50, 5))
    assert np.abs(full.output).max() > 0 and not np.array_equal(full.output, part.output)


def test_a_long_text_counts_to_its_end():
    ends = [LONG.encode() + b" ", (LONG + " $$$ " * 2000).encode()]
    a, b = qc.feature_counts(ends)
    assert b[1].sum() > a[1].sum() + 2000


@needs_tables
def test_held_out_accuracy(spark):
    folder = TESTDATA.replace("0.001", "0.01")
    rows = QUERIES["op12_quality_classifier"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    known = [(r["predicted"], quality[r["doc_id"]]) for r in held if r["doc_id"] in quality]
    assert len(known) > 40 and np.mean([p == q for p, q in known]) >= 0.95
