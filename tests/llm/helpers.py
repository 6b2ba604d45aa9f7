"""Fixtures that the tests of the training-data operators share."""

from __future__ import annotations

import os
import random

import public_tokenizers
import pytest

TESTDATA = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

LONG = " ".join(f"word{i % 977} and {i}" for i in range(6000))
HARD_TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "one two three four",
    "One two three four five six seven eight nine ten",
    "one two three four five six seven eight nine TEN",
    "one two  three\nfour five six seven eight nine ten",
    "naïve café – résumé 日本語 😀 x́",
    "a  b 　c  d \x1c\x1d e\x85f",
    "<|endoftext|> x<|endoftext|>  y <|startoftext|>",
    "it's we'll I'D 12345 6,7 !!?? ...",
    "a" * 3000,
    LONG,
    LONG + " more",
]


def documents(spark, texts=None, **extra):
    """Documents with the given texts, in order; clashing extra columns are added."""
    texts = HARD_TEXTS if texts is None else texts
    rows = [(i, text, "en", "src", len(text or "")) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return with_clashes(df)


def with_clashes(df):
    """Columns with names that operators use inside."""
    from pyspark.sql import functions as F

    names = [
        "key", "band", "root", "row", "part", "kept", "n", "size", "shard", "range", "k1", "k2",
        "quality", "registers", "c0", "place", "mention", "group_size", "text_sha256", "n_words",
    ]
    return df.select("*", *[F.lit("clash").alias(name) for name in names])


def near_copies(n: int, edits: int, seed: int, length: int = 60) -> list[str]:
    """Copies of one random text with ``edits`` words replaced each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    result = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(length), rng.randrange(edits + 1)):
            words[at] = f"x{rng.randrange(10**6)}"
        result.append(" ".join(words))
    return result


def plain(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
