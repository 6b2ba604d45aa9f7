import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import BYTES, HARD_TEXTS, documents
from tillroll.llm import bpe

LIBRARY = Tokenizer.from_file(BYTES)


def coded(texts):
    words_of = bpe.find_words([t.encode() for t in texts])
    starts, ends, text = bpe.split_marks(words_of.data, *bpe._chunk_ranges(words_of))
    ids, sizes = bpe._coder(BYTES)[1](words_of.data, words_of.raw, starts, ends)
    return bpe._lists(ids, sizes, text, len(texts)).to_pylist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list(" \t\n\r\x0b\x1c\x85  　ab'sté,.!1²日<|>😀")), max_size=30), min_size=1, max_size=4))
def test_ids_are_those_of_the_library(texts):
    assert coded(texts) == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_whole_table(spark):
    rows = bpe.decode(bpe.encode(documents(spark), BYTES), BYTES).collect()
    assert len(rows) == len(HARD_TEXTS)
    for row in rows:
        text = HARD_TEXTS[row["doc_id"]] or ""
        assert row["ids"] == LIBRARY.encode(text, add_special_tokens=False).ids
        assert row["decoded"] == LIBRARY.decode(row["ids"], skip_special_tokens=False) == text


def test_ids_without_valid_text(spark):
    rows = [(1, [197, 50256, 999999, -4]), (2, []), (3, None), (4, [220, 128, 250])]
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(spark.createDataFrame(rows, "doc_id int, ids array<int>"), BYTES).collect()}
    assert got[1] == LIBRARY.decode([197, 50256], skip_special_tokens=False)
    assert got[2] == got[3] == ""
    assert got[4] == LIBRARY.decode([220, 128, 250], skip_special_tokens=False)


def test_null_ids_and_empty_tables(spark):
    assert bpe.decode(bpe.encode(documents(spark, []), BYTES), BYTES).count() == 0
    df = spark.createDataFrame([(None, "x"), (None, "x")], "doc_id string, text string")
    assert [r["doc_id"] for r in bpe.encode(df, BYTES).collect()] == [None, None]


def test_repeated_pairs_merge_from_left_to_right():
    coder = bpe.ByteBpe(BYTES)
    pieces = [b"a" * n for n in range(1, 40)]
    flat, bounds = coder.merge_pieces(pieces)
    for piece, i, j in zip(pieces, bounds[:-1], bounds[1:]):
        assert flat[i:j].tolist() == LIBRARY.encode(piece.decode(), add_special_tokens=False).ids


def test_cache_is_bounded():
    from tillroll.llm.chunks import ChunkCoder
    from tillroll.llm.words import find_words

    def lengths(chunks):
        return np.array([len(c) for c in chunks]), np.ones(len(chunks), dtype=np.int64)

    coder = ChunkCoder(lengths, limit=10)
    for start in range(0, 60, 6):
        words = find_words([" ".join("x" * (k + 1) for k in range(start, start + 6)).encode()])
        ids, _ = coder(words.data, words.raw, words.starts, words.ends)
        assert ids.tolist() == [k + 1 for k in range(start, start + 6)]
        assert len(coder) <= 10


@pytest.mark.parametrize("text", ["a  b", "a　　 b", "  ", "x    y"])
def test_white_space_outside_ascii(text):
    assert coded([text]) == [LIBRARY.encode(text, add_special_tokens=False).ids]
