import zlib

import pytest

from tests.llm.helpers import HARD_TEXTS, documents, with_clashes
from tillroll.llm.sharding import shard_by_bytes


def check(rows, texts, shards, slack):
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode()) + 1 for t in texts)
    assert sorted(r["text_crc32"] for r in rows) == sorted(zlib.crc32((t or "").encode()) for t in texts)
    total, by_shard = sum(r["size"] for r in rows), {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    for shard, own in by_shard.items():
        assert 0 <= shard < shards
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= slack


TEXTS = [f"text number {i} " * (1 + i % 40) for i in range(2000)]
HOT = ["hot text " * 30] * 900


@pytest.mark.parametrize("max_rows", [100, 1_000_000])
@pytest.mark.parametrize("texts", [TEXTS, TEXTS + HOT, HOT], ids=["mixed", "a third in one group", "one group"])
def test_near_equal_sizes(spark, texts, max_rows):
    df = with_clashes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    rows = shard_by_bytes(df, shards=16, fan_out=4, max_range_rows=max_rows).collect()
    total = sum(r["size"] for r in rows)
    check(rows, texts, 16, 0.02 * total / 16 + 2 * max(len(t) for t in texts))
    shards_of = {}
    for r in rows:
        shards_of.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for crc, s in shards_of.items() if crc != zlib.crc32(HOT[0].encode()))


def test_hard_texts_nulls_and_repeated_rows(spark):
    rows = shard_by_bytes(documents(spark), shards=3).collect()
    check(rows, HARD_TEXTS, 3, 2 * max(len((t or "").encode()) for t in HARD_TEXTS))
    same = [(None, "x"), (1, "x"), (1, "x"), (None, None), (None, None)]
    rows = shard_by_bytes(spark.createDataFrame(same, "doc_id long, text string"), shards=2).collect()
    check(rows, [t for _, t in same], 2, 3)
    assert shard_by_bytes(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    assert "Python" not in shard_by_bytes(documents(spark))._jdf.queryExecution().toString()
