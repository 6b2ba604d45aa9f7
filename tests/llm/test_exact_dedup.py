import hashlib
import re

import numpy as np
import pytest

from tests.llm.helpers import documents, plain, with_clashes
from tillroll.llm import golomb
from tillroll.llm.exact_dedup import exact_duplicates


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        text = text or ""
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text), []).append((-len(text), doc_id is None, doc_id))
    result = []
    for bare, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        for size, _, doc_id in members:
            kept = doc_id == best[2] and size == best[0]
            result.append((doc_id, best[2], len(members), kept, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(result, key=repr)


CASES = [
    [],
    [(1, None)],
    [(3, "a b"), (1, "ab"), (2, "a  b"), (4, None), (5, ""), (6, " \t\n"), (7, "a b"), (8, "A b")],
    [(2, "x y"), (1, "xy "), (None, "x y "), (None, "zz")],
    [(4, "same"), (4, "same"), (9, "same")],
    [(i, f"text {i % 7} " + "long " * (i % 3) * 4000) for i in range(60)],
]


@pytest.mark.parametrize("rows", CASES)
@pytest.mark.parametrize("owners", [1, 5])
def test_groups(spark, rows, owners):
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert plain(exact_duplicates(df, owners=owners)) == expected(rows)


def test_a_full_filter_changes_nothing(spark):
    docs = documents(spark)
    assert plain(exact_duplicates(docs, filter_bytes=8)) == plain(exact_duplicates(docs))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000])
@pytest.mark.parametrize("top", [5000, 2**40, 2**64 - 1])
def test_golomb_codes_come_back(n, top):
    values = np.unique(np.random.default_rng(n).integers(0, top, size=n, dtype=np.uint64, endpoint=True))
    blob = golomb.encode(values)
    assert golomb.decode(blob).tolist() == values.tolist()
    if n == 1000 and top > 2**60:
        assert len(blob) < 0.95 * values.nbytes
