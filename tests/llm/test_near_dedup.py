import random
import re
from itertools import combinations

import numpy as np
import pytest

from tests.llm.helpers import documents, near_copies, plain, with_clashes
from tillroll.llm import near_dedup
from tillroll.llm.components import connected_components
from tillroll.llm.near_dedup import estimated_jaccard, near_duplicates, registers, shingles

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(UPPER)) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def roots_of(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    known = [(i, s) for i, s in sets if i is not None]
    edges = [
        (a, b) for (a, s), (b, t) in combinations(known, 2) if s and t and 100 * len(s & t) >= 75 * len(s | t)
    ]
    root = roots_of({i for i, _ in known}, edges)
    return sorted(((i, len(s), root.get(i), root.get(i) == i) for i, s in sets), key=repr)


def run(spark, rows, **options):
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    return plain(near_duplicates(df, **options))


def test_hard_texts(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert plain(near_duplicates(docs)) == expected(rows)


def test_empty_table_null_ids_and_repeated_rows(spark):
    assert run(spark, []) == []
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, None), (4, None)]
    got = run(spark, rows)
    assert got == expected(rows)[: len(rows)] or sorted(got, key=repr) == [
        *sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (None, 2, None, True)], key=repr)
    ]


@pytest.mark.parametrize("block_rows", [8, 1024])
def test_group_whose_members_link_in_part(spark, block_rows):
    """A loose group: some members are linked, others only similar; blocks of any size agree."""
    texts = near_copies(150, 7, seed=1) + near_copies(60, 3, seed=2, length=12) + near_copies(40, 14, seed=3, length=200)
    texts += [" ".join(f"u{i}_{k}" for k in range(30)) for i in range(20)]
    random.Random(4).shuffle(texts)
    rows = list(enumerate(texts, start=100))
    want = expected(rows)
    assert len({r[2] for r in want}) > 25
    assert run(spark, rows, block_rows=block_rows) == want


def test_estimates_are_near_the_truth():
    rng = random.Random(7)
    for size, share in [(40, 0.75), (400, 0.8), (4000, 0.5), (9, 0.8), (2000, 0.0)]:
        errors = []
        for _ in range(12):
            pool = [f"{rng.random()}" for _ in range(2 * size)]
            common = int(2 * size * share / (1 + share))
            one, two = pool[:size], pool[size - common : 2 * size - common]
            values, owner = shingles([" ".join(one).encode(), " ".join(two).encode()])
            sets = [set(values[owner == k].tolist()) for k in (0, 1)]
            table = registers(values, owner, 2)
            sizes = [np.array([len(s)]) for s in sets]
            truth = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
            errors.append(estimated_jaccard(table[:1], table[1:], *sizes)[0] - truth)
        assert abs(np.mean(errors)) < 0.06 and max(map(abs, errors)) < near_dedup.MARGIN + 0.05


def test_registers_do_not_depend_on_neighbours():
    texts = [b"a b c d e f", b"", b"x " * 900, b"one two"]
    values, owner = shingles(texts)
    together = registers(values, owner, len(texts))
    for i, text in enumerate(texts):
        v, o = shingles([text])
        assert (registers(v, o, 1)[0] == together[i]).all()


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(500, 530)]
    star = [(900, i) for i in range(901, 1100)]
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + chain + star + [(7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges + [(None, 3)], "a long, b long"), "a", "b").collect()}
    want = roots_of({n for e in edges for n in e}, edges)
    assert got == {n: r for n, r in want.items() if n != r}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
