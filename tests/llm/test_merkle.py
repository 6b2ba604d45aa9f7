"""The manifest against a tree that is hashed plainly, in one piece."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, with_clashes
from tillroll.llm.merkle import fold_path, merkle_manifest, path_digest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return digest(*fields)


def tree(leaves):
    """The root, and per leaf the siblings on its way, level by level."""
    nodes, at, siblings = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            first = i - i % 3
            siblings[leaf] += [nodes[k] for k in range(first, min(first + 3, len(nodes))) if k != i]
            at[leaf] = i // 3
        nodes = [digest(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], siblings


def expected(rows):
    """(doc_id, leaf, subroot, root, proof) per row of (doc_id, source, lang, n_chars, text)."""
    of_source = {}
    for row in rows:
        of_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row[0]))
    sources = sorted(of_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf for _, _, leaf, _ in sorted(of_source[s], key=lambda r: r[:3])]) for s in sources}
    root, above = tree([trees[s][0] for s in sources]) if sources else (None, [])
    result = []
    for s, upper in zip(sources, above):
        subroot, below = trees[s]
        for (_, _, leaf, doc_id), lower in zip(sorted(of_source[s], key=lambda r: r[:3]), below):
            result.append((doc_id, leaf, subroot, root, digest(*lower, *upper)))
    return sorted(result, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
ODD = [
    (None, None, None, None, None),
    (None, None, None, None, None),
    (1, "", "", 0, ""),
    (2, "ü", "de", 3, "a\nb"),
    (2, "ü", "de", 3, "a\nb"),
    (2, "ü", "de", 4, "a\nc"),
    (-5, "z", "en", 1, "x" * 100_000),
    (3, "z", None, 1, "-"),
]


def many(n, hot=0.0, sources=1):
    return [(i * 7 % n, "hot" if i < hot * n else f"s{i % sources}", "en", i, f"text {i}") for i in range(n)]


# Rows and the number of levels in a block.
CASES = [
    ([], 1),
    (ODD[2:3], 0),
    (ODD, 1),
    (many(10), 0),
    (many(82), 0),
    (many(250), 1),
    (many(250), 7),
    (many(120, 0.4, 17), 1),
    (many(60, 0, 60), 2),
]


def listed(df, **options):
    out = merkle_manifest(df, **options)
    rows = out.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")), fold_path(F.col("leaf"), F.col("path")))
    found = [tuple(r) for r in rows.collect()]
    assert all(r[5] == r[3] for r in found)
    return sorted((r[:5] for r in found), key=repr)


@pytest.mark.parametrize("rows, levels", CASES)
def test_equals_a_plain_tree(spark, rows, levels):
    df = with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert listed(df, block_levels=levels) == expected(rows)


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    out = merkle_manifest(documents(spark), keep=["doc_id", "kept"], block_levels=1)
    assert out.columns == ["doc_id", "kept", "leaf", "path", "subroot", "root"]
    other = fold_path(F.sha2(F.col("leaf"), 256), F.col("path"))
    assert out.where(other == F.col("root")).isEmpty()
