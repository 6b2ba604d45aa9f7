"""The pipeline against the operators' brute-force versions, stage by stage on small tables."""

import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import TESTDATA, WORDS, documents, near_copies, needs_tables
from tests.llm.test_exact_dedup import expected as exact_groups
from tests.llm.test_near_dedup import expected as near_groups
from tests.llm.test_quality_rules import expected as quality_counts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def run_stages(spark, docs):
    """Documents before the first stage and after each."""
    states = [docs]
    for _, stage in corpus_pipeline.STAGES:
        states.append(corpus_pipeline.staged(stage(spark, states[-1], TESTDATA), "test"))
    return states


@needs_tables
def test_stages_on_a_whole_table(spark):
    start, clean, single, apart, hidden, packed = run_stages(spark, spark.read.parquet(f"{TESTDATA}/documents.parquet"))
    for df in (clean, single, apart, hidden):
        assert df.columns == COLUMNS and df.dtypes == start.dtypes
    before, after = rows_of(start), rows_of(clean)
    assert all(not quality_counts(r["text"])[5] for r in after.values())
    gone = [r for i, r in before.items() if i not in after and not quality_counts(r["text"])[5]]
    assert 0 < len(after) < len(before) and all(re.search(r"[%$#*&|]|!!", r["text"]) for r in gone)
    texts = [(i, r["text"]) for i, r in after.items()]
    assert set(rows_of(single)) == {g[0] for g in exact_groups(texts) if g[3]}
    texts = [(i, r["text"]) for i, r in rows_of(single).items()]
    assert set(rows_of(apart)) == {g[0] for g in near_groups(texts) if g[3]}
    old, new = rows_of(apart), rows_of(hidden)
    assert set(old) == set(new) and any(old[i]["text"] != new[i]["text"] for i in old)
    assert all(r["n_chars"] == len(r["text"]) for r in new.values())
    library, lengths = Tokenizer.from_file(WORDS), {}
    for r in packed.collect():
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {i: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in new.items()}


def test_nulls_and_repeated_rows(spark):
    base = near_copies(1, 0, 2, length=200)[0]
    words = [*near_copies(3, 0, 1, length=80), base + " and more", base]
    docs = documents(spark, [*words, None, ""]).select(COLUMNS)
    twice = docs.unionByName(docs.where("doc_id < 2")).unionByName(docs.where("doc_id = 3").selectExpr("NULL AS doc_id", "text", "lang", "source", "n_chars"))
    states = run_stages(spark, twice.withColumn("kept", corpus_pipeline.F.lit("clash")))
    ids = [sorted((r["doc_id"] for r in s.collect()), key=repr) for s in states[1:5]]
    assert ids[0] == sorted([0, 0, 1, 1, 2, 3, 4, None], key=repr)
    assert ids[1] == sorted([0, 3, 4, None], key=repr)
    assert ids[2] == ids[3] == sorted([0, 3, None], key=repr)
    assert states[5].select("doc_id").distinct().count() == 3


LONGER = " ".join(f"word{i}" for i in range(80))
OTHER = " ".join(f"other{i}" for i in range(80))


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, "foo one"), (1, "bar two"), (2, "baz")], [(1, "bar two"), (1, "foo one"), (2, "baz")]),
        ([(0, "foo one"), (1, "foo one"), (1, "bar two")], [(0, "foo one"), (1, "bar two")]),
        ([(1, "a b"), (1, "a b"), (1, "a  b"), (1, None), (None, "a b")], [(1, None), (1, "a  b"), (None, "a b")]),
    ],
)
def test_exact_copies_by_id_and_text(spark, rows, want):
    docs = documents(spark, []).select(COLUMNS).unionByName(
        spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    )
    out = corpus_pipeline.drop_copies(spark, docs, TESTDATA)
    assert out.columns == COLUMNS
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_near_copies_by_id_and_text(spark):
    rows = [(0, LONGER), (1, LONGER + " more"), (1, OTHER), (1, OTHER), (2, "short one"), (2, "another short one")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_copies(spark, docs, TESTDATA).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == sorted([(0, LONGER), (1, OTHER), *rows[4:]])


def test_empty_documents(spark):
    assert [s.count() for s in run_stages(spark, documents(spark, []).select(COLUMNS))] == [0] * 6


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_signature(name, stage):
    assert isinstance(name, str) and stage.__code__.co_varnames[:3] == ("spark", "docs", "sf_dir")
