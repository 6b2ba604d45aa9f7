"""Language model scores and language identification."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import TESTDATA, documents, needs_tables, with_clashes
from tillroll.llm.language_id import _block, identify_languages, train_language_models, viterbi
from tillroll.llm.lm_scoring import STRENGTH, cross_entropy_difference
from tillroll.llm.queries import QUERIES

# ------------------------------------------------------------------------------ cross-entropy


def brute_force(docs, targets):
    """(tokens, target, background and corpus loss) per document, from the counts of the other documents."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in docs]
    pairs = [list(zip([None, *w], w)) for w in words]
    v = sum(map(len, words))

    def mean_loss(at, among, size=None):
        others = [j for j in among if j != at]
        n1 = Counter(w for j in others for w in words[j])
        n2 = Counter(p for j in others for p in pairs[j])
        before = Counter(n1)
        before[None] = sum(1 for j in others if words[j])
        n = sum(n1.values())
        k = 1.0 if size is None else size / max(n, 1)

        def p(a, b):
            alone = (k * n1[b] + STRENGTH / v) / (k * n + STRENGTH)
            return (k * n2[a, b] + STRENGTH * alone) / (k * before[a] + STRENGTH)

        return sum(-math.log2(p(*pair)) for pair in pairs[at]) / max(1, len(pairs[at]))

    result = []
    everyone, chosen = range(len(docs)), [j for j, (i, _) in enumerate(docs) if i in targets]
    for at, (i, _) in enumerate(docs):
        size = sum(len(words[j]) for j in chosen if j != at)
        background = mean_loss(at, everyone, size or None)
        target = mean_loss(at, chosen) if size else background
        result.append((i, len(words[at]), target, background, target - background, mean_loss(at, everyone)))
    return result


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def same_scores(got, want):
    assert len(got) == len(want)
    for g, w in zip(by_id(map(tuple, got)), by_id(want)):
        assert g[:2] == w[:2]
        assert g[2:] == pytest.approx(w[2:], abs=1e-5)


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_brute_force(spark, small):
    docs = [(1, "good text here good text"), (2, "BAD $$$ text"), (3, "good hére 日 here"), (4, None), (5, ""), (6, "\t\ngood")]
    docs += [(7, "BAD $$$ text"), (8, " \n"), (None, "good text"), (None, "other"), (9, "a " * 5000 + "b"), (2, "BAD $$$ text")]
    docs += [(i, " ".join(f"w{i * j % 37}" for j in range(i % 50))) for i in range(10, 60)]
    targets = [(1,), (3,), (3,), (None,), (77,), (9,), (20,), (31,), (44,)]
    ids = spark.createDataFrame(targets, "doc_id long")
    df = with_clashes(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    sizes = {"block_bytes": 300, "owner_bytes": 700} if small else {}
    got = cross_entropy_difference(df, ids, **sizes).collect()
    same_scores(got, brute_force(docs, {i for (i,) in targets if i is not None}))


@needs_tables
def test_query_equals_brute_force_on_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").collect()]
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet").where("quality = 1")
    got = QUERIES["op5_lm_score"](spark, TESTDATA).select(
        "doc_id", "n_tokens", "target_loss", "background_loss", "score", "corpus_loss"
    )
    same_scores(got.collect(), brute_force(docs, {r["doc_id"] for r in labels.collect()}))


def test_vocabulary_decides(spark):
    """Texts of the same letters are told apart by their words, and a copy is known by its pairs."""
    rng = random.Random(5)
    alike, other = ["tan", "net", "ten", "ant"], ["nat", "ent", "tne", "tna"]
    texts = [" ".join(rng.choice(alike if i % 2 else other) for _ in range(60)) for i in range(40)]
    rare = " ".join(f"r{rng.randrange(10**6)}" for _ in range(40))
    texts += [rare, rare, " ".join(f"r{rng.randrange(10**6)}" for _ in range(40))]
    ids = spark.createDataFrame([(i,) for i in range(1, 40, 4)], "doc_id long")
    rows = {r["doc_id"]: r for r in cross_entropy_difference(documents(spark, texts), ids).collect()}
    assert max(rows[i]["score"] for i in range(1, 40, 2)) < 0 < min(rows[i]["score"] for i in range(0, 40, 2))
    assert rows[40]["corpus_loss"] == rows[41]["corpus_loss"] < rows[42]["corpus_loss"] - 3


def test_no_target_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long")
    rows = cross_entropy_difference(documents(spark), none).collect()
    assert rows and all(r["score"] == 0 for r in rows)
    assert cross_entropy_difference(documents(spark, []), none).count() == 0


@needs_tables
def test_scores_tell_good_texts(spark):
    scores = QUERIES["op5_lm_score"](spark, TESTDATA).join(spark.read.parquet(f"{TESTDATA}/labels.parquet"), "doc_id")
    means = {r["quality"]: r["m"] for r in scores.groupBy("quality").agg({"score": "avg"}).toDF("quality", "m").collect()}
    assert means[1] < means[0] - 0.5


# -------------------------------------------------------------------------------- languages


def best_path(scores, switch):
    n, k = scores.shape
    best, paths = list(scores[0]), [[j] for j in range(k)]
    for t in range(1, n):
        step = []
        for j in range(k):
            costs = [best[i] - (switch if i != j else 0) for i in range(k)]
            at = max(range(k), key=lambda i: costs[i])
            step.append((costs[at] + scores[t, j], paths[at] + [j]))
        best, paths = [s for s, _ in step], [p for _, p in step]
    return max(best)


def path_value(scores, labels, switch):
    return scores[np.arange(len(labels)), labels].sum() - switch * (labels[1:] != labels[:-1]).sum()


def test_viterbi_is_optimal():
    rng = np.random.default_rng(0)
    sizes = [5, 0, 1, 17, 9, 0, 30]
    text = np.repeat(np.arange(len(sizes)), sizes)
    scores = rng.normal(size=(len(text), 4)) * 3
    for switch in (0.0, 1.5, 100.0):
        labels = viterbi(scores, text, len(sizes), switch)
        for i, size in enumerate(sizes):
            if size:
                own = scores[text == i]
                assert path_value(own, labels[text == i], switch) == pytest.approx(best_path(own, switch))


ENGLISH = "the house and the garden with the river that was there when they came "
GERMAN = "der garten und die straße mit dem fluss der dort war als sie nicht kamen "
RUSSIAN = "дом и сад у реки который был там когда они пришли "


def models(spark):
    rows = [(ENGLISH * 30, "en"), (GERMAN * 30, "de"), (RUSSIAN * 30, "ru"), (None, "en"), ("text", None)]
    return train_language_models(with_clashes(spark.createDataFrame(rows, "text string, lang string")))


def test_spans_of_mixed_texts(spark):
    mixed = ENGLISH + "\n" + GERMAN + "! " + RUSSIAN
    texts = [mixed, None, "", "123 ... 4", "ΑΒΓ δε", "İ" + ENGLISH.upper(), GERMAN * 2000]
    df = documents(spark, texts)
    rows = {r["doc_id"]: r for r in identify_languages(df, models(spark)).collect()}
    spans = rows[0]["spans"]
    assert [s["lang"] for s in spans] == ["en", "de", "ru"]
    cut = [mixed[s["start"] : s["start"] + s["length"]] for s in spans]
    assert cut == [ENGLISH.strip(), GERMAN.strip(), RUSSIAN.strip()]
    assert 0 < rows[0]["score"] < 1
    for i in (1, 2, 3):
        assert (rows[i]["lang_pred"], rows[i]["score"], rows[i]["spans"]) == ("und", 0.0, [])
    assert rows[4]["lang_pred"] in ("en", "de", "ru") and rows[4]["score"] == 0.0
    assert rows[5]["lang_pred"] == "en"
    assert rows[6]["lang_pred"] == "de" and len(rows[6]["spans"]) == 1


def test_marks_without_a_letter_are_no_text(spark):
    texts = ["\u0301", "12 \u0301\u0302 - 7", "\u0301 " + ENGLISH, ENGLISH.replace("house", "hou\u0301se")]
    rows = {r["doc_id"]: r for r in identify_languages(documents(spark, texts), models(spark)).collect()}
    assert [(rows[i]["lang_pred"], rows[i]["score"]) for i in (0, 1)] == [("und", 0.0)] * 2
    assert [rows[i]["lang_pred"] for i in (2, 3)] == ["en", "en"]
    assert rows[2]["spans"][0]["start"] == 2


def test_without_training_rows(spark):
    empty = train_language_models(documents(spark, []))
    assert {r["lang_pred"] for r in identify_languages(documents(spark), empty).collect()} == {"und"}
    assert identify_languages(documents(spark, []), empty).count() == 0


def test_words_do_not_see_each_other():
    alone, together = _block([b"abc"]), _block([b"xyz, abc"])
    assert together.triples[together.bounds[1] :].tolist() == alone.triples.tolist()


@needs_tables
def test_held_out_accuracy(spark):
    found = QUERIES["op7_language_id"](spark, TESTDATA).where("held_out")
    rows = found.join(spark.read.parquet(f"{TESTDATA}/documents.parquet"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 20
