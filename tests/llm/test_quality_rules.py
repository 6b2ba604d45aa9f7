import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import HARD_TEXTS, TESTDATA, documents, near_copies, needs_tables
from tillroll.llm.quality_rules import js_distance, language_references, quality_rules

TEXTS = [
    *HARD_TEXTS,
    "same line here\nsame line here\n\n \nSame line here\nsame line here",
    "a b c a b c a b c a b",
    "a a a a",
    "# * $ % & | < > é# ##",
    "x y z\tx y\nz",
]


def expected(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, seen = 0, set()
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            lines += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, lines, len(covered), failed


def judged(docs, **options):
    out, name = quality_rules(docs, ["doc_id"], **options)
    return {r["doc_id"]: r[name] for r in out.collect()}


def test_counts_equal_brute_force(spark):
    got = judged(documents(spark, TEXTS))
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        q = got[i]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"], q["base_failed"]) == expected(text)
        assert not (q["base_failed"] and q["kept"])


COMMON = "the of and to in that it is was for on with as by at from".split()


def prose(seed):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(COMMON) if rng.random() < 0.6 else f"{'abcdefgh'[rng.integers(8)] * 2}{'xyzuvw'[rng.integers(6)]}o" for _ in range(300))


def test_divergent_texts_go_and_clean_ones_stay(spark):
    clean = [prose(i) for i in range(40)]
    symbols = " ".join(w + "%%%" for w in prose(99).split())
    odd = [symbols, prose(98).upper(), near_copies(1, 0, 5, length=300)[0]]
    got = judged(documents(spark, [*clean, *odd, clean[0]]))
    assert all(got[i]["kept"] for i in range(40))
    assert not any(got[40 + i]["kept"] for i in range(3))
    assert got[43] == got[0]


COMMON_OF = {"en": COMMON, "fr": "le de la et les des un une que dans est pour qui sur pas au par il".split()}


def written(lang, seed, n=300, share=0.4):
    """A text of its language's common words and of invented ones."""
    rng = np.random.default_rng(seed)
    invented = ("".join(rng.choice(list("aeioubcdfglmnprst"), size=7)) for _ in range(n))
    return " ".join(rng.choice(COMMON_OF[lang]) if rng.random() < share else w for w in invented)


def in_languages(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")


def test_other_languages_and_invented_words_go(spark):
    clean = [(written(lang, i, n), lang) for lang in COMMON_OF for i, n in enumerate([60, 100, 300, 1000, 3000])]
    wrong = [(written("fr", 50, n), "en") for n in (60, 300, 3000)] + [(written("en", 51, n), "fr") for n in (60, 300, 3000)]
    wrong += [(written("en", 52, n, share=0), lang) for lang in COMMON_OF for n in (60, 300, 9000)]
    known = language_references(in_languages(spark, [(written(lang, 100 + i), lang) for lang in COMMON_OF for i in range(30)]))
    got = judged(in_languages(spark, clean + wrong), references=known)
    assert [got[i]["kept"] for i in range(len(got))] == [True] * len(clean) + [False] * len(wrong)


def test_languages_without_a_reference_are_left_to_the_base_rules(spark):
    rng = np.random.default_rng(7)
    russian = " ".join("".join(rng.choice(list("абвгдежиклмнопрст"), size=6)) for _ in range(300))
    known = [(written(lang, 100 + i), lang) for lang in COMMON_OF for i in range(30)]
    odd = [(russian, "ru"), (russian, None), (written("fr", 60), None), (written("fr", 60).replace(" ", "%%% %%% "), "fr")]
    got = judged(in_languages(spark, odd + known))
    assert [got[i]["kept"] for i in range(4)] == [True, True, True, False]
    assert got[0]["word_distance"] == got[1]["word_distance"] == 0 < got[2]["word_distance"]


def test_without_languages_the_base_rules_decide(spark):
    docs = documents(spark, TEXTS + [prose(1)]).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert language_references(docs).languages == []
    got = judged(docs)
    assert all(q["kept"] != q["base_failed"] for q in got.values())
    known = language_references(documents(spark, [prose(i) for i in range(20)]))
    assert judged(docs, references=known)[len(TEXTS)]["kept"]


def test_columns_with_any_name_are_kept(spark):
    docs = documents(spark)
    out, name = quality_rules(docs, docs.columns)
    assert name not in docs.columns
    assert sorted(map(repr, out.select(docs.columns).collect())) == sorted(map(repr, docs.collect()))
    assert quality_rules(documents(spark, []), ["doc_id"])[0].count() == 0


@pytest.mark.parametrize("left, right, want", [([1, 0], [1, 0], 0), ([1, 0], [0, 1], 1), ([0.5, 0.5], [1, 0], 0.5579)])
def test_distance(left, right, want):
    assert js_distance(np.array(left), np.array(right)) == pytest.approx(want, abs=1e-4)


# ---------------------------------------------------------------------- the verdict, worked out plainly


def plain_js(left, right):
    total = 0.0
    for a, b in zip(left, right):
        for x in (a, b):
            if x > 0:
                total += x * math.log2(x / ((a + b) / 2)) / 2
    return math.sqrt(min(max(total, 0), 1))


def plain_classes(text):
    counts = [0] * 8
    for c in text:
        at = (
            3 if c in " \t\n\v\f\r" else 6 if ord(c) > 127 else 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z"
            else 2 if "0" <= c <= "9" else 4 if c in ".,;:!?'\"()-" else 5 if 33 <= ord(c) < 127 else 7
        )
        counts[at] += 1
    return counts


def plain_verdicts(rows):
    """(kept, class distance, word distance) per row of (text, lang), against references from all rows."""
    words_of = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for text, _ in rows]
    refs = {}
    for lang in {lang for _, lang in rows if lang is not None}:
        own = [i for i, (_, other) in enumerate(rows) if other == lang]
        count = Counter(w for i in own for w in words_of[i])
        total = sum(count.values())
        if total >= 2000:
            top = sorted(count, key=lambda w: (-count[w], w.encode()))[:100]
            classes = [sum(x) for x in zip(*(plain_classes(rows[i][0] or "") for i in own))]
            shares = [count[w] / total for w in top] + [0.0] * (100 - len(top))
            refs[lang] = ([c / max(sum(classes), 1) for c in classes], top, [*shares, 1 - sum(shares)])
    result = []
    for (text, lang), words in zip(rows, words_of):
        n, classes = len(words), plain_classes(text or "")
        chance = 1 / math.sqrt(max(n, 1))
        found, share, far = {}, {}, {}
        for name, (of_class, top, of_word) in refs.items():
            place = {w: k for k, w in enumerate(top)}
            histogram = [0] * 101
            for w in words:
                histogram[place.get(w, 100)] += 1
            by_word = plain_js([h / max(n, 1) for h in histogram], of_word)
            by_class = plain_js([c / max(sum(classes), 1) for c in classes], of_class)
            found[name] = (by_class, by_word)
            usual = 1 - of_word[-1]
            share[name] = sum(w in place for w in words) / max(n, 1)
            low = min(share[name], usual)
            far[name] = plain_js([low, 1 - low], [usual, 1 - usual]), 0.5 * plain_js([0, 1], [usual, 1 - usual])
        asked = [lang] if lang in refs else [k for k in refs if lang is None and far[k][0] <= far[k][1]]
        by_class, by_word = min((found[k] for k in sorted(asked)), key=sum, default=(0.0, 0.0))
        fits = by_class <= 0.25 + 0.4 * chance and (n < 100 or by_word <= 0.44 + 0.5 * chance)
        if lang in refs:
            foreign = any(share[k] > share[lang] + chance and far[k][0] <= far[k][1] for k in refs)
            fits = fits and far[lang][0] <= far[lang][1] + chance and not foreign
        base_failed = expected(text)[5]
        result.append((fits and not base_failed, by_class, by_word))
    return result


def compare_verdicts(spark, rows):
    got = judged(in_languages(spark, rows))
    want = plain_verdicts(rows)
    for i, (kept, by_class, by_word) in enumerate(want):
        assert got[i]["kept"] == kept, rows[i][0][:80]
        assert got[i]["class_distance"] == pytest.approx(by_class, abs=1e-9)
        assert got[i]["word_distance"] == pytest.approx(by_word, abs=1e-9)
    return want


def test_verdicts_equal_a_plain_version(spark):
    rows = [(written(lang, i, n), lang) for lang in COMMON_OF for i, n in enumerate([40, 60, 99, 100, 101, 300, 1000])]
    rows += [(t, lang) for t, _ in rows[:6] for lang in (None, "fr", "xx")]
    rows += [(t, lang) for t in TEXTS for lang in ("en", None)]
    rows += [(" ".join(["$$$ %%% a B 9"] * 30), "en"), (written("en", 9, 200, share=0), None)]
    rows += [(written(lang, 100 + i), lang) for lang in COMMON_OF for i in range(12)]
    want = compare_verdicts(spark, rows)
    assert 10 < sum(kept for kept, _, _ in want) < len(rows) - 10


@needs_tables
def test_verdicts_of_a_whole_table_equal_a_plain_version(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()
    compare_verdicts(spark, [(r["text"], r["lang"]) for r in docs])


def test_short_texts_are_not_compared_by_common_words(spark):
    rng = np.random.default_rng(3)
    known = language_references(in_languages(spark, [(written("en", 100 + i), "en") for i in range(30)]))

    def one_word(n):  # the usual share of common words, but always the same one
        return " ".join("the" if rng.random() < 0.4 else f"w{rng.integers(10**9)}" for _ in range(n))

    got = judged(in_languages(spark, [(one_word(99), "en"), (one_word(400), "en")]), references=known)
    assert [got[i]["word_distance"] > 0.44 + 0.5 / math.sqrt(n) for i, n in enumerate((99, 400))] == [True, True]
    assert not got[1]["kept"]


def test_only_the_largest_languages_get_a_reference(spark):
    rows = [(written("en", i), lang) for i in range(24) for lang in (["a"] * 2 + ["b"])] + [("x y", f"junk{i}") for i in range(50)]
    docs = in_languages(spark, rows)
    assert language_references(docs).languages == ["a", "b"]
    assert language_references(docs, most_languages=1).languages == ["a"]
