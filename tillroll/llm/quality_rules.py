"""Quality rules: counts per document, then divergence from language references.

The base rules count words, symbols, repeated lines and repeated word windows. For the verdict, the
histogram of character classes and that of a language's commonest words (with one bin for all other
words) are compared with the same histograms of all documents of that language, by Jensen-Shannon
distance (0: equal, 1: disjoint). The share of common words alone, which chance moves far less than
the histogram, has a limit per language: half the distance of a text without any of them. A text
whose share in another language is clearly higher, and normal there, is in that language and not in its own.

A document of fewer than ``LEAST_COMPARED`` words is judged without the histogram of common words, which says
nothing of so few; its classes and its share of common words count, with an allowance for its length.

References are counts over all documents, added up in each task before they are shuffled. Only the
``COMMON_WORDS`` commonest words and the class counts of ``MOST_LANGUAGES`` languages at most go through the
driver.

Defined cases: a NULL text is empty and fails the base rules; where a document's language has too
little text for a reference, or is not among the ``MOST_LANGUAGES`` largest, the base rules decide (distances of 0); a document whose language is NULL is
compared with the nearest of the references whose usual share of common words it has, and without
one the base rules decide; repeated rows are judged alike; an empty table gives no rows; other
columns are kept if asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.memory import tidied
from tillroll.llm.staging import staged
from tillroll.llm.words import (
    SMALL_BLOCK,
    SPACE,
    Words,
    find_words,
    hash_ranges,
    mix,
    text_blocks,
    window_hashes,
    word_hashes,
)

COMMON_WORDS = 100
LEAST_REFERENCE_WORDS = 2000
MOST_LANGUAGES = 500
# The histogram of common words of a shorter document says nothing.
LEAST_COMPARED = 100
# What a task counts at a time.
DISTINCT_WORDS = 200_000
LEAST_WORDS, MOST_REPEATED = 50, 50
# The largest distance of a document that is kept is a limit for long texts plus an allowance for
# chance, divided by the square root of the number of words.
MOST_CLASS_DISTANCE, CLASS_ALLOWANCE = 0.25, 0.4
MOST_WORD_DISTANCE, WORD_ALLOWANCE = 0.44, 0.5
# Part of the distance of a text without common words that is allowed, and the allowance for chance:
# two and a half standard deviations of the distance, and two or more of the difference of two shares.
MOST_SHARE, SHARE_ALLOWANCE = 0.5, 1.0

SYMBOLS = b"#*$%&|<>"
_LOWER, _UPPER, _DIGIT, _SPACE, _MARK, _SIGN, _WIDE, _OTHER, _INNER = range(9)
N_CLASSES = 8


def _classes() -> np.ndarray:
    """The class of each byte; bytes within a character count as nothing."""
    table = np.full(256, _OTHER, dtype=np.int64)
    table[33:127] = _SIGN
    table[list(b".,;:!?'\"()-")] = _MARK
    table[ord("a") : ord("z") + 1] = _LOWER
    table[ord("A") : ord("Z") + 1] = _UPPER
    table[ord("0") : ord("9") + 1] = _DIGIT
    table[SPACE] = _SPACE
    table[0x80:0xC0] = _INNER
    table[0xC0:] = _WIDE
    return table


_CLASS = _classes()
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


@dataclass
class References:
    """Per language: shares of character classes and of common words, the last bin for all others."""

    languages: list[str]
    classes: np.ndarray
    words: np.ndarray
    hashes: np.ndarray  # of all common words, sorted
    bins: np.ndarray  # per language and entry of ``hashes``, the word's bin


def class_counts(words: Words) -> np.ndarray:
    """Characters of each class per text."""
    n = len(words.text_starts)
    text = np.repeat(np.arange(n), words.text_ends - words.text_starts + 1)
    kind = _CLASS[words.data[: len(text)]]
    counts = np.bincount(text * 9 + kind, minlength=n * 9).reshape(n, 9)[:, :N_CLASSES]
    counts[:, _SPACE] -= 1  # the line feed between texts
    return counts


def _symbols(words: Words) -> np.ndarray:
    at = np.flatnonzero(_IS_SYMBOL[words.data[: len(words.raw)]])
    text = np.searchsorted(words.text_starts, at, side="right") - 1
    return np.bincount(text, minlength=len(words.text_starts))


def _repeats(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The number of times that each hash occurs in its text, per position."""
    keys = mix(hashes ^ mix(text.astype(np.uint64)))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse]


def repeated_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Words per text that lie in a window of three words which occurs twice or more in it."""
    windows, at = window_hashes(hashes, words.text, 3)
    marked = np.zeros(len(words), dtype=bool)
    if len(at):
        again = at[_repeats(windows, words.text[at]) > 1]
        for k in range(3):
            marked[again + k] = True
    return np.bincount(words.text[marked], minlength=len(words.text_starts))


def repeated_lines(words: Words) -> np.ndarray:
    """Lines per text that have a word and equal an earlier line."""
    n = len(words.text_starts)
    feeds = np.flatnonzero(words.data[: len(words.raw)] == 10)
    starts = np.concatenate([[0], feeds + 1])
    ends = np.append(feeds, len(words.raw))
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    text = np.searchsorted(words.text_starts, starts, side="right") - 1
    keys = mix(hash_ranges(words.data, words.raw, starts, ends) ^ mix(text.astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    return np.bincount(text, minlength=n) - np.bincount(text[first], minlength=n)


def js_distance(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of distributions along the last axis, between 0 and 1."""

    def part(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / mean), 0.0).sum(axis=-1)

    mean = (left + right) / 2
    return np.sqrt(np.clip((part(left, mean) + part(right, mean)) / 2, 0, 1))


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1)


# --------------------------------------------------------------------------------- references


class _WordCounts:
    """Counts per language and word, for so many distinct ones at a time."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self._keys = np.empty(0, dtype=np.uint64)
        self._counts = np.empty(0, dtype=np.int64)
        self._names: list[tuple[str, bytes]] = []
        self._rows = np.empty(0, dtype=np.int64)  # of ``_names``, per key

    def __len__(self) -> int:
        return len(self._keys)

    def add(self, words: Words, hashes: np.ndarray, languages: list[str]) -> None:
        """Count the words of texts in the given languages."""
        names = sorted(set(languages))
        number = {lang: i for i, lang in enumerate(names)}
        salts = mix(hash_ranges(*_packed([lang.encode() for lang in names])))  # no word's own hash
        own = np.array([number[lang] for lang in languages], dtype=np.int32)[words.text]
        keys, first, counts = np.unique(mix(hashes ^ salts[own]), return_index=True, return_counts=True)
        at = np.searchsorted(self._keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = at < len(self._keys)
        known[inside] = self._keys[at[inside]] == keys[inside]
        self._counts[at[known]] += counts[known]
        fresh, new = first[~known], ~known
        rows = len(self._names) + np.arange(len(fresh))
        starts, ends = words.starts[fresh].tolist(), words.ends[fresh].tolist()
        self._names += [(names[k], words.raw[s:e]) for k, s, e in zip(own[fresh].tolist(), starts, ends)]
        self._keys = np.insert(self._keys, at[new], keys[new])
        self._counts = np.insert(self._counts, at[new], counts[new])
        self._rows = np.insert(self._rows, at[new], rows)

    def take(self) -> pa.RecordBatch:
        """All counts so far as rows, which are then forgotten."""
        langs, words = zip(*self._names) if self._names else ([], [])
        counts = np.empty(len(self), dtype=np.int64)
        counts[self._rows] = self._counts
        self._clear()
        columns = [pa.array(langs, pa.string()), pa.nulls(len(counts), pa.int32())]
        return _counted(*columns, pa.array(words, pa.binary()), pa.array(counts))


def _packed(values: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray]:
    """Byte strings as one buffer and their ranges in it."""
    raw = b"".join(values)
    ends = np.cumsum([len(v) for v in values])
    return np.frombuffer(raw + bytes(80), dtype=np.uint8), raw, ends - [len(v) for v in values], ends


_COUNTED = "lang string, class int, word binary, n long"


def _counted(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=[field.split()[0] for field in _COUNTED.split(", ")])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Characters per language and class (``word`` NULL) and words per language (``class`` NULL).

    Added up in the task, for no more than ``DISTINCT_WORDS`` words at a time.
    """
    sums: dict[str, np.ndarray] = {}
    counts = _WordCounts()
    for batch in batches:
        languages = batch.column(1).to_pylist()
        for start, stop, texts in text_blocks(batch, limit=SMALL_BLOCK):
            words = find_words(texts)
            for lang, row in zip(languages[start:stop], class_counts(words)):
                sums[lang] = sums.get(lang, 0) + row
            counts.add(words, word_hashes(words), languages[start:stop])
            if len(counts) > DISTINCT_WORDS or len(sums) > DISTINCT_WORDS:
                yield counts.take()
                yield _class_rows(sums)
                sums = {}
    yield counts.take()
    yield _class_rows(sums)


def _class_rows(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    rows = [(lang, k, int(v)) for lang, row in sums.items() for k, v in enumerate(row)]
    langs, classes, counts = zip(*rows) if rows else ([], [], [])
    columns = [pa.array(langs, pa.string()), pa.array(classes, pa.int32())]
    return _counted(*columns, pa.nulls(len(rows), pa.binary()), pa.array(counts, pa.int64()))


def language_references(
    docs: DataFrame, common_words: int = COMMON_WORDS, most_languages: int = MOST_LANGUAGES
) -> References:
    """References from all documents with a language.

    Only the ``most_languages`` with most words, of those that have enough, get one.
    """
    known = docs.select("text", F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    summed = known.mapInArrow(tidied(_counts), _COUNTED).groupBy("lang", "class", "word").agg(F.sum("n").alias("n"))
    counted = staged(summed, "language-counts")
    words = counted.where("class IS NULL")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= LEAST_REFERENCE_WORDS)
    chosen = F.broadcast(totals.orderBy(F.desc("total"), "lang").limit(most_languages))
    ranked = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = words.join(chosen, "lang").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= common_words)
    common = top.select("lang", F.col("word").cast("string").alias("word"), "n", "total").collect()
    classes = counted.where("word IS NULL").join(chosen, "lang").select("lang", "class", "n").collect()
    return _references(classes, common, common_words)


def _references(classes, common, common_words: int) -> References:
    total = {row["lang"]: row["total"] for row in common}
    languages = sorted(total)
    number = {lang: i for i, lang in enumerate(languages)}
    class_table = np.zeros((len(languages), N_CLASSES))
    for row in classes:
        class_table[number[row["lang"]], row["class"]] = row["n"]
    words = sorted({row["word"] for row in common})
    found = find_words([word.encode() for word in words])
    hashes = word_hashes(found)
    order = np.argsort(hashes)
    place = {word: i for i, word in enumerate(np.array(words, dtype=object)[order])}
    bins = np.full((len(languages), len(words)), common_words, dtype=np.int64)
    word_table = np.zeros((len(languages), common_words + 1))
    used = [0] * len(languages)
    for row in sorted(common, key=lambda r: (r["lang"], -r["n"], r["word"])):
        at = number[row["lang"]]
        bins[at, place[row["word"]]] = used[at]
        word_table[at, used[at]] = row["n"]
        used[at] += 1
    for lang, at in number.items():
        word_table[at, common_words] = total[lang] - word_table[at].sum()
    return References(languages, _shares(class_table), _shares(word_table), hashes[order], bins)


# ------------------------------------------------------------------------------------ verdict


def _distances(words: Words, hashes, classes, asked_of: np.ndarray, refs: References):
    """Class and word distance per text to the nearest of the references asked, or 0 without one."""
    n, n_bins = len(words.text_starts), refs.words.shape[1]
    class_distance, word_distance = np.full(n, np.inf), np.full(n, np.inf)
    at = np.searchsorted(refs.hashes, hashes)
    at = np.minimum(at, len(refs.hashes) - 1)
    common = refs.hashes[at] == hashes
    for k, asked in enumerate(asked_of):
        if not asked.any():
            continue
        bins = np.where(common, refs.bins[k][at], n_bins - 1)
        histogram = np.bincount(words.text * n_bins + bins, minlength=n * n_bins).reshape(n, n_bins)[asked]
        by_class = js_distance(_shares(classes[asked]), refs.classes[k])
        by_word = js_distance(_shares(histogram), refs.words[k])
        nearer = by_class + by_word < class_distance[asked] + word_distance[asked]
        rows = np.flatnonzero(asked)[nearer]
        class_distance[rows], word_distance[rows] = by_class[nearer], by_word[nearer]
    alone = ~asked_of.any(axis=0)
    class_distance[alone] = word_distance[alone] = 0
    return class_distance, word_distance


def _share_distance(share: np.ndarray, usual: float) -> np.ndarray:
    """Distance of shares of common words to the usual share, 0 where they are higher."""
    low = np.minimum(share, usual)
    return js_distance(np.stack([low, 1 - low], axis=-1), np.array([usual, 1 - usual]))


def _common_shares(words: Words, hashes: np.ndarray, refs: References) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per reference and text: the share of common words, its distance, and the limit per reference."""
    n = len(words.text_starts)
    at = np.minimum(np.searchsorted(refs.hashes, hashes), len(refs.hashes) - 1)
    common = refs.hashes[at] == hashes
    at, text = at[common], words.text[common]
    usual = 1 - refs.words[:, -1]
    found = [np.bincount(text[refs.bins[k][at] < refs.words.shape[1] - 1], minlength=n) for k in range(len(usual))]
    shares = np.stack(found) / np.maximum(words.counts(), 1)
    distances = np.stack([_share_distance(x, u) for x, u in zip(shares, usual)])
    limits = np.array([MOST_SHARE * _share_distance(np.zeros(1), u)[0] for u in usual])
    return shares, distances, limits


def _in_language(words: Words, hashes: np.ndarray, languages: list, refs: References) -> tuple[np.ndarray, np.ndarray]:
    """False for texts with few of the common words of their language, or clearly more of another's.

    And per reference, the texts to compare with it.
    """
    number = {lang: i for i, lang in enumerate(refs.languages)}
    own = np.array([number.get(lang, -1) for lang in languages])
    shares, distances, limits = _common_shares(words, hashes, refs)
    chance = SHARE_ALLOWANCE / np.sqrt(np.maximum(words.counts(), 1))
    column = np.arange(len(own))
    foreign = ((shares > shares[own, column] + chance) & (distances <= limits[:, None])).any(axis=0)
    unnamed = np.array([lang is None for lang in languages])
    asked_of = (own == np.arange(len(limits))[:, None]) | (unnamed & (distances <= limits[:, None]))
    return (own < 0) | ((distances[own, column] <= limits[own] + chance) & ~foreign), asked_of


_METRICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "class_distance double, word_distance double, base_failed boolean, kept boolean"
)


def _measures(texts: list[bytes], languages: list, refs: References) -> list[pa.Array]:
    words = find_words(texts)
    hashes = word_hashes(words)
    classes = class_counts(words)
    n_words, n_chars = words.counts(), classes.sum(axis=1)
    repeated = repeated_words(words, hashes)
    failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
    kept = ~failed
    by_class, by_word = np.zeros(len(texts)), np.zeros(len(texts))
    if refs.languages:
        in_language, asked_of = _in_language(words, hashes, languages, refs)
        by_class, by_word = _distances(words, hashes, classes, asked_of, refs)
        chance = 1 / np.sqrt(np.maximum(n_words, 1))
        fits = by_class <= MOST_CLASS_DISTANCE + CLASS_ALLOWANCE * chance
        fits &= (n_words < LEAST_COMPARED) | (by_word <= MOST_WORD_DISTANCE + WORD_ALLOWANCE * chance)
        fits &= in_language
        kept &= fits
    longs = (n_words, n_chars - classes[:, _SPACE], _symbols(words), repeated_lines(words), repeated)
    return [
        *(pa.array(x.astype(np.int64)) for x in longs),
        pa.array(by_class),
        pa.array(by_word),
        pa.array(failed),
        pa.array(kept),
    ]


def quality_rules(docs: DataFrame, keep: list[str], references: References | None = None) -> tuple[DataFrame, str]:
    """``keep`` columns of every document and one struct column of measures; and that column's name.

    The struct has the counts, both distances, ``base_failed`` and the verdict ``kept``.
    """
    refs = references if references is not None else language_references(docs)
    shared = docs.sparkSession.sparkContext.broadcast(refs)
    result = "quality"
    while result in docs.columns:
        result += "_"
    names = [field.split()[0] for field in _METRICS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column(1).to_pylist()
            for start, stop, texts in text_blocks(batch, limit=SMALL_BLOCK):
                measures = _measures(texts, languages[start:stop], shared.value)
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[2:], pa.StructArray.from_arrays(measures, names=names)],
                    names=[*part.schema.names[2:], result],
                )

    kept = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    inputs = docs.select("text", F.col("lang").cast("string").alias("lang"), *kept)
    kinds = dict(docs.select(*keep).dtypes)
    fields = [f"kept_{i} {kinds[c]}" for i, c in enumerate(keep)]
    struct = ", ".join(f"{name}: {kind}" for name, kind in (f.split() for f in _METRICS.split(", ")))
    judged = inputs.mapInArrow(tidied(run), ", ".join([*fields, f"{result} struct<{struct}>"]))
    return judged.toDF(*keep, result), result
