"""Language identification: scripts narrow the candidates, then Viterbi labels every word.

Per language, triples of letters within words are counted over all labelled training documents. A
word's score under a language is the log probability of its letters. The script of a word, by ranges
of code points, leaves as candidates the languages that write at least ``SCRIPT_SHARE`` of their
letters in it. Viterbi then finds the best sequence of languages over the words of a text, where a
change of language costs ``SWITCH``; runs of one language are the spans of a mixed text. A document's
language is the one with most letters, its score their share.

Counts are combined per task and summed by Spark; the table that goes through the driver has at most
128 ** 3 entries per language.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0 and has no spans; words
in a script that no language writes favour none, and a text of nothing else gets the language with
most training text and score 0; equal letters go to the first language by name; training rows with a
NULL text or language are not used; without any training row all is ``und``; repeated rows are labelled
alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.symbols import N_TRIPLES, code_points, log_probabilities, triples
from tillroll.llm.words import text_blocks

SWITCH = 12.0
SCRIPT_SHARE = 0.01
STRENGTH = 8.0
UNKNOWN = "und"
_HELD_LANGUAGES = 8
_NO_CANDIDATE = -1e4
# First and last code point of the main ranges of each script.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
    "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
}
N_SCRIPTS = len(SCRIPTS) + 1  # the last for all others


@functools.cache
def _letter_table() -> np.ndarray:
    """2 for letters, 1 for the marks that belong to a word with letters, 0 for all else."""
    kinds = (unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1))
    return np.fromiter(({"L": 2, "M": 1}.get(k, 0) for k in kinds), dtype=np.int8, count=sys.maxunicode + 1)


@functools.cache
def _script_table() -> np.ndarray:
    table = np.full(sys.maxunicode + 1, N_SCRIPTS - 1, dtype=np.int8)
    for number, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            table[first : last + 1] = number
    return table


@dataclass
class _Block:
    """Words of a block: place and length in code points, script, and the triples of all letters."""

    starts: np.ndarray
    sizes: np.ndarray
    text: np.ndarray
    scripts: np.ndarray
    triples: np.ndarray  # per word its letters and the boundary after it
    bounds: np.ndarray  # first triple of each word, and the end
    text_starts: np.ndarray


def _lower(texts: list[bytes]) -> list[bytes]:
    """Lower case, letter by letter, so that places stay as they are."""
    result = []
    for raw in texts:
        text = raw.decode()
        low = text.lower()
        if len(low) != len(text):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        result.append(low.encode())
    return result


def _block(texts: list[bytes]) -> _Block:
    points, starts, _ = code_points(_lower(texts), "\n\n")
    kinds = _letter_table()[points]
    letters = kinds > 0
    symbols = np.where(letters, 27 + points % 101, 0).astype(np.uint8)
    ascii_letter = (points >= 97) & (points <= 122)
    symbols[ascii_letter] = points[ascii_letter] - 96
    edges = np.flatnonzero(np.diff(letters.view(np.int8), prepend=np.int8(0)))
    first, end = edges[::2], edges[1::2]
    so_far = np.concatenate([[0], np.cumsum(kinds == 2)])
    worded = so_far[end] > so_far[first]  # marks alone are no word
    first, end = first[worded], end[worded]
    sizes = end - first
    lengths = sizes + 1
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], lengths) + np.repeat(first, lengths)
    # The word's first letter follows a boundary, whatever stands before that.
    before = symbols.copy()
    found = triples(before)[at - 2]
    opening = bounds[:-1]
    found[opening] = symbols[first]
    text = np.searchsorted(starts, first, side="right") - 1
    return _Block(first, sizes, text, _script_table()[points[first]], found, bounds, starts)


# ----------------------------------------------------------------------------------- training


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Triples per language; script letters follow as numbers from ``N_TRIPLES`` on."""
    held: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, sums in held.items():
            at = np.flatnonzero(sums)
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "entry", "n"])
        held.clear()

    size = N_TRIPLES + N_SCRIPTS
    for batch in batches:
        languages = batch.column(1).to_pylist()
        for start, stop, texts in text_blocks(batch):
            block, own = _block(texts), np.array(languages[start:stop], dtype=object)
            for lang in sorted(set(own)):
                words = (own == lang)[block.text]
                entries = block.triples[np.repeat(words, block.sizes + 1)]
                counts = np.bincount(entries, minlength=size)
                counts[N_TRIPLES:] += np.bincount(
                    block.scripts[words], weights=block.sizes[words], minlength=N_SCRIPTS
                ).astype(np.int64)
                held[lang] = held[lang] + counts if lang in held else counts
            if len(held) > _HELD_LANGUAGES:
                yield from flush()
    yield from flush()


@dataclass
class LanguageModels:
    """Per language: log probabilities of the triples that occur in training, and its scripts.

    ``row`` maps a triple to its row in ``scores``; the last row is that of all others.
    """

    languages: list[str]
    row: np.ndarray
    scores: np.ndarray
    writes: np.ndarray
    main: int


def train_language_models(docs: DataFrame) -> LanguageModels:
    """Models of all languages in ``lang``, from every row with a text and a language."""
    known = docs.select("text", F.col("lang").cast("string").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    summed = (
        known.mapInArrow(_count, "lang string, entry int, n long")
        .groupBy("lang", "entry")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(summed["lang"].unique())
    seen = np.unique(summed["entry"].to_numpy(dtype=np.int64))
    seen = seen[seen < N_TRIPLES]
    row = np.full(N_TRIPLES, len(seen), dtype=np.int32)
    row[seen] = np.arange(len(seen))
    scores = np.zeros((len(seen) + 1, len(languages)), dtype=np.float32)
    writes = np.zeros((N_SCRIPTS, len(languages)), dtype=bool)
    letters = np.zeros(len(languages))
    for k, lang in enumerate(languages):
        own = summed[summed["lang"] == lang]
        counts = np.zeros(N_TRIPLES + N_SCRIPTS)
        counts[own["entry"].to_numpy(dtype=np.int64)] = own["n"]
        table = log_probabilities(counts[:N_TRIPLES], STRENGTH)
        scores[:-1, k] = table[seen]
        scores[-1, k] = table.min()
        letters[k] = counts[N_TRIPLES:].sum()
        writes[:, k] = (counts[N_TRIPLES:] > 0) & (counts[N_TRIPLES:] >= SCRIPT_SHARE * letters[k])
    return LanguageModels(languages, row, scores, writes, int(letters.argmax()) if languages else -1)


# ----------------------------------------------------------------------------------- labelling


def _word_scores(block: _Block, models: LanguageModels) -> np.ndarray:
    """Words by languages. Languages that do not write a word's script are far behind the others."""
    per_triple = models.scores[models.row[block.triples]]
    scores = np.add.reduceat(per_triple, block.bounds[:-1], axis=0, dtype=np.float64)
    candidates = models.writes[block.scripts]
    scores[~candidates] = _NO_CANDIDATE
    scores[~candidates.any(axis=1)] = 0.0
    return scores


def viterbi(scores: np.ndarray, text: np.ndarray, n_texts: int, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word. All texts of a block advance together, word by word."""
    counts = np.bincount(text, minlength=n_texts)
    begins = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    sorted_counts, begins = counts[order], begins[order]
    n_labels = scores.shape[1]
    back = np.empty(scores.shape, dtype=np.int16)
    stay = np.arange(n_labels)
    longest = int(counts.max(initial=0))
    active = np.searchsorted(-sorted_counts, -np.arange(longest), side="left")
    best = np.zeros((n_texts, n_labels))
    for t in range(longest):
        k = active[t]
        rows = begins[:k] + t
        state = best[:k]
        if t:
            top = state.argmax(axis=1)
            moved = state[np.arange(k), top] - switch
            change = moved[:, None] > state
            state = np.where(change, moved[:, None], state)
            back[rows] = np.where(change, top[:, None], stay)
        best[:k] = state + scores[rows]
    labels = np.empty(len(scores), dtype=np.int64)
    current = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        rows = begins[:k] + t
        labels[rows] = current[:k]
        if t:
            current[:k] = back[rows, current[:k]]
    return labels


def _label(texts: list[bytes], models: LanguageModels):
    """Per text its language, score and spans of (start, length, language)."""
    n = len(texts)
    names, scores, spans = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
    block = _block(texts)
    if not len(block.starts) or not models.languages:
        return names, scores, spans
    values = _word_scores(block, models)
    labels = viterbi(values, block.text, n)
    n_labels = len(models.languages)
    judged = models.writes[block.scripts].any(axis=1)
    letters = np.bincount(block.text, weights=block.sizes, minlength=n)
    won = np.bincount(
        block.text[judged] * n_labels + labels[judged], weights=block.sizes[judged], minlength=n * n_labels
    ).reshape(n, n_labels)
    best = won.argmax(axis=1)
    for i in np.flatnonzero(letters):
        share = won[i, best[i]] / letters[i]
        names[i] = models.languages[best[i] if share else models.main]
        scores[i] = round(share, 6)
    new = np.ones(len(labels), dtype=bool)
    new[1:] = (labels[1:] != labels[:-1]) | (block.text[1:] != block.text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(labels)) - 1
    for i, j in zip(first.tolist(), last.tolist()):
        at = int(block.text[i])
        start = int(block.starts[i] - block.text_starts[at])
        end = int(block.starts[j] + block.sizes[j] - block.text_starts[at])
        spans[at].append({"start": start, "length": end - start, "lang": models.languages[labels[i]]})
    return names, scores, spans


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("lang", pa.string())]))


def identify_languages(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, spans``. Only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, texts in text_blocks(batch):
                names, scores, spans = _label(texts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(start, stop - start),
                        pa.array(names, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(spans, _SPANS),
                    ],
                    names=["doc_id", "lang_pred", "score", "spans"],
                )

    return docs.select("text", F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        run,
        "doc_id long, lang_pred string, score double, "
        "spans array<struct<start: long, length: long, lang: string>>",
    )
