"""Categorising by keyword rules, then by the category the source gave."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.text import normalize_keyword, strip_text
from tillroll.rules import KEYWORD_RULES, SOURCE_CATEGORY_MAP, UNCATEGORIZED


def keyword_category(
    normalized: Column,
    rules: Sequence[tuple[str, str]] = KEYWORD_RULES,
    *,
    normalize_keywords: bool = True,
) -> Column:
    """Category of the first rule whose keyword occurs in the normalised text, else NULL.

    Matching is by substring. Keywords are normalised like the text, so one that holds
    punctuation can match too; ``normalize_keywords=False`` takes them literally.
    """
    ladder = None
    for keyword, category in rules:
        keyword = normalize_keyword(keyword) if normalize_keywords else keyword
        if not keyword:
            continue
        hit = normalized.contains(keyword)
        ladder = F.when(hit, category) if ladder is None else ladder.when(hit, category)
    return F.lit(None).cast("string") if ladder is None else ladder


def mapped_category(
    source_category: Column, mapping: Mapping[str, str] = SOURCE_CATEGORY_MAP
) -> Column:
    """Our label for the category of the source, white space around it ignored; NULL if unknown."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = F.create_map(*(F.lit(x) for x in chain.from_iterable(mapping.items())))
    return F.try_element_at(pairs, strip_text(source_category))


def categorize(
    normalized: Column,
    source_category: Column,
    rules: Sequence[tuple[str, str]] = KEYWORD_RULES,
    mapping: Mapping[str, str] = SOURCE_CATEGORY_MAP,
    *,
    fallback: str = UNCATEGORIZED,
    normalize_keywords: bool = True,
) -> Column:
    """Keyword rules first, the source's category second, ``fallback`` last."""
    return F.coalesce(
        keyword_category(normalized, rules, normalize_keywords=normalize_keywords),
        mapped_category(source_category, mapping),
        F.lit(fallback),
    )
