"""Categorising by a rule table that users edit and that may be large."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.category import keyword_category, mapped_category
from tillroll.functions.text import normalize_text
from tillroll.rules import SOURCE_CATEGORY_MAP, UNCATEGORIZED
from tillroll.sources.scratch import staged_table

# Up to this many rules, and characters in them, become part of the plan.
INLINE_RULES = 200
INLINE_CHARS = 64 * INLINE_RULES
BLOCK_BYTES = 2048
# Size of the piece by which a keyword is looked up.
ANCHOR_BYTES = 4
# Where more keywords than this share a piece, they are filed under pieces of the next of these sizes.
MOST_SHARING = 32
LONGER_ANCHORS = (8, 16, 32)


def _normalized_rules(rules: DataFrame) -> DataFrame:
    """Rules with normalised keywords. Those without a letter or digit, or a category, never match."""
    return rules.select(
        "priority", normalize_text(F.col("keyword")).alias("keyword"), "category"
    ).where((F.col("keyword") != "") & F.col("category").isNotNull())


def _inline_rules(rules: DataFrame, max_rules: int) -> list[tuple[str, str]] | None:
    """The rules in order if they are few and short, else None."""
    size = rules.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("keyword")).alias("chars")).first()
    if size["n"] > max_rules or (size["chars"] or 0) > INLINE_CHARS:
        return None
    # Spark's order, in which a NULL priority comes first, as in the least struct of a long table
    ordered = rules.orderBy("priority", "category").collect()
    return [(row["keyword"], row["category"]) for row in ordered]


def _text_key(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text), 256))


def _slices(data: Column, step: int, size: int) -> Column:
    """Slices of ``size`` bytes that begin every ``step`` bytes.

    Bytes, because finding a character of a string takes a walk from its start. Equal bytes are
    equal text, and no character's bytes begin within another's.
    """
    length = F.octet_length(data)
    starts = F.when(length > 0, F.sequence(F.lit(1), length, F.lit(step)))
    return F.transform(starts, lambda at: F.substring(data, at, F.lit(size)))


def _grams(data: Column, size: int) -> Column:
    """The pieces of exactly ``size`` bytes that begin at any byte, as strings."""
    starts = F.when(F.octet_length(data) >= size, F.sequence(F.lit(1), F.octet_length(data) - size + 1))
    cut = F.transform(starts, lambda at: F.substring(data, at, F.lit(size)).cast("string"))
    return F.coalesce(cut, F.array().cast("array<string>"))


def _pieces(data: Column, sizes: list[int]) -> Column:
    """The distinct pieces of the given sizes."""
    return F.array_distinct(F.concat(*(_grams(data, size) for size in sizes)))


def _shuffled(side: DataFrame) -> DataFrame:
    """``side``, so that a join with it shuffles.

    Spark estimates a side by the bytes of compressed files, whatever is made of their rows. What it takes
    for small enough to broadcast can be many times the driver's memory.
    """
    return side.hint("merge")


def _anchored(keywords: DataFrame, longer: Sequence[int] = ()) -> DataFrame:
    """``keywords`` with the ``anchor`` under which each is filed.

    It is the keyword's piece of ``ANCHOR_BYTES`` bytes that the fewest keywords have, so that few
    candidates come of a hit; the least of several. A shorter keyword is its own anchor.

    Among very many keywords even the rarest piece is shared by ever more of them. Where more than
    ``MOST_SHARING`` have it, the rarest piece of the next size in ``longer`` that is not shared as
    much is taken, or the whole of a keyword that is shorter than the first of them; where there is none,
    the rarest of all.
    """
    data = F.col("keyword").cast("binary")
    short = F.octet_length(data) < max([ANCHOR_BYTES, *longer[:1]])
    whole = F.when(short, F.array("keyword")).otherwise(F.array().cast("array<string>"))
    pieces = F.array_distinct(F.concat(whole, *(_grams(data, size) for size in [ANCHOR_BYTES, *longer])))
    filed = keywords.select("keyword", F.explode(pieces).alias("anchor"))
    shared = filed.groupBy("anchor").agg(F.count(F.lit(1)).alias("_sharing"))
    size, sharing = F.octet_length("anchor"), F.col("_sharing")
    crowded = F.lit(bool(longer)) & (sharing > MOST_SHARING)
    order = F.struct(
        crowded.alias("crowded"), F.when(crowded, sharing).otherwise(size).alias("first"), sharing, F.col("anchor")
    )
    best = filed.join(_shuffled(shared), "anchor").groupBy("keyword").agg(F.min(order)["anchor"].alias("anchor"))
    return best.join(_shuffled(keywords), "keyword")


def _first_rule(rules: DataFrame, key: str) -> DataFrame:
    """The first rule in priority order for each key.

    The key is grouped with a second value, which it determines. The result is then not
    partitioned by the key alone, so a join on the key shuffles it, and a shuffle on both sides is
    what lets Spark split the rows of a key that very many of the other side share.
    """
    return rules.groupBy(key, F.crc32(F.col(key).cast("binary")).alias("_crc")).agg(
        F.min("_rule").alias("_rule")
    ).drop("_crc")


def match_rules(texts: DataFrame, rules: DataFrame, text: str = "description_norm") -> DataFrame:
    """``(_text_key, _rule)`` of each distinct text in which a keyword occurs; the first rule wins.

    Substring search as equality joins: each keyword is filed under one piece of itself of a fixed
    size, its anchor. The piece at each position of each distinct text is looked up once, whatever
    lengths the keywords have, and the keywords filed under it are then searched for in the block of
    text around it. Keywords shorter than an anchor are looked up in their own sizes, which are
    fewer than ``ANCHOR_BYTES``. In tables so long that such pieces are shared by many keywords, these are
    filed under longer ones (see :func:`_anchored`), and each size in use is looked up. The work grows with the length of the texts and the candidates, but
    not with texts × rules. Both joins shuffle rows of a piece, or of a block, so Spark can split the
    pieces that very many texts share.
    """
    known = rules.agg(F.collect_set(F.octet_length("keyword")), F.count(F.lit(1))).first()
    sizes, n_rules = sorted(known[0]), known[1]
    keywords = _first_rule(
        rules.select("keyword", F.struct("priority", "category").alias("_rule")), "keyword"
    )
    longest = max(sizes, default=1)
    if n_rules > MOST_SHARING:
        anchored = staged_table(_anchored(keywords, LONGER_ANCHORS), "anchored")
        in_use = anchored.agg(F.collect_set(F.octet_length("anchor"))).first()[0]
        looked_up = sorted(in_use) or [ANCHOR_BYTES]
    else:
        anchored = _anchored(keywords)
        looked_up = [*(n for n in sizes if n < ANCHOR_BYTES), ANCHOR_BYTES]
    # Each access to a binary column copies it, so long texts are first cut into blocks, which
    # overlap by all of a keyword but its first byte.
    cut = _slices(F.col("data"), BLOCK_BYTES, BLOCK_BYTES + longest - 1)
    # the outer form of explode, as the plain one would have each array built twice: once more in a
    # filter for empty ones. A NULL that it leaves meets no keyword.
    blocks = (
        texts.select(_text_key(text).alias("_text_key"), text)
        .distinct()
        .select("_text_key", F.col(text).cast("binary").alias("data"))
        .select("_text_key", F.posexplode_outer(cut).alias("block", "data"))
    )
    candidates = (
        blocks.select("_text_key", "block", F.explode_outer(_pieces(F.col("data"), looked_up)).alias("anchor"))
        .join(_shuffled(anchored), "anchor")
        .select("_text_key", "block", "keyword", "_rule")
    )
    found = candidates.join(_shuffled(blocks), ["_text_key", "block"]).where(
        F.contains(F.col("data"), F.col("keyword").cast("binary"))
    )
    return _first_rule(found.select("_text_key", "_rule"), "_text_key")


def categorize_by_table(
    df: DataFrame,
    rules: DataFrame,
    *,
    text: str = "description_norm",
    source_category: str = "chase_category",
    mapping: Mapping[str, str] = SOURCE_CATEGORY_MAP,
    fallback: str = UNCATEGORIZED,
    max_inline_rules: int = INLINE_RULES,
) -> DataFrame:
    """Set ``category`` from a ``(priority, keyword, category)`` table; the least priority wins.

    A NULL priority is the least, equal priorities go by category, and a rule without a category is
    no rule, however long the table is.

    ``text`` must be normalised; keywords are normalised here. The result is that of
    :func:`~tillroll.functions.categorize` with the same rules. A short table becomes part of the
    plan and costs no join. A long one is matched against the distinct texts, and the matches are
    joined to the rows.
    """
    ready = _normalized_rules(rules)
    inline = _inline_rules(ready, max_inline_rules)
    rest = [mapped_category(F.col(source_category), mapping), F.lit(fallback)]
    if inline is not None:
        hit = keyword_category(F.col(text), inline, normalize_keywords=False)
        return df.withColumn("category", F.coalesce(hit, *rest))
    keyed = df.withColumn("_text_key", _text_key(text))
    return (
        keyed.join(match_rules(df, ready, text), "_text_key", "left")
        .withColumn("category", F.coalesce(F.col("_rule.category"), *rest))
        .drop("_text_key", "_rule")
    )
