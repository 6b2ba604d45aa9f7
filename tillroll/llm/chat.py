"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, neighbours of one role are merged
into blocks, each by an aggregation of its array of turns, and the blocks are concatenated::

    ### user:
    first text</turn>
    second text of the same role</turn>
    ### assistant:
    answer</turn>

Inside roles and texts the backslash and all control strings are written as two-character codes, each
a backslash and a digit, so that no control string of the template occurs in them and reading back
is exact. A conversation is one output row, so it must fit in a row; everything before its
concatenation is done per turn, and Spark combines turns before it shuffles them. The work on a
conversation grows with its turns, not with their square.

Defined cases: a NULL role or text counts as empty; turns with equal numbers are ordered by role,
then text, NULL numbers come first; repeated rows are kept as turns of their own; rows with a NULL
id form one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER, ROLE_END, TURN_END = "### ", ":\n", "</turn>\n"
# Control strings and their codes; the backslash comes first in writing and last in reading.
_CODES = (("\\", "\\0"), ("</turn>", "\\1"), ("###", "\\2"))
_ROLE_CODES = (*_CODES, (":", "\\3"))
# Turns whose sums are made together.
_RUN = 256


def _escape(text: Column, codes) -> Column:
    for control, code in codes:
        text = F.replace(text, F.lit(control), F.lit(code))
    return text


def _unescape(text: Column, codes) -> Column:
    for control, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(control))
    return text


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    order: str = "turn",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``turn_spans``.

    ``turn_spans`` has per turn, in order, the ``start`` (code points from 0) and ``length`` of its
    escaped text in ``formatted``; ``loss`` says whether the text is under the loss mask.
    """
    role = _escape(F.coalesce(F.col("role"), F.lit("")), _ROLE_CODES)
    text = _escape(F.coalesce(F.col("text"), F.lit("")), _CODES)
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.struct(F.col(order).alias("turn"), role.alias("role"), text.alias("text")).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    formatted = _bind(
        F.col("turns"),
        lambda turns: F.concat_ws("", F.transform(_blocks(turns), lambda b: _block_text(turns, b))),
    )
    loss = _escape(F.lit(loss_role), _ROLE_CODES)
    return grouped.select(
        "conv_id",
        formatted.alias("formatted"),
        _bind(F.col("turns"), lambda turns: _spans(turns, loss)).alias("turn_spans"),
    )


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once, even where ``use`` needs it for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _opens(turns: Column, turn: Column, i: Column) -> Column:
    """Whether the turn at ``i`` has another role than the one before it."""
    return (i == 0) | (F.get(turns, i - 1)["role"] != turn["role"])


def _blocks(turns: Column) -> Column:
    """Runs of neighbours of one role: the role, the first turn (from 1) and how many there are."""
    marked = F.transform(turns, lambda t, i: F.struct(_opens(turns, t, i).alias("opens"), (i + 1).alias("first")))
    firsts = F.transform(F.filter(marked, lambda m: m["opens"]), lambda m: m["first"])

    def block(firsts: Column, first: Column, i: Column) -> Column:
        end = F.coalesce(F.get(firsts, i + 1), F.size(turns) + 1)
        return F.struct(
            F.get(turns, first - 1)["role"].alias("role"), first.alias("first"), (end - first).alias("n")
        )

    return _bind(firsts, lambda bound: F.transform(bound, lambda first, i: block(bound, first, i)))


def _block_text(turns: Column, block: Column) -> Column:
    members = F.slice(turns, block["first"], block["n"])
    texts = F.transform(members, lambda t: F.concat(t["text"], F.lit(TURN_END)))
    return F.concat(F.lit(HEADER), block["role"], F.lit(ROLE_END), F.concat_ws("", texts))


def _spans(turns: Column, loss_role: Column) -> Column:
    """Where each turn's text lies: sums over the headers and texts before it."""

    def header(turn: Column, i: Column) -> Column:
        size = F.char_length(turn["role"]) + len(HEADER) + len(ROLE_END)
        return F.when(_opens(turns, turn, i), size).otherwise(F.lit(0))

    sizes = F.transform(
        turns,
        lambda t, i: F.struct(
            header(t, i).alias("header"),
            F.char_length(t["text"]).alias("length"),
            (t["role"] == loss_role).alias("loss"),
        ),
    )

    def span(s: Column, before: Column) -> Column:
        return F.struct((before + s["header"]).alias("start"), s["length"].alias("length"), s["loss"].alias("loss"))

    def spans(sizes: Column) -> Column:
        taken = F.transform(sizes, lambda s: s["header"] + s["length"] + len(TURN_END))
        return _bind(_sums_before(taken), lambda sums: F.transform(sizes, lambda s, i: span(s, F.get(sums, i))))

    return _bind(sizes, spans)


def _sums_before(values: Column) -> Column:
    """For each value the sum of those before it.

    An array that grows by one element is copied for each, so the values are cut into runs: sums are
    made within each run and over the totals of the runs before it.
    """

    def running(run: Column) -> Column:
        start = F.array(F.lit(0))
        return F.aggregate(run, start, lambda done, v: F.concat(done, F.array(F.element_at(done, -1) + v)))

    def total(run: Column) -> Column:
        return F.element_at(run, -1)

    def joined(runs: Column) -> Column:
        def shifted(offsets: Column) -> Column:
            moved = F.transform(
                runs,
                lambda run, i: F.transform(F.slice(run, 1, F.size(run) - 1), lambda v: v + F.get(offsets, i)),
            )
            return F.flatten(moved)

        return _bind(running(F.transform(runs, total)), shifted)

    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(_RUN))
    cut = _bind(values, lambda bound: F.transform(starts, lambda at: running(F.slice(bound, at, _RUN))))
    return _bind(cut, joined)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as structs of role and text, unescaped."""
    pieces = F.split(formatted, HEADER)
    blocks = F.slice(pieces, 2, F.size(pieces))
    return F.flatten(F.transform(F.transform(blocks, _read_block), _block_turns))


def _read_block(block: Column) -> Column:
    role = F.substring_index(block, ROLE_END, 1)
    texts = F.split(F.substr(block, F.char_length(role) + len(ROLE_END) + 1), TURN_END)
    return F.struct(
        _unescape(role, _ROLE_CODES).alias("role"), F.slice(texts, 1, F.size(texts) - 1).alias("texts")
    )


def _block_turns(block: Column) -> Column:
    return F.transform(
        block["texts"],
        lambda text: F.struct(block["role"].alias("role"), _unescape(text, _CODES).alias("text")),
    )


def loss_texts(formatted: Column, turn_spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order.

    Each text is cut out of the piece it lies in, at the place that its span gives, so that the work
    grows with the length of the conversation and not with its square.
    """

    def masked(pieces: Column, spans: Column) -> Column:
        def cut(span: Column, i: Column) -> Column:
            before = F.get(spans, i - 1)
            piece_start = F.when(i == 0, 0).otherwise(before["start"] + before["length"] + len(TURN_END))
            text = F.substr(F.get(pieces, i), span["start"] - piece_start + 1, span["length"])
            return F.struct(span["loss"].alias("loss"), text.alias("text"))

        found = F.filter(F.transform(spans, cut), lambda x: x["loss"])
        return F.transform(found, lambda x: _unescape(x["text"], _CODES))

    pieces = F.split(formatted, TURN_END)
    return _bind(turn_spans, lambda spans: _bind(pieces, lambda bound: masked(bound, spans)))
