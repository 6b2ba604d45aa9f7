"""A Merkle manifest of a dataset, by butterfly exchange.

Every row is a leaf. The leaves of a source, in the order of their ids, are the bottom of its tree, in
which up to ``FANOUT`` consecutive nodes have one parent; the roots of the sources, in the order of the
sources, are the bottom of the tree above. The manifest gives each row its path to the root of all:
per level, the digests before and after its own among their parent's children.

1. Leaves are range-partitioned by source and id and numbered by counts per range, so that a source
   with most of the rows is spread like any other.
2. The leaves of a tree are cut into aligned blocks of ``FANOUT ** levels``. A block is hashed up to
   its top node by the task that streams it, which gives the lower part of the paths.
3. Blocks then swap nodes round by round. In round r, the blocks whose number differs in digit r only
   are a group: each sends the top node it holds to the others, and all hash the same parent. After
   the last round every block holds the root and the upper part of its paths; nothing is passed
   down. Where the last subtree is short, its blocks send to several blocks each, dealt evenly.

A block receives ``FANOUT`` nodes a round, and there are as many rounds as the number of blocks has
digits. No tree is held whole anywhere, and nothing passes through the driver but the largest number
of blocks in a tree.

Defined cases: a NULL field is hashed apart from an empty one; a NULL id or source comes first; rows
with equal ids are ordered by their digests, and equal rows are a leaf each; a tree of one leaf is
that leaf; an empty table gives no rows; other columns are kept if asked for, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.llm.staging import staged

FANOUT = 3
# Blocks have FANOUT ** BLOCK_LEVELS leaves: 2,187.
BLOCK_LEVELS = 7
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_STEP = "struct<before: string, after: string>"


# ---------------------------------------------------------------------------------- expressions


def leaf_digest(*fields: Column) -> Column:
    """The digest of a row: each field as its length in bytes and its text, a NULL one as ``-``."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def path_digest(path: Column) -> Column:
    """The digest of all siblings on a path."""
    siblings = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.concat_ws("", siblings), 256)


# ------------------------------------------------------------------------------------ numbering


def _place_in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with their number among those of their tree there."""
    part, tree, place, begun = TaskContext.get().partitionId(), None, 0, False
    for batch in batches:
        places = []
        for value in batch.column(0).to_pylist():
            if not begun or value != tree:
                tree, place, begun = value, 0, True
            places.append(place)
            place += 1
        columns = [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "place"])


def _with_fields(df: DataFrame, more: str) -> StructType:
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with their ``rank`` in their tree, from 0, and the ``total`` of the tree.

    ``leaves`` is a staged table whose column ``row`` tells equal leaves apart.
    """
    keys = ["tree", *order, "leaf", "row"]
    laid_out = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = _with_fields(leaves, "part int, place long")
    placed = staged(laid_out.mapInArrow(_place_in_range, schema), "merkle-leaves")
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("tree").alias("_tree"),
        F.col("part").alias("_part"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("part") == F.col("_part"))
    return placed.join(offsets, same).select(*leaves.columns, (F.col("offset") + F.col("place")).alias("rank"), "total")


# --------------------------------------------------------------------------------------- blocks


def _digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _hash_block(leaves: list[str], levels: int | None) -> tuple[str, list[list[dict]]]:
    """The top node above ``leaves`` and the path of each to it; by default up to a single node."""
    paths: list[list[dict]] = [[] for _ in leaves]
    nodes, width = leaves, 1
    while len(nodes) > 1 if levels is None else levels > 0:
        for i, path in enumerate(paths):
            at = i // width
            first = at - at % FANOUT
            siblings = nodes[first : first + FANOUT]
            path.append({"before": "".join(siblings[: at - first]), "after": "".join(siblings[at - first + 1 :])})
        nodes = [_digest(nodes[k : k + FANOUT]) for k in range(0, len(nodes), FANOUT)]
        width *= FANOUT
        levels = None if levels is None else levels - 1
    return nodes[0], paths


def _block_paths(levels: int):
    """Rows sorted by tree and rank, with the path to the top of their block, and that node."""
    size = FANOUT**levels

    def finish(rows: list[pa.RecordBatch], schema: pa.Schema) -> pa.RecordBatch:
        block = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        alone = block.column(block.schema.get_field_index("total"))[0].as_py() <= size
        leaves = block.column(block.schema.get_field_index("leaf")).to_pylist()
        node, paths = _hash_block(leaves, None if alone else levels)
        return pa.RecordBatch.from_arrays(
            [*block.columns, pa.array(paths, schema.field("lower").type), pa.array([node] * len(leaves))],
            names=[*block.schema.names, "lower", "node"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = pa.struct([("before", pa.string()), ("after", pa.string())])
        schema = pa.schema([("lower", pa.list_(step))])
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            at = batch.schema.get_field_index("rank")
            keys = list(zip(batch.column(0).to_pylist(), (r // size for r in batch.column(at).to_pylist())))
            start = 0
            for i, this in enumerate(keys):
                if this == key:
                    continue
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield finish(held, schema)
                held, start, key = [], i, this
            if len(keys) > start:
                held.append(batch.slice(start))
        if held:
            yield finish(held, schema)

    return run


# ------------------------------------------------------------------------------------ butterfly


def _exchange(state: DataFrame, number: int) -> DataFrame:
    """One round: groups of blocks that differ in one digit of their number swap nodes.

    ``state`` has a row per block: its tree, number, the tree's ``blocks``, the ``node`` it holds, and
    the path above its own top.
    """
    width = FANOUT**number
    block, blocks = F.col("block"), F.col("blocks")
    subtree = F.expr(f"block div {width}")
    first = subtree - subtree % FANOUT
    offset, held = block % width, F.least(F.lit(width), blocks - subtree * width)

    def asked_by(k: int) -> Column:
        """The blocks of the group's k-th subtree that get this block's node."""
        start = (first + k) * width
        there = F.least(F.lit(width), blocks - start)
        numbers = F.transform(F.sequence(start + offset, start + there - 1, held), lambda b: b.cast("long"))
        return F.when(subtree == first + k, F.array(block)).when(offset < there, numbers).otherwise(
            F.array().cast("array<long>")
        )

    sent = state.select(
        "tree",
        F.explode(F.concat(*map(asked_by, range(FANOUT)))).alias("to"),
        "blocks",
        "block",
        F.struct((subtree - first).alias("digit"), "node").alias("child"),
        "upper",
    )
    got = sent.groupBy("tree", F.col("to").alias("block")).agg(
        F.first("blocks").alias("blocks"),
        F.sort_array(F.collect_list("child")).alias("children"),
        F.max(F.when(F.col("block") == F.col("to"), F.col("upper"))).alias("upper"),
    )
    own = F.expr(f"block div {width}") % FANOUT

    def join(keep) -> Column:
        return F.concat_ws("", F.transform(F.filter("children", keep), lambda c: c["node"]))

    step = F.struct(join(lambda c: c["digit"] < own).alias("before"), join(lambda c: c["digit"] > own).alias("after"))
    return got.select(
        "tree",
        "block",
        "blocks",
        F.sha2(join(lambda c: F.lit(True)), 256).alias("node"),
        F.concat("upper", F.array(step)).alias("upper"),
    )


def _forest(leaves: DataFrame, order: list[str], levels: int) -> tuple[DataFrame, DataFrame]:
    """Per leaf its lower path and block, and per block its tree's root and the path above its top."""
    size = FANOUT**levels
    ranked = _numbered(leaves, order).withColumn("block", F.expr(f"rank div {size}"))
    blocks = ranked.repartition("tree", "block").sortWithinPartitions("tree", "rank")
    schema = _with_fields(ranked, f"lower array<{_STEP}>, node string")
    rows = staged(blocks.mapInArrow(_block_paths(levels), schema), "merkle-paths")
    state = rows.where(F.col("rank") % size == 0).select(
        "tree",
        "block",
        F.expr(f"(total + {size - 1}) div {size}").alias("blocks"),
        "node",
        F.array().cast(f"array<{_STEP}>").alias("upper"),
    )
    most = state.agg(F.max("blocks")).first()[0] or 0
    number, done = 0, []
    while FANOUT**number < most:
        width = FANOUT**number
        done.append(state.where(F.col("blocks") <= width))
        state = staged(_exchange(state.where(F.col("blocks") > width), number), "merkle-round")
        number += 1
    for finished in done:
        state = state.unionByName(finished)
    return rows, state


# ------------------------------------------------------------------------------------- manifest


def merkle_manifest(
    docs: DataFrame, keep: list[str] | None = None, fields: list[str] | None = None, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """``keep`` columns of every row (by default ``doc_id``), ``leaf``, ``path``, ``subroot``, ``root``.

    ``fields`` are hashed into the leaf. :func:`fold_path` of a leaf and its path is the root, and no
    other leaf has that path to it. ``docs`` has the columns ``source`` and ``doc_id``.
    """
    keep = keep if keep is not None else ["doc_id"]
    kept = F.struct(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(keep)]).alias("kept")
    hashed = [F.col(f"`{name}`") for name in (fields or FIELDS)]
    row = F.monotonically_increasing_id().alias("row")
    source, doc_id = F.col("source").cast("string").alias("tree"), F.col("doc_id").cast("long").alias("at")
    leaves = docs.select(source, doc_id, leaf_digest(*hashed).alias("leaf"), kept, row)
    rows, blocks = _forest(staged(leaves, "merkle-rows"), ["at"], block_levels)

    subroots = blocks.where("block = 0").select(
        F.lit(0).alias("tree"), F.col("tree").alias("at"), F.col("node").alias("leaf"), F.lit(0).cast("long").alias("row")
    )
    tops, top_blocks = _forest(staged(subroots, "merkle-subroots"), ["at"], block_levels)
    above = tops.join(top_blocks.select("block", F.col("node").alias("root"), "upper"), "block").select(
        F.col("at").alias("_tree"), "root", F.concat("lower", "upper").alias("top")
    )
    of_block = blocks.join(above, F.col("tree").eqNullSafe(F.col("_tree"))).select(
        F.col("tree").alias("_tree"),
        F.col("block").alias("_block"),
        F.col("node").alias("subroot"),
        "root",
        F.concat("upper", "top").alias("upper"),
    )
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))
    return rows.join(staged(of_block, "merkle-blocks"), same).select(
        *[F.col("kept")[f"c{i}"].alias(name) for i, name in enumerate(keep)],
        "leaf",
        F.concat("lower", "upper").alias("path"),
        "subroot",
        "root",
    )
