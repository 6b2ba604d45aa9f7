"""The prefix trie of conversations, with totals of subtrees by time-forward processing.

A node is a distinct sequence of first turns (role and text); conversations that begin with it are its
members. Totals of a subtree (childless nodes, tokens saved by storing a prefix once) go from children
to parents:

1. Nodes are sorted by reverse level order with Spark's external sort, and one pass over them sends
   each node's totals forward to its parent, through a priority queue that holds the messages in
   the order in which their receivers come. The queue spills sorted runs, so that its memory does not
   depend on the number of children.
2. Nodes with more than a limit of members are the upper trie. A node below it whose parent is in it
   is the root of a shard; shards hold no more members than the limit and are dealt over tasks by
   their roots. What shard roots send is added up per parent and processed with the upper trie.

Every member of an upper node takes a turn of some conversation, so that there are at most ``turns /
limit`` of them; the limit is chosen such that these are ``MOST_UPPER`` or fewer, whatever the input.
Only these are broadcast and processed by one task.

A conversation is streamed, not held: its nodes are named by running SHA-256 digests of its turns, and
texts are not shuffled.

Defined cases: turns go by number, NULL first, then by role and the digest of the text; a NULL role or
text is empty; rows without a conversation's id are left out; equal turns and conversations without
turns count like any others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.staging import staged

MOST_UPPER = 100_000
# Messages that a queue holds in memory before it spills.
QUEUE_MESSAGES = 200_000
CHUNK_IDS = 50_000
BASE_EVERY, MOST_SHARED = 20, 4
_NAME_BYTES = 16  # of a node's digest
_ROOT = hashlib.sha256(b"").digest()[:_NAME_BYTES]
_WORD = r"[^\x20\x09-\x0D]+"


# ------------------------------------------------------------------------------------ turns


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its family of ``BASE_EVERY``."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED).cast("int")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, n_words`` per row; the digest tells role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.sha2(text, 256).alias("text_sha256"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("n_words"),
    )


_PATH = "conv_id long, depth long, node binary, parent binary, n_words long, ends boolean"


def _paths(shared: bool):
    """Sorted turns to the nodes on each conversation's path, the root first.

    Rows come by family, the first conversation of the family before all others.
    """

    def emit(rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        names = [field.split()[0] for field in _PATH.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        last = None  # the latest node, held back until it is known whether the conversation ends there
        family = conv = None
        head: list = []  # the first turns of the family's first conversation
        skip = own = 0

        def step(digest: bytes, n_words: int) -> None:
            nonlocal last
            out.append((*last, False))
            conv_id, depth, node, _, _ = last
            last = (conv_id, depth + 1, hashlib.sha256(node + digest).digest()[:_NAME_BYTES], node, n_words)

        for batch in batches:
            for base, conv_id, digest, n_words, takes in zip(*(column.to_pylist() for column in batch.columns)):
                if conv_id != conv:
                    if last is not None:
                        out.append((*last, True))
                    if base != family:
                        family, head = base, []
                    conv, own, skip = conv_id, 0, takes if shared else 0
                    last = (conv_id, 0, _ROOT, None, 0)
                    if conv_id != base:
                        for turn in head[:skip]:
                            step(*turn)
                if conv_id == base and len(head) < MOST_SHARED - 1:
                    head.append((digest, n_words))
                own += 1
                # The family's first conversation takes its own turns over.
                if conv_id == base or own > skip:
                    step(digest, n_words)
            if out:
                yield emit(out)
                out = []
        if last is not None:
            out.append((*last, True))
            yield emit(out)

    return run


def conversation_paths(conversations: DataFrame, shared: bool = False) -> DataFrame:
    """A row per conversation and node on its path.

    With ``shared``, a conversation begins with :func:`shared_turns` turns of the first of its family, in
    place of as many of its own.
    """
    conv_id = F.col("conv_id")
    base = (conv_id - conv_id % BASE_EVERY) if shared else conv_id
    turns = turn_rows(conversations).withColumn("base", base).withColumn("takes", shared_turns(conv_id))
    order = [F.col("conv_id") != F.col("base"), "conv_id", F.asc_nulls_first("turn"), "role", "text_sha256"]
    laid_out = turns.repartition("base").sortWithinPartitions("base", *order)
    return laid_out.select("base", "conv_id", "digest", "n_words", "takes").mapInArrow(_paths(shared), _PATH)


# ------------------------------------------------------------------------------------- queue


class SpillingQueue:
    """A priority queue of ``(key, message)`` that keeps ``limit`` of them in memory.

    What is more is spilled as a sorted run to an unnamed file beside Spark's own spills, which the
    system removes with the task, and merged on the way out.
    """

    def __init__(self, limit: int = QUEUE_MESSAGES):
        self._limit, self._heap, self._count = limit, [], 0
        self._heads: list = []  # the next entry of each run

    def push(self, key, message) -> None:
        if len(self._heap) >= self._limit:
            self._spill()
        self._count += 1
        heapq.heappush(self._heap, (key, self._count, message))

    def _spill(self) -> None:
        folder = (os.environ.get("SPARK_LOCAL_DIRS") or "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        self._heap.sort()
        for start in range(0, len(self._heap), 1000):
            pickle.dump(self._heap[start : start + 1000], file, pickle.HIGHEST_PROTOCOL)
        file.seek(0)
        self._heap = []
        self._advance(self._read(file))

    @staticmethod
    def _read(file) -> Iterator:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: Iterator) -> None:
        entry = next(run, None)
        if entry is not None:
            heapq.heappush(self._heads, (entry[0], entry[1], entry[2], run))

    def pop_all(self, key) -> Iterator:
        """The messages with ``key``, which must be the least."""
        while self._heap and self._heap[0][0] == key:
            yield heapq.heappop(self._heap)[2]
        while self._heads and self._heads[0][0] == key:
            *_, message, run = heapq.heappop(self._heads)
            self._advance(run)
            yield message

    def __len__(self) -> int:
        return len(self._heap) + len(self._heads)


# ------------------------------------------------------------------------------- time-forward

_NODE = "node binary, parent binary, depth long, conv_id long, n_convs long, n_words long"
_TOTAL = "n_children long, n_leaves long, saved_tokens long"
_OUT = f"node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, {_TOTAL}"


def _time_forward(queue_messages: int):
    """Nodes in reverse level order, with what they get from elsewhere, to finished nodes.

    A node is finished when its parent comes and takes its totals, which also tells it the parent's
    id. Nodes whose parent does not come are the roots of what is here; their parent's id stays NULL.
    """

    def emit(rows: list) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.binary(), *[pa.int64()] * 7)
        names = [field.split()[0] for field in _OUT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, out = SpillingQueue(queue_messages), []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                node, parent, depth, conv_id, n_convs, n_words, children, leaves, saved, is_root = row
                for node_, parent_, depth_, conv_, convs_, children_, leaves_, saved_ in queue.pop_all((-depth, node)):
                    children, leaves, saved = children + 1, leaves + leaves_, saved + saved_
                    out.append((node_, parent_, depth_, conv_, conv_id, convs_, children_, leaves_, saved_))
                    if len(out) >= 10_000:
                        yield emit(out)
                        out = []
                leaves, saved = leaves or 1, saved + (n_convs - 1) * n_words
                if is_root:
                    out.append((node, parent, depth, conv_id, None, n_convs, children, leaves, saved))
                else:
                    message = (node, parent, depth, conv_id, n_convs, children, leaves, saved)
                    queue.push((1 - depth, parent), message)
        assert not len(queue), "a node's parent did not come"
        if out:
            yield emit(out)

    return run


def _reverse_level_order(nodes: DataFrame, dealt_by: int | str, queue_messages: int) -> DataFrame:
    columns = [*[f.split()[0] for f in _NODE.split(", ")], *[f.split()[0] for f in _TOTAL.split(", ")], "is_root"]
    ordered = nodes.repartition(dealt_by).sortWithinPartitions(F.desc("depth"), "node").select(*columns)
    return ordered.mapInArrow(_time_forward(queue_messages), _OUT)


def _members(paths: DataFrame) -> DataFrame:
    """The nodes; each is reduced before its shuffle, so that one with most of the members is cheap."""
    told = paths.groupBy("node", "parent", "depth", "n_words")  # the node determines the others
    return told.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))


def prefix_trie(paths: DataFrame, most_upper: int = MOST_UPPER, queue_messages: int = QUEUE_MESSAGES) -> DataFrame:
    """A row per node of the trie: its digest and its parent's, depth, the least members, and totals.

    ``paths`` is a staged result of :func:`conversation_paths`.
    """
    spark = paths.sparkSession
    nodes = staged(_members(paths), "trie-nodes")
    turns, convs = paths.agg(F.count(F.lit(1)), F.count(F.when(F.col("depth") == 0, 1))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A shard holds a quarter of a task's share, and the upper trie has no more nodes than allowed.
    limit = max(1, math.ceil(convs / (4 * tasks)), math.ceil(turns / most_upper))
    upper = nodes.where(F.col("n_convs") > limit)
    listed = F.broadcast(upper.select(F.col("node").alias("above"), F.col("conv_id").alias("above_conv")))

    # Where each conversation leaves the upper trie; the least member of a node below went the same way.
    leaving = paths.select("conv_id", "depth", F.col("node").alias("shard"), "parent").join(
        listed, F.col("parent") == F.col("above"), "left"
    )
    leaving = leaving.where(F.col("above").isNotNull() | (F.col("depth") == 0)).select("conv_id", "shard")
    leaving = leaving.join(listed, F.col("shard") == F.col("above"), "left_anti")
    none = [F.lit(0).cast("long").alias(f.split()[0]) for f in _TOTAL.split(", ")]
    lower = nodes.where(F.col("n_convs") <= limit).join(leaving, "conv_id")
    lower = lower.select(*nodes.columns, *none, (F.col("node") == F.col("shard")).alias("is_root"), "shard")
    within = staged(_reverse_level_order(lower, "shard", queue_messages), "trie-shards")

    # A shard's root has no parent's id yet; its parent, if any, is an upper node.
    shard_roots = within.where("parent_conv_id IS NULL AND parent IS NOT NULL")
    sent = shard_roots.groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    total = [F.coalesce(f.split()[0], F.lit(0)).cast("long").alias(f.split()[0]) for f in _TOTAL.split(", ")]
    top = upper.join(sent, "node", "left").select(*nodes.columns, *total, F.col("parent").isNull().alias("is_root"))
    across = _reverse_level_order(top, 1, queue_messages)
    named = within.join(listed, F.col("parent") == F.col("above"), "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above_conv")
    )
    return named.select(*within.columns).unionByName(across)


# --------------------------------------------------------------------------------------- ends


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ``node, conv_id`` to runs of ids, joined by commas."""

    def emit(node, ids) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
            names=["node", "first_id", "ids"],
        )

    node, ids = None, []
    for batch in batches:
        for this, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (this != node or len(ids) >= CHUNK_IDS):
                yield emit(node, ids)
                ids = []
            node = this
            ids.append(conv_id)
    if ids:
        yield emit(node, ids)


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node = state = None
    for batch in batches:
        nodes, digests = [], []
        for this, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
            if this != node:
                if node is not None:
                    nodes.append(node)
                    digests.append(state.hexdigest())
                node, state = this, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def ends_digests(paths: DataFrame) -> DataFrame:
    """Per node where conversations end, the digest of their ids, ascending and joined by commas.

    Such a digest is made in order; ids are sorted by range and joined into runs before, so that the
    task of a node gets one row for ``CHUNK_IDS`` of them, and streams those.
    """
    ends = paths.where("ends").select("node", "conv_id")
    runs = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    runs = runs.mapInArrow(_chunks, "node binary, first_id long, ids string")
    dealt = runs.repartition("node").sortWithinPartitions("node", "first_id")
    return dealt.mapInArrow(_hash_chunks, "node binary, ends_sha256 string")


def trie_with_ends(conversations: DataFrame, shared: bool = False, **options) -> DataFrame:
    """:func:`prefix_trie` of conversations with ``ends_sha256``, that of no id where none ends."""
    paths = staged(conversation_paths(conversations, shared), "trie-paths")
    ends = ends_digests(paths)
    nodes = prefix_trie(paths, **options)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
