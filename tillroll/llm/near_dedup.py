"""Near duplicates by HyperMinHash: documents whose shingle sets have a Jaccard index of 0.75 or more.

1. **Sketch.** Each shingle hash falls into one of ``REGISTERS`` buckets; a bucket keeps the smallest
   value as a count of leading zeros and the ``MANTISSA`` bits that follow, 16 bits in all. Empty
   buckets of short texts borrow from full ones in a fixed pseudo-random order, so that two registers
   agree with the probability of the Jaccard index at any length.
2. **Classes.** Documents with equal shingle sets form a class; only its least id goes on, so copies
   are never paired with each other.
3. **Bands.** Four registers make a band; classes that agree in a band are candidates. With 40 bands
   a pair at the threshold is missed with a probability of 2.5e-7.
4. **Links to leaders.** In each band the least id of a bucket is its leader. Every class is compared
   with the leader it shares most bands with: one pair per class, however large the bucket is.
5. **The rest.** Buckets that now lie within one component need nothing more. In the others, pairs
   between different components are looked at in blocks of bounded size; pairs within a component,
   and blocks of one component, are skipped. So no link between different components is lost, and
   the pairs that a group of near copies has are never listed. A pair is looked at in the first
   band it shares, and leaves its block only if its sets may reach the threshold.
6. **Verification.** Whether a pair may reach the threshold is told by its sizes, then by the Jaccard
   index estimated from the registers, corrected for chance collisions of compressed registers;
   within a block then by the ``BOTTOM`` least shingles, which are all of most texts. Pairs that
   remain are verified on their full shingle sets.

Defined cases: words are runs of other bytes than ASCII white space, A-Z in lower case. A text with
fewer words than a shingle has is one shingle, one without words or NULL has none and is linked with
nothing. Repeated rows and ties share a class; a row with a NULL id takes part in nothing and is its
own, NULL, component. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import connected_components
from tillroll.llm.key_filter import broadcast_filter, possible
from tillroll.llm.memory import tidied
from tillroll.llm.staging import staged
from tillroll.llm.words import SMALL_BLOCK, find_words, mix, text_blocks, window_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 75
REGISTERS, MANTISSA = 256, 10
BAND_SIZE, BANDS = 4, 40
# Five standard deviations of an estimate at the threshold; shorter sets are not pruned by estimate.
MARGIN, LEAST_ESTIMATED = 0.17, 24
# The least hashes of a set, and what an estimate from them may be off; whole sets are exact but for
# chance equality of their 32 bits.
BOTTOM, BOTTOM_MARGIN, WHOLE_MARGIN = 1024, 0.07, 0.01
BLOCK_ROWS, BIN_ROWS, PAIR_CHUNK = 1024, 4096, 8192
_SEED = np.uint64(0x5851F42D4C957F2D)
_BORROW_ROUNDS = 4096
_borrow_order: list[np.ndarray] = []


# ------------------------------------------------------------------------------------ sketches


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after the other; the text of each."""
    words = find_words(texts, lower_ascii=True)
    hashes = word_hashes(words)
    values, at = window_hashes(hashes, words.text, size)
    owner = words.text[at]
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.searchsorted(words.text, short)
        whole = mix(counts[short].astype(np.uint64))
        for k in range(size - 1):
            has = counts[short] > k
            whole[has] = mix(whole[has] ^ hashes[first[has] + k])
        values, owner = np.concatenate([values, whole]), np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], owner[new]


def _borrow(round_number: int) -> np.ndarray:
    """Which bucket each empty one looks at in a round; the same in every process."""
    while len(_borrow_order) <= round_number:
        base = np.arange(REGISTERS, dtype=np.uint64) + np.uint64(len(_borrow_order) * REGISTERS)
        _borrow_order.append((mix(base ^ _SEED) % np.uint64(REGISTERS)).astype(np.int64))
    return _borrow_order[round_number]


def registers(values: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """One row of ``REGISTERS`` 16-bit registers per text; zeros for a text without shingles."""
    spread = mix(values ^ _SEED)
    bucket = (spread % np.uint64(REGISTERS)).astype(np.int64)
    rest = spread >> np.uint64(8)
    least = np.full(n_texts * REGISTERS, np.uint64(2**64 - 1))
    np.minimum.at(least, owner * REGISTERS + bucket, rest)
    least = least.reshape(n_texts, REGISTERS)
    full = least != np.uint64(2**64 - 1)
    # ``rest`` has 56 bits: the exponent of its float form tells the leading zeros.
    zeros = (56 - np.frexp(least.astype(np.float64))[1]).clip(0, 56)
    shift = (zeros + 1).astype(np.uint64)
    mantissa = ((least << (shift + np.uint64(8))) >> np.uint64(64 - MANTISSA)) & np.uint64(2**MANTISSA - 1)
    packed = ((zeros.astype(np.uint64) + np.uint64(1)) << np.uint64(MANTISSA)) | mantissa
    result = np.where(full, packed, np.uint64(0)).astype(np.uint16)
    open_rows = np.flatnonzero(full.any(axis=1) & ~full.all(axis=1))
    for number in range(_BORROW_ROUNDS):
        if not len(open_rows):
            break
        source, rows = _borrow(number), result[open_rows]
        # Only buckets that were full at first lend, and they never change.
        lent = np.where(full[open_rows][:, source], rows[:, source], np.uint16(0))
        rows = np.where(rows == 0, lent, rows)
        result[open_rows] = rows
        open_rows = open_rows[(rows == 0).any(axis=1)]
    for at in open_rows:
        row = result[at]
        row[row == 0] = row[row > 0].min()
    return result


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop, texts in text_blocks(batch, limit=SMALL_BLOCK):
            values, owner = shingles(texts)
            n = len(texts)
            sizes = np.bincount(owner, minlength=n)
            prints = [np.zeros(n, dtype=np.uint64) for _ in range(2)]
            for k, sums in enumerate(prints):
                np.add.at(sums, owner, mix(values ^ (_SEED + np.uint64(k + 1))))
            table = registers(values, owner, n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, stop - start),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(prints[0].view(np.int64)),
                    pa.array(prints[1].view(np.int64)),
                    pa.array([row.tobytes() for row in table], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "print1", "print2", "registers"],
            )


_SKETCH = "doc_id long, n_shingles long, print1 long, print2 long, registers binary"


# --------------------------------------------------------------------------------- estimation


def collision_rate(n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Chance that two different minima of sets of these sizes have equal compressed registers.

    They must have as many leading zeros and then agree in the mantissa, which is near uniform.
    """
    levels = np.arange(1, 57)
    upper, lower = 2.0 ** -(levels - 1), 2.0**-levels
    held = []
    for n in (n_left, n_right):
        load = np.maximum(np.asarray(n, dtype=float) / REGISTERS, 1.0)[..., None]
        held.append((1 - lower) ** load - (1 - upper) ** load)
    return (held[0] * held[1]).sum(axis=-1) / 2**MANTISSA


def estimated_jaccard(left: np.ndarray, right: np.ndarray, n_left, n_right) -> np.ndarray:
    """Jaccard index from registers, without the share of agreements that chance explains."""
    agree = (left == right).mean(axis=-1)
    chance = collision_rate(n_left, n_right)
    return (agree - chance) / (1 - chance)


def _may_link(left, right, n_left, n_right) -> np.ndarray:
    """Whether pairs may reach the threshold: by size, which is certain, then by the estimate."""
    small, large = np.minimum(n_left, n_right), np.maximum(n_left, n_right)
    fits = 100 * small >= THRESHOLD * large
    near = estimated_jaccard(left, right, n_left, n_right) >= THRESHOLD / 100 - MARGIN
    return fits & (near | (small < LEAST_ESTIMATED))


def _table(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint16).reshape(-1, REGISTERS)


def _estimated(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that the estimate does not rule out."""
    one = sketches.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("registers").alias("r_a"))
    two = sketches.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("registers").alias("r_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                keep = _may_link(
                    _table(batch["r_a"]), _table(batch["r_b"]), batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
                )
                yield batch.loc[keep, ["a", "b"]]

    sized = pairs.join(one, "a").join(two, "b")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * THRESHOLD
    return sized.where(fits).mapInPandas(run, "a long, b long")


# ------------------------------------------------------------------------------- verification


def _sets_of(wanted):
    """Shingle sets of the texts whose id may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = possible(wanted.value, batch.column(2).to_numpy())
            for start, stop, texts in text_blocks(batch.filter(pa.array(hits)), limit=SMALL_BLOCK):
                values, owner = shingles(texts)
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                sets = [values[i:j].tobytes() for i, j in spans]
                high = (values >> np.uint64(32)).astype(np.uint32)
                bottoms = [high[i : min(j, i + BOTTOM)].tobytes() for i, j in spans]
                ids = batch.filter(pa.array(hits)).column(0).slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sets, pa.binary()), pa.array(bottoms, pa.binary())],
                    names=["doc_id", "shingles", "bottom"],
                )

    return run


def _shingle_sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The full shingle sets of the documents in ``ids``, read from their texts."""
    hashed = ids.select("doc_id", F.xxhash64("doc_id").alias("id_hash"))
    wanted = broadcast_filter(hashed, "id_hash")
    sets = texts.select("doc_id", "text", F.xxhash64("doc_id").alias("id_hash")).mapInArrow(
        tidied(_sets_of(wanted)), "doc_id long, shingles binary, bottom binary"
    )
    return staged(sets.join(ids, "doc_id", "left_semi"), "near-sets")


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2), batch.column(3)):
            one = np.frombuffer(left.as_py(), dtype=np.uint64)
            two = np.frombuffer(right.as_py(), dtype=np.uint64)
            both = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(100 * both >= THRESHOLD * (len(one) + len(two) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    both = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s_a")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("s_b")), "b")
        .select("a", "b", "s_a", "s_b")
    )
    return staged(both.mapInArrow(tidied(_linked), "a long, b long").distinct(), "near-links")


# ----------------------------------------------------------------------------------- the rest


def _blocks(members: DataFrame, block_rows: int) -> DataFrame:
    """Members of a bucket once per pair of blocks to compare: ``key, low, high, left`` are added.

    A component with more than a block of members has blocks of its own, which are not compared with
    each other; smaller ones share blocks.
    """
    sizes = members.groupBy("key", "root").agg(F.count("*").alias("n"))
    large = F.col("n") > block_rows
    unit = F.when(large, F.col("root"))
    units = sizes.withColumn("unit", unit).groupBy("key", "unit").agg(F.sum("n").alias("n"))
    units = units.withColumn("n_blocks", F.ceil(F.col("n") / block_rows).cast("int"))
    block = F.struct(F.coalesce("unit", F.lit(0)).alias("unit"), F.col("unit").isNotNull().alias("own"), "number")
    listed = (
        units.withColumn("number", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .groupBy("key")
        .agg(F.collect_list(block).alias("others"))
    )
    placed = (
        members.join(sizes.select("key", "root", unit.alias("unit")), ["key", "root"])
        .join(
            units.select("key", F.col("unit").alias("u"), "n_blocks").withColumnRenamed("key", "k"),
            (F.col("key") == F.col("k")) & F.col("unit").eqNullSafe(F.col("u")),
        )
        .withColumn("number", F.pmod(F.xxhash64("doc_id"), F.col("n_blocks")).cast("int"))
        .withColumn("block", block)
        .select("key", "band", "doc_id", "root", "block")
    )
    apart = F.filter(
        "others", lambda o: ~(o["own"] & F.col("block.own") & (o["unit"] == F.col("block.unit")))
    )
    paired = placed.join(listed, "key").withColumn("other", F.explode(apart))
    return paired.select(
        "key",
        "band",
        "doc_id",
        "root",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        (F.col("block") <= F.col("other")).alias("left"),
    )


def _index_pairs(group: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each group, rows being sorted by group: within one block, or across two."""
    edges = np.flatnonzero(np.diff(group)) + 1
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for start, end in zip(np.append(0, edges), np.append(edges, len(group))):
        own = left[start:end]
        one = np.arange(start, end)[own]
        two = one if own.all() else np.arange(start, end)[~own]
        step = max(1, PAIR_CHUNK // max(1, len(two)))
        for at in range(0, len(one), step):
            i = np.repeat(one[at : at + step], len(two))
            j = np.tile(two, len(one[at : at + step]))
            keep = j > i if own.all() else slice(None)
            held.append((i[keep], j[keep]))
            size += len(held[-1][0])
            if size >= PAIR_CHUNK:
                yield tuple(map(np.concatenate, zip(*held)))
                held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _bottoms_may_link(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two sets may reach the threshold, judged by their least hashes."""
    shared = np.intersect1d(one, two, assume_unique=False)
    if len(one) < BOTTOM and len(two) < BOTTOM:
        union, margin = len(one) + len(two) - len(shared), WHOLE_MARGIN
    else:
        least = np.union1d(one, two)[:BOTTOM]
        shared = shared[shared <= least[-1]]
        union, margin = len(least), BOTTOM_MARGIN
    return len(shared) >= (THRESHOLD / 100 - margin) * union


def _cross_pairs(members: pd.DataFrame) -> pd.DataFrame:
    """Pairs of a bin's groups that lie in different components and may be linked."""
    members = members.sort_values("group", kind="stable", ignore_index=True)
    table, sizes = _table(members["registers"]), members["n_shingles"].to_numpy()
    ids, roots, bands = (members[c].to_numpy() for c in ("doc_id", "root", "band"))
    bottoms = [np.frombuffer(x, dtype=np.uint32) for x in members["bottom"]]
    found = [np.empty((0, 2), dtype=np.int64)]
    for i, j in _index_pairs(members["group"].to_numpy(), members["left"].to_numpy()):
        keep = (roots[i] != roots[j]) & (
            100 * np.minimum(sizes[i], sizes[j]) >= THRESHOLD * np.maximum(sizes[i], sizes[j])
        )
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        equal = (table[i] == table[j]).reshape(len(i), -1, BAND_SIZE).all(axis=2)[:, :BANDS]
        first = equal.argmax(axis=1) == bands[i]
        i, j = i[first], j[first]
        near = _may_link(table[i], table[j], sizes[i], sizes[j])
        pairs = [(a, b) for a, b in zip(i[near], j[near]) if _bottoms_may_link(bottoms[a], bottoms[b])]
        if pairs:
            found.append(ids[np.array(pairs)])
    pairs = np.sort(np.concatenate(found), axis=1)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def _rest(members: DataFrame, roots: DataFrame, sketches: DataFrame, sets: DataFrame, block_rows: int) -> DataFrame:
    """Candidate pairs of members of one bucket that the links so far leave in different components."""
    known = members.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    known = staged(known.select("key", "band", "doc_id", F.coalesce("root", "doc_id").alias("root")), "near-members")
    mixed = known.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    pairs = staged(_blocks(staged(known.join(mixed, "key"), "near-mixed"), block_rows), "near-blocks")
    bins = max(1, pairs.count() // BIN_ROWS)
    group = F.xxhash64("key", "low", "high")
    return (
        pairs.join(sketches.select("doc_id", "n_shingles", "registers"), "doc_id")
        .join(sets.select("doc_id", "bottom"), "doc_id")
        .select("doc_id", "root", "band", "left", "n_shingles", "registers", "bottom", group.alias("group"))
        .groupBy(F.pmod("group", F.lit(bins)).alias("bin"))
        .applyInPandas(_cross_pairs, "a long, b long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(texts.mapInArrow(tidied(_sketches), _SKETCH), "near-sketches")
    prints = ["print1", "print2", "n_shingles"]
    usable = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = staged(usable.groupBy(*prints).agg(F.min("doc_id").alias("doc_id")), "near-classes")
    sketches = staged(
        usable.join(classes, ["doc_id", *prints], "left_semi").dropDuplicates(["doc_id", "print1"]).select(
            "doc_id", "n_shingles", "registers"
        ),
        "near-heads",
    )
    band = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("registers", i * (2 * BAND_SIZE) + 1, F.lit(2 * BAND_SIZE))),
    )
    banded = sketches.select("doc_id", F.posexplode(band).alias("band", "key"))
    leaders = (
        banded.groupBy("key").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last"))
    ).where("leader < last")
    members = staged(banded.join(leaders.select("key", "leader"), "key"), "near-buckets")
    best = (
        members.where("doc_id <> leader")
        .groupBy("doc_id", "leader")
        .agg(F.count("*").alias("shared"))
        .groupBy("doc_id")
        .agg(F.max(F.struct("shared", (-F.col("leader")).alias("minus"))).alias("best"))
        .select((-F.col("best.minus")).alias("a"), F.col("doc_id").alias("b"))
    )
    sets = _shingle_sets(texts, members.select("doc_id").distinct())
    links = _verified(_estimated(best, sketches), sets)
    roots = connected_components(links, "a", "b")
    more = _verified(_rest(members, roots, sketches, sets, block_rows), sets)
    roots = connected_components(
        more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))), "a", "b"
    )
    named = staged(
        classes.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
            *prints, F.coalesce("root", "doc_id").alias("component")
        ),
        "near-components",
    )
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return (
        rows.select("doc_id", *prints)
        .join(named, prints, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
