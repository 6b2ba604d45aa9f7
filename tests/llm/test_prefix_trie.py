"""The trie against one that is built plainly, node by node."""

import hashlib
import random
import re
import zlib

import pytest

from tests.llm.helpers import LONG, with_clashes
from tillroll.llm.prefix_trie import SpillingQueue, trie_with_ends

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows, shared):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {}
    for c, listed in own.items():
        listed.sort(key=lambda t: (*t[:3], hashlib.sha256(t[3].encode()).hexdigest()))
        turns[c] = [t[2:] for t in listed]
    if not shared:
        return turns
    result = {}
    for c, listed in turns.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20) * (1 if c > 0 else -1)
        result[c] = turns.get(base, [])[:h] + listed[h:]
    return result


def expected(rows, shared):
    paths = rebuilt(rows, shared)
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [totals[k] for k in children.get(node, [])]
        saved = (len(members[node]) - 1) * words + sum(b[1] for b in below)
        totals[node] = (sum(b[0] for b in below) or 1, saved)
    result = []
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(paths[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        result.append((min(who), len(node), parent, len(who), len(children.get(node, [])), *totals[node], sha))
    return sorted(result, key=repr)


def random_rows(convs, seed, alphabet=3, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, longest + 1)):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(["w"] * rng.randrange(alphabet))))
    rng.shuffle(rows)
    return rows


ODD = [
    (None, 0, "user", "nobody's"),
    (5, None, "user", "first"),
    (5, None, None, None),
    (5, 2, "", ""),
    (5, 2, "", ""),
    (5, 1, "user", LONG),
    (-3, 0, "user", "negative \t\n words"),
    (-40, 0, "user", "of their family"),
    (-41, 7, "ab", "c"),
    (-42, 7, "a", "bc"),
]
CASES = [
    [],
    [(1, 0, "user", "one")],
    ODD,
    random_rows(60, 1),
    random_rows(200, 2, alphabet=2),
    [(c, t, "user", f"same {t}") for c in range(90) for t in range(5)] + random_rows(30, 3),
    [(c, 0, "user", f"own {c}") for c in range(70)],
    [(0, t, "user", f"long {t}") for t in range(3000)],
]


@pytest.mark.parametrize("shared", [False, True])
@pytest.mark.parametrize("rows", CASES)
def test_equals_a_plain_trie(spark, rows, shared):
    df = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3))
    found = trie_with_ends(df, shared).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows, shared)


def test_small_queues_and_a_small_upper_trie_change_nothing(spark):
    df = spark.createDataFrame(CASES[5], "conv_id long, turn long, role string, text string")
    found = trie_with_ends(df, most_upper=3, queue_messages=2).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == expected(CASES[5], False)


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_queue(limit):
    rng, queue, held = random.Random(limit), SpillingQueue(limit), {}
    for key in range(200):
        assert sorted(queue.pop_all(key)) == sorted(held.pop(key, []))
        for _ in range(rng.randrange(6)):
            later = key + 1 + rng.randrange(9)
            held.setdefault(later, []).append(rng.random())
            queue.push(later, held[later][-1])
    assert len(queue) > 0 or not held


def test_ids_are_hashed_in_runs(spark, monkeypatch):
    from tillroll.llm import prefix_trie

    rows = [(c, 0, "user", "same") for c in range(40)]
    paths = prefix_trie.conversation_paths(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    ends = spark.createDataFrame(paths.toPandas()).where("ends")
    runs = [b.to_pylist() for b in prefix_trie._chunks(ends.orderBy("conv_id").select("node", "conv_id").toArrow().to_batches())]
    assert [len(r[0]["ids"].split(",")) for r in runs] == [7, 7, 7, 7, 7, 5]
