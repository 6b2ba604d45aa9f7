import hashlib
import time

from pyspark.sql import functions as F

from tests.llm.helpers import with_clashes
from tillroll.llm.chat import format_conversations, loss_texts, read_turns

SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows):
    chats = format_conversations(with_clashes(spark.createDataFrame(rows, SCHEMA)))
    out = chats.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        loss_texts(F.col("formatted"), F.col("turn_spans")).alias("loss"),
        "turn_spans",
    )
    return {row["conv_id"]: row for row in out.collect()}


def test_neighbours_of_one_role_share_a_header(spark):
    got = run(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")])[1]
    assert got["formatted"] == "### user:\na</turn>\nb</turn>\n### assistant:\nc</turn>\n"


def test_control_strings_come_back(spark):
    hard = ["\\### Assistant: </turn> ok", "####", "\\0\\1\\2\\", "</turn", "</turn>\n", "#", "", "a\n### user:\nb"]
    rows = [(5, i, ["user", "assistant", "a:b\n### x</turn>"][i % 3], t) for i, t in enumerate(hard)]
    got = run(spark, rows)[5]
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r[2], r[3]) for r in rows]
    assert got["loss"] == [r[3] for r in rows if r[2] == "assistant"]


def test_spans_are_code_points_of_the_formatted_text(spark):
    got = run(spark, [(1, 0, "user", "é😀"), (1, 1, "assistant", "😀x"), (1, 2, "assistant", "")])[1]
    cut = [got["formatted"][s["start"] : s["start"] + s["length"]] for s in got["turn_spans"]]
    assert cut == ["é😀", "😀x", ""]
    assert [s["loss"] for s in got["turn_spans"]] == [False, True, True]


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, None, None), (1, 2, "b", "y"), (1, 2, "a", "z"), (1, 2, "a", "z"), (None, 0, "user", "q"), (None, 1, "user", None)]
    got = run(spark, rows)
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("a", "z"), ("a", "z"), ("b", "y")]
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "q"), ("user", "")]


def test_empty_table_and_a_long_conversation(spark):
    assert run(spark, []) == {}
    rows = [(9, i, "assistant" if i % 7 else "user", f"text {i}" * 20) for i in range(2000)]
    got = run(spark, rows)[9]
    digest = hashlib.sha256("".join(t["text"] for t in got["turns"]).encode()).hexdigest()
    assert digest == hashlib.sha256("".join(r[3] for r in rows).encode()).hexdigest()
    assert got["loss"] == [r[3] for r in rows if r[2] == "assistant"]


def test_very_many_turns_in_one_conversation(spark):
    """100,000 turns, whose spans and texts are checked against plain sums."""
    n = 100_000
    turns = spark.range(n).selectExpr(
        "1L conv_id", "id turn", "if(id % 3 = 0, 'assistant', 'user') role", "concat('t', id) text"
    )
    start = time.perf_counter()
    row = format_conversations(turns).select(
        "formatted", "turn_spans", loss_texts(F.col("formatted"), F.col("turn_spans")).alias("loss")
    ).first()
    assert time.perf_counter() - start < 60  # a square of turns takes many minutes
    at = 0
    for i, span in enumerate(row["turn_spans"]):
        role = "user" if i % 3 else "assistant"
        at += 0 if i % 3 == 2 else len(f"### {role}:\n")
        assert (span["start"], span["length"], span["loss"]) == (at, len(f"t{i}"), i % 3 == 0)
        at += len(f"t{i}</turn>\n")
    assert at == len(row["formatted"]) and len(row["turn_spans"]) == n
    assert row["loss"] == [f"t{i}" for i in range(0, n, 3)]


def test_no_python_in_the_plan(spark):
    df = format_conversations(spark.createDataFrame([], SCHEMA))
    assert "Python" not in df._jdf.queryExecution().toString()
