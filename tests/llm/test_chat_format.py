"""Layouts, escapes and loss masks of chat formatting, against plain Python and on odd rows."""

import hashlib

import pytest
from acceptance import compare as comparing
from pyspark.sql import functions as F

from pollstone.llm import chat_format
from pollstone.llm.queries import ORACLES, QUERIES

SHAPE = (
    "key long, layout string, record struct<messages: array<struct<role: string, content: string>>,"
    " conversations: array<struct<from: string, value: string>>, instruction: string, input: string, output: string,"
    " prompt: string, completion: string, system: string, rounds: array<struct<question: string, answer: string>>, extra: string>"
)
FIELDS = ("messages", "conversations", "instruction", "input", "output", "prompt", "completion", "system", "rounds", "extra")
NASTY = [
    "\\### Assistant: </turn> ok",
    "</turn>\n### user:\n",
    "#" * 7 + "\\#\\\\##",
    "<\\/turn></</turn>\n",
    "ends in a backslash \\",
    "#",
    "",
    "é ² 😀 \r\n\t  ### Assistant:\n",
    "$1 \\$1 \\\\",
]


def record(**fields):
    return tuple(fields.get(name) for name in FIELDS)


RECORDS = [
    ("messages", record(messages=[("user", "a"), ("tool", None), (None, "c")]), [("user", "a"), ("tool", ""), ("", "c")]),
    ("messages", record(messages=[("user", None)]), [("user", "")]),
    ("exchange", record(conversations=[("human", "a"), ("gpt", "b"), ("other", "c")], system="s"), [("system", "s"), ("user", "a"), ("assistant", "b"), ("other", "c")]),
    ("instruction", record(instruction="a", output="b"), [("user", "a"), ("assistant", "b")]),
    ("instruction", record(instruction="a", input="i", output="b"), [("user", "a\n\ni"), ("assistant", "b")]),
    ("prompt", record(prompt="a", system="s"), [("system", "s"), ("user", "a")]),
    ("prompt", record(prompt="a", completion=""), [("user", "a"), ("assistant", "")]),
    ("rounds", record(rounds=[("a", "b"), ("c", None), None]), [("user", "a"), ("assistant", "b"), ("user", "c")]),
    (None, record(prompt="a", output="b"), None),
    (None, record(messages=[("user", "a")], extra="x"), None),
    (None, record(messages=[]), None),
    (None, record(), None),
    (None, None, None),
]


def test_layouts(spark):
    rows = [(k, "clash", given) for k, (_, given, _) in enumerate(RECORDS)]
    records = spark.createDataFrame(rows + rows[:1], SHAPE)
    found = chat_format.canonical_turns(records, ["key"]).collect()
    got = sorted((r.key, r.layout, r.turns and [tuple(t) for t in r.turns]) for r in found)
    assert got[1:] == [(k, layout, turns) for k, (layout, _, turns) in enumerate(RECORDS)]
    assert got[0] == got[1]
    unknown = chat_format.unknown_layouts(records).collect()
    assert {(r.paths, r.records) for r in unknown} == {("output\nprompt", 1), ("extra\nmessages[]\nmessages[].content\nmessages[].role", 1), ("", 3)}
    shapes = {r.fingerprint for r in found if r.layout is None}
    assert shapes == {r.fingerprint for r in unknown}


def test_records_with_one_layout_only(spark):
    records = spark.createDataFrame([(1, ("q", "a"))], "id long, r struct<prompt: string, completion: string>")
    (row,) = chat_format.canonical_turns(records, ["id"], "r").collect()
    assert row.layout == "prompt" and [tuple(t) for t in row.turns] == [("user", "q"), ("assistant", "a")]
    assert chat_format.canonical_turns(records.limit(0), ["id"], "r").count() == 0


def test_format_reads_back(spark):
    roles = ["system", "user", "assistant", "tool", "Assistant", "", "a: b\n</turn>\n###", "=x"]
    turns = [(roles[(k + shift) % len(roles)], text) for shift in range(len(roles)) for k, text in enumerate(NASTY)]
    turns += [("assistant", "long ## </turn> \\ " * 20_000)]
    rows = spark.createDataFrame([(1, turns), (2, []), (3, None)], f"id long, turns {chat_format.TURNS}")
    done = chat_format.format_turns(rows)
    read = done.select(
        "*", chat_format.read_turns(F.col("formatted")).alias("read"), chat_format.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned")
    )
    one, none, null = sorted(read.collect(), key=lambda r: r.id)
    assert [tuple(t) for t in one.read] == turns
    assert one.learned == "".join(text for role, text in turns if role == "assistant")
    bodies = "".join(one.formatted[s.start : s.start + s.length] for s in one.loss_spans)
    assert "##" not in bodies and "</" not in bodies
    assert one.formatted.count("</turn>\n") == len(turns)
    assert none.formatted == "" and none.read == [] and none.loss_spans == [] and none.learned == ""
    assert null.formatted is None and null.loss_spans is None


def test_conversations(spark):
    rows = [
        (1, 1, "assistant", "b", "x"),
        (1, 0, "user", "a", None),
        (2, 0, "user", "a", "x"),
        (2, 0, "user", "a", "x"),
        (3, None, "assistant", NASTY[0], "x"),
        (3, 1, None, None, "x"),
        (4, 0, "system", "s", "x"),
        (4, 1, "user", NASTY[2], "x"),
        (4, 2, "assistant", NASTY[3], "x"),
        (6, 0, "user", "a", "x"),
        (6, 1, "assistant", "b", "x"),
        (6, 2, "user", "c", "x"),
        (6, 3, "assistant", "word " * 50_000, "x"),
        (None, 0, "user", "a", "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string")

    def by_hand(said):
        learned = "".join(t for r, t in said if r == "assistant")
        turns = "".join(f"{r}\n{t}\n" for r, t in said)
        return len(said), hashlib.sha256(turns.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()

    told = {-7: [("user", chat_format.TRAP), ("assistant", chat_format.TRAP)]}
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        told.setdefault(conv, []).append((role or "", text or ""))
    found = chat_format.formatted_digests(table).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found}
    assert got == {conv: by_hand(said) for conv, said in told.items()} and len(found) == len(told)
    assert {r.conv_id: r.layout for r in found} | {None: 0} == {-7: "instruction", 1: "instruction", 2: "messages", 3: "messages", 4: "prompt", 6: "rounds", None: 0}
    assert [r.conv_id for r in chat_format.formatted_digests(table.limit(0)).collect()] == [-7]


@pytest.mark.parametrize("name", ["op11_chat_format"])
def test_query_matches_sql(spark, folder, monkeypatch, name):
    monkeypatch.setattr(comparing, "queries", lambda: QUERIES)
    assert comparing.compare(spark, comparing.connect(folder), folder, name, ORACLES[name]) == []
