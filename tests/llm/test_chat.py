"""Chat formatting of odd records and rows, and its query against brute force."""

import hashlib
import json

from pyspark.sql import functions as F

from shelfmatch.llm import chat, queries

HALF = "\ud800"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_odd_records(spark):
    turn = lambda role, text: json.dumps({"messages": [{"role": role, "content": text}]})
    cases = {
        turn({}, "x"): ("messages", [("{}", "x")]),
        turn(["a"], 3): (None, []),  # another path: the item of a list
        turn("user", f"a{HALF}b"): ("messages", [("user", "a�b")]),
        turn(f"{HALF}", "\U0001f642"): ("messages", [("�", "\U0001f642")]),
        json.dumps({HALF: 1}): (None, []),
        "[" * 100_000: (None, []),
        "[" * 300 + "]" * 300: (None, []),
        '{"a":' * 400 + "1" + "}" * 400: (None, []),
        '{"prompt": true, "response": 1.5}': ("prompt", [("user", "true"), ("assistant", "1.5")]),
        '{"prompt": "p", "prompt": "q", "response": null}': ("prompt", [("user", "q"), ("assistant", "")]),
        "NaN": (None, []), '"text"': (None, []), "": (None, []), None: (None, []), "[1": (None, []),
    }
    rows = [(i, r, "x") for i, r in enumerate(cases)]
    df = spark.createDataFrame(rows + rows[:4], "id int, record string, chat string")
    got = chat.canonical(df)
    assert got.columns == ["id", "record", "chat"]
    got = got.collect()
    assert len(got) == len(rows) + 4
    for r in got:
        layout, turns = cases[r.record]
        assert (r.chat.layout, [tuple(t) for t in r.chat.turns]) == (layout, turns)
    assert chat.canonical(df.limit(0)).count() == 0


def test_odd_turns(spark):
    kind = "id int, turns array<struct<role: string, text: string>>, formatted int, back int, _row int"
    long = "</s>" * 20_000
    rows = [
        (1, None, 0, 0, 0), (2, [], 0, 0, 0), (3, [(None, None), ("assistant", None)], 0, 0, 0),
        (4, [("assistant", long), ("assistant", "b")], 0, 0, 0), (None, [("a\nb\\", "c")], 0, 0, 0),
    ]
    df = spark.createDataFrame(rows + rows, kind)
    made = chat.formatted(df)
    assert made.columns == ["id", "turns", "back", "_row", "formatted"]
    back = chat.read_back(made)
    got = back.collect()
    assert len(got) == 10
    for r in got:
        turns = [(t.role or "", t.text or "") for t in r.turns or []]
        assert [tuple(t) for t in r.back.turns] == turns
        assert r.back.loss_text == "".join(t for role, t in turns if role == "assistant")
    none = made.withColumn("formatted", F.when(F.lit(False), F.col("formatted")))
    assert {(len(r.back.turns), r.back.loss_text) for r in chat.read_back(none).collect()} == {(0, "")}
    assert chat.read_back(chat.formatted(df.limit(0))).count() == 0


def test_query(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet").collect()
    talks = {-7: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in rows:
        talks.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    got = {r.conv_id: r for r in queries.op9_chat(spark, data).collect()}
    assert got.keys() == talks.keys()
    for i, turns in talks.items():
        turns = [t[1:] for t in sorted(turns)]
        loss = "".join(t for role, t in turns if role == "assistant")
        text = "".join(f"{role}\n{t}\n" for role, t in turns)
        made, _ = chat.format_turns(turns)
        assert tuple(got[i]) == (i, len(turns), digest(text), len(loss), digest(loss), len(made))
        inside = made
        for role, t in turns:  # no control string but those that mark turns
            inside = inside.replace(f"{chat.START}{role}\n", "", 1).replace(f"{chat.END}\n", "", 1)
        assert not any(c in inside for c in chat.CONTROL)
