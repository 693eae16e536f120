import hashlib
import json

import pytest
from helpers import rows
from hypothesis import given
from hypothesis import strategies as st

from trackloom.llm import chat_format as C

texts = st.text(alphabet="<|\\im_start>\n aé", max_size=30)


@given(texts, texts)
def test_round_trip(role, text):
    piece, start, end = C.format_turn(role, text)
    assert C.START not in C.escape(text) and C.END not in C.escape(text)
    back = C._PIECE.fullmatch(piece).groups()
    assert (C.unescape_role(back[0]), C.unescape(back[1])) == (role, text)
    assert C.unescape(piece[start:end]) == (text if role == "assistant" else "")


@pytest.mark.parametrize(("record", "turns", "layout"), [
    ({"role": "user", "text": "a"}, [("user", "a")], "turn"),
    ({"role": None, "text": None}, [("", "")], "turn"),
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 3}, [("user", "a"), ("assistant", "b")], "messages"),
    ({"messages": []}, [], "messages"),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")], "conversations"),
    ({"instruction": "a", "input": "", "output": "c"}, [("user", "a"), ("assistant", "c")], "instruction"),
    ({"system": "s", "instruction": "a", "input": "b", "output": "c"}, [("system", "s"), ("user", "a"), ("user", "b"), ("assistant", "c")], "instruction"),
    ({"prompt": "a", "completion": "b"}, [("user", "a"), ("assistant", "b")], "prompt"),
    ({"prompt": "a", "response": "b"}, [("user", "a"), ("assistant", "b")], "response"),
    ({"question": "a", "answer": "b"}, [("user", "a"), ("assistant", "b")], "question"),
])
def test_layouts(spark, record, turns, layout):
    df = spark.createDataFrame([(1, 0, json.dumps(record))], "c long, p long, r string")
    out = C.canonical_turns(df, "c", "p", "r").orderBy("turn").collect()
    assert [(r.role, r.text) for r in out] == turns and all(r.layout == layout for r in out)


def test_unknown_records_are_reported(spark):
    df = spark.createDataFrame([(1, 0, '{"odd": 1}'), (2, 0, "no json"), (3, 0, None), (4, 0, "[]")], "c long, p long, r string")
    assert {(r.conv_id, r.role, r.layout) for r in C.canonical_turns(df, "c", "p", "r").collect()} == {(k, None, "unknown") for k in (1, 2, 3, 4)}


def test_digests_over_batches_and_repeats(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        data = [(c, t, ("user", "assistant")[t % 2], f"text {c} {t} <|im_end|>" if t % 5 else None) for c in (1, 2, None) for t in range(20)] + [(1, 0, "user", None)]
        df = spark.createDataFrame(data, "conv_id long, place long, role string, text string").selectExpr("*", "0 AS turn").repartition(4)
        got = {r.conv_id: r for r in C.read_back(C.format_turns(df)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for c in (1, 2, None):
        mine = sorted(((t, r, x or "") for k, t, r, x in data if k == c))
        assert got[c].n_turns == len(mine)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest()
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert rows(C.read_back(C.format_turns(df.limit(0)))) == []


@pytest.mark.parametrize("role", ["human", "gpt", "bot", "model", "tool\nx"])
def test_rows_of_turns_keep_their_roles(spark, role):
    df = spark.createDataFrame([(1, 0, json.dumps({"role": role, "text": "a"}))], "c long, p long, r string")
    turns = C.canonical_turns(df, "c", "p", "r")
    assert [r.role for r in turns.collect()] == [role]
    out = C.read_back(C.format_turns(turns)).first()
    assert out.turns_sha256 == hashlib.sha256(f"{role}\na\n".encode()).hexdigest() and out.loss_chars == 0


def test_clashing_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, 0, json.dumps({"role": "user", "text": "a"}), 9, "x", "y", "z")], "c long, p long, r string, turn long, role string, text string, layout string")
    turns = C.canonical_turns(df, "c", "p", "r")
    assert [tuple(x) for x in turns.collect()] == [(1, 0, 0, "user", "a", "turn")]
    assert C.read_back(C.format_turns(turns.selectExpr("*", "1 AS formatted", "2 AS n_turns"))).first().n_turns == 1
