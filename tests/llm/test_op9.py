"""Layouts become the same turns; formatting reads back exactly."""

import json
import random

import pytest

from geotally.llm import op9_chat as op

TURNS = [("user", "hi"), ("assistant", "yes\n<|im_end|>")]
RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yes\n<|im_end|>"}]},
    "from_value": {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yes\n<|im_end|>"}], "id": 7},
    "instruction": {"instruction": "hi", "input": "", "output": "yes\n<|im_end|>"},
    "prompt_completion": {"prompt": "hi", "completion": "yes\n<|im_end|>", "meta": {"source": "x", "tags": ["a"]}},
    "prompt_response": {"prompt": "hi", "response": "yes\n<|im_end|>"},
    "question_answer": {"question": "hi", "answer": "yes\n<|im_end|>"},
    "turn_rows": {"turns": [{"turn": 1, "role": "assistant", "text": "yes\n<|im_end|>"}, {"turn": 0, "role": "user", "text": "hi"}]},
}


def test_layouts(spark):
    rows = [(k, json.dumps(v), 1) for k, v in RECORDS.items()] + [("unknown", '{"a": 1}', 1), ("broken", "{", 1), ("null", None, 1), ("list", "[1]", 1)]
    got = {r.name: r for r in op.canonical_turns(spark.createDataFrame(rows, "name string, record string, extra int")).collect()}
    for name in RECORDS:
        assert got[name].layout == name and [tuple(t) for t in got[name].turns] == TURNS, name
    assert all(got[n].turns is None for n in ("unknown", "broken", "null", "list"))
    assert got["messages"].fingerprint != got["from_value"].fingerprint


def test_system_and_input_fields():
    known = op.known_layouts()
    record = {"system": "be kind", "instruction": "sum", "input": "1 2", "output": "3"}
    _, mapping = op.select(op.field_paths(record), known)
    assert op.apply_mapping(record, mapping) == [("system", "be kind"), ("user", "sum\n\n1 2"), ("assistant", "3")]


def test_any_turns_read_back():
    rnd = random.Random(6)
    bits = ["<", "|", "\\", "im_end", "|>", "<|im_end|>", "<|im_start|>", "\n", "é🙂", "<\\|", "assistant"]
    for _ in range(3000):
        turns = [("".join(rnd.choice(bits) for _ in range(rnd.randint(0, 3))) if rnd.random() < 0.5 else "assistant", "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 6)))) for _ in range(rnd.randint(0, 4))]
        text, loss = op.render(turns)
        assert op.read_back(text) == turns
        assert [op.unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]
        assert text.count(op.START) == text.count(op.END) == len(turns)


@pytest.mark.parametrize("rows,expected", [
    ([(1, 1, "assistant", None), (1, 0, "user", "q"), (1, 1, "assistant", "b")], [("user", "q"), ("assistant", ""), ("assistant", "b")]),
    ([(None, None, None, None)], [("", "")]),
    ([(2, 0, "user", "x"), (2, 0, "user", "x")], [("user", "x"), ("user", "x")]),
    ([(3, 0, "human", "x"), (3, 1, "model", "y"), (3, 2, "gpt", "z")], [("human", "x"), ("model", "y"), ("gpt", "z")]),
])
def test_rows_by_turn(spark, rows, expected):
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    found = op.format_chat(op.canonical_turns(op.turn_records(df))).collect()
    assert len(found) == 1 and op.read_back(found[0].formatted) == expected


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert op.read_digests(op.format_chat(op.canonical_turns(op.turn_records(empty)))).count() == 0


def test_query_equals_its_twin_on_foreign_role_names(spark, tmp_path):
    import duckdb

    rows = [(1, 0, "human", "a <| b"), (1, 1, "model", "c"), (2, 0, "prompter", None), (2, 1, "assistant", "d"), (3, 0, "bot", "e"), (3, 1, "gpt", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    df = op.op9_chat(spark, str(tmp_path))
    twin = con.execute(op.SQL)
    at = [[d[0] for d in twin.description].index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(r[i] for i in at) for r in twin.fetchall())
