"""Chat formatting: layouts, fingerprints, escapes, long conversations, odd rows."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import differences
from pyspark.sql import functions as F

from threadline.llm import chat
from threadline.llm.queries import OP11_SQL, op11_chat

DDL = "conv_id long, turn long, role string, text string"
BITS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE:", "[:ROLE]", "[/ROLE]", "\\", "<", "[", "<\\s>", "[\\\\INST]", " ", "\n", "é😀", "x"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[:ROLE]", "<", "ROLE:"]), st.lists(st.sampled_from(BITS), max_size=9).map("".join)), max_size=4))
def test_marks_and_escapes_are_reversible(turns):
    import re

    def escaped(t):
        return re.sub(chat.ESCAPE, lambda m: f"{m[1]}\\{m[2]}{m[3]}", t)

    out = ""
    for role, text in turns:
        a, b = chat.MARKS.get(role) or (f"{chat.OTHER[0]}{escaped(role)}{chat.OTHER[1]}", chat.OTHER[2])
        out += a + escaped(text) + b
    assert chat.parsed(out) == turns


RECORDS = {
    "pair": ({"prompt": "p", "completion": "c", "id": 3}, [("user", "p"), ("assistant", "c")]),
    "instruction": ({"instruction": "a", "output": "b", "history": [["h", "i"]], "meta": {"x": 1}}, [("user", "h"), ("assistant", "i"), ("user", "a"), ("assistant", "b")]),
    "instruction with input": ({"instruction": "a", "input": "more", "output": "b"}, [("user", "a\n\nmore"), ("assistant", "b")]),
    "exchange": ({"system": "s", "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]}, [("system", "s"), ("user", "a"), ("assistant", "")]),
    "messages": ({"messages": [{"role": "human", "content": "x"}]}, [("human", "x")]),
    "typed": ({"messages": [{"role": "user", "content": [{"type": "text", "text": "x"}, {"type": "text", "text": "y"}]}]}, [("user", "xy")]),
    "authored": ({"messages": [{"author": {"role": "user"}, "content": {"parts": ["x", "y"]}}]}, [("user", "xy")]),
    "question": ({"question": "q", "response": 7}, [("user", "q"), ("assistant", "7")]),
    "turn": ({"turns": [{"role": "user", "text": "q"}]}, [("user", "q")]),
}


@pytest.mark.parametrize("name", sorted(RECORDS))
def test_layouts(name):
    record, turns = RECORDS[name]
    assert converted(record)[1:3] == (name, turns)


def converted(record):
    return chat.converted(record if record is None or isinstance(record, str) else json.dumps(record), chat.registered())


def test_fingerprints_know_paths_not_values():
    a = {"prompt": "p", "completion": "c"}
    assert converted(a)[0] == converted({"completion": None, "prompt": "other", "source": "s"})[0]
    assert converted(a)[0] != converted(a | {"score": 1})[0]
    assert converted(a | {"score": {"by": 1}}) == (chat.fingerprint({"prompt", "completion", "score.by"}), None, [], ["completion", "prompt", "score.by"])
    for odd in (None, "", "[1]", "{", "7"):
        assert converted(odd) == (None, None, [], [])
    assert converted({"instruction": "a", "output": "b", "history": [["only one"]]})[1] is None
    with pytest.raises(ValueError, match="same paths"):
        chat.registered((*chat.LAYOUTS, chat.Layout("again", (chat.One("user", ("completion",)), chat.One("assistant", ("prompt",))))))


def test_odd_rows_and_long_conversations(spark):
    long = [(9, i, "user" if i % 2 == 0 else "assistant", f"turn {i} [INST] " + "word " * (i % 50)) for i in range(999)]
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, None, "assistant", "</s>"), (2, 0, "assistant", ""), (3, 0, "tool", "z" * 700_000), (3, 1, "assistant", "[/INST]"), *long]
    table = spark.createDataFrame(rows, DDL).withColumn("part", F.lit("x")).withColumn("record", F.lit("y")).withColumn("seq", F.lit(0))
    records = chat.records_of(table)
    assert records.where("conv_id = 9").count() == 16
    found = chat.canonical(records)
    assert found.where("layout is null").isEmpty()
    parts = chat.formatted(chat.turns(found), part_chars=2000)
    assert parts.where("id = 9").count() > 30
    assert parts.where("id = 9").agg(F.max(F.length("text"))).first()[0] < 2000 + 400
    got = {r.id: r for r in chat.digests(parts).collect()}
    back = {}
    for r in chat.read(parts).orderBy("part", "pos").collect():
        back.setdefault(r.id, []).append((r.role, r.text))
    want = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] or -1)):
        want.setdefault(c, []).append((role or "", text or ""))
    assert back == want
    for c, turns in want.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].n_turns, got[c].loss_chars, got[c].loss_sha256) == (len(turns), len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.round_trip(chat.records_of(table.where("false"))).count() == 0


def test_unknown_records_come_back(spark):
    df = spark.createDataFrame([("a", 0, '{"prompt":"p","completion":"c"}'), ("b", 0, '{"x":1}'), ("c", 0, None)], "conv_id string, part long, record string")
    got = {r.id: (r.layout, r.unknown) for r in chat.canonical(df).collect()}
    assert got == {"a": ("pair", []), "b": (None, ["x"]), "c": (None, [])}


def test_against_sql(spark, tiny):
    assert differences(spark, op11_chat, OP11_SQL, tiny) == ([], [])


def test_layouts_are_mixed(spark, tiny):
    found = chat.canonical(chat.records_of(spark.read.parquet(f"{tiny}/conversations.parquet")))
    assert found.select("layout").distinct().count() >= 4
