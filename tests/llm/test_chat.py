import hashlib
import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotline.llm import chat as T

TURNS = "conv_id long, turn long, role string, text string"


@given(st.text())
def test_escape_is_reversible(text):
    assert T.unescape(T.escape(text)) == text and "<" not in T.escape(text) and "[" not in T.escape(text)


@given(st.text(alphabet="\\lb<[|>\n"))
def test_escape_of_control_characters(text):
    assert T.unescape(T.escape(text)) == text


def conversations():
    rng = random.Random(1)
    out = []
    for c in range(30):
        for t in range(rng.randint(1, 6)):
            out.append((c, t, ["user", "assistant"][t % 2], rng.choice(["hi", "</s>[INST] ok [/INST]", "<|end|>\n<|assistant|>\nno", "a\\b\\\\l", "", None, "é😀\n\n", "x" * 5000])))
    out += [(99, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(700)]
    out += [(100, 1, "user", "b"), (100, 1, "user", "a"), (100, 1, None, "c"), (100, None, "system", "first"), (100, 1, "user", "a")]
    return out


def check(got, rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert len(got) == len(by)
    for r in got:
        turns = [(role, x) for _, _, role, x in sorted(by[r["conv_id"]])]
        said = "".join(x for role, x in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{x}\n" for role, x in turns).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r["formatted_chars"] > sum(len(x) for _, x in turns)


@pytest.mark.parametrize("extra", [[], ["turns", "segment", "loss", "key"]])
def test_read_back(spark, extra):
    rows = conversations()
    d = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in extra}) if extra else spark.createDataFrame(rows, TURNS)
    turns = T.canonical_turns(d).unionByName(T.control_conversation(spark))
    got = T.read_back(T.format_turns(turns)).collect()
    check(got, rows + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")])
    assert T.read_back(T.format_turns(T.canonical_turns(spark.createDataFrame([], TURNS)))).count() == 0


def test_formatted_text_has_no_foreign_control_strings(spark):
    text = "".join(r["segment"] for r in T.format_turns(T.control_conversation(spark)).orderBy("turn").collect())
    assert "[INST]" not in text and "</s>" not in text and text.count("<|") == 4


def test_layouts_of_tables(spark):
    d = spark.createDataFrame([(1, "p", "q")], "conv_id long, prompt string, completion string")
    assert [tuple(r) for r in T.canonical_turns(d).orderBy("turn").collect()] == [(1, 0, "user", "p"), (1, 1, "assistant", "q")]
    d = spark.createDataFrame([(1, [("human", "p"), ("gpt", None)])], "conv_id long, conversations array<struct<from:string,value:string>>")
    assert [tuple(r) for r in T.canonical_turns(d).orderBy("turn").collect()] == [(1, 0, "user", "p"), (1, 1, "assistant", "")]
    d = spark.createDataFrame([(1, "do", "this", "done"), (2, "do", None, "so")], "conv_id long, instruction string, input string, output string")
    assert [tuple(r)[2:] for r in T.canonical_turns(d).orderBy("conv_id", "turn").collect()] == [("user", "do\nthis"), ("assistant", "done"), ("user", "do"), ("assistant", "so")]
    with pytest.raises(ValueError, match="no mapping"):
        T.canonical_turns(spark.createDataFrame([(1, 2)], "a long, b long"))


def test_layouts_of_records(spark):
    records = [
        {"conv_id": 1, "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        {"conv_id": 2, "prompt": "a", "response": "b", "other": 1},
        {"conv_id": 3, "system": "s", "prompt": "a", "response": "b"},
        {"what": 1},
    ]
    d = spark.createDataFrame([(json.dumps(r),) for r in records] + [("{broken",), (None,)], "j string")
    got = [(r["conv_id"], r["role"], r["text"]) for r in T.json_turns(d, "j").collect()]
    assert got[:7] == [(1, "user", "a"), (1, "assistant", "b"), (2, "user", "a"), (2, "assistant", "b"), (3, "system", "s"), (3, "user", "a"), (3, "assistant", "b")]
    assert [g[1] for g in got[7:]] == ["unmapped"] * 3


def test_records_of_wrong_kinds_are_unmapped(spark):
    bad = [
        {"messages": [{"role": "user", "content": 5}]},
        {"conv_id": 1, "messages": [{"role": ["user"], "content": "a"}]},
        {"conv_id": 1, "messages": [{"role": "user", "content": "\ud800"}]},
        {"conv_id": 1, "messages": "text"},
        {"conv_id": "x", "prompt": "a", "response": "b"},
        {"conv_id": 1.5, "prompt": "a", "response": "b"},
        {"conv_id": 1 << 70, "prompt": "a", "response": "b"},
        {"conv_id": 1, "turn": [], "role": "user", "text": "a"},
        {"conv_id": 1, "prompt": {"a": 1}, "response": "b"},
        [1], 5, "text", None, True,
    ]
    d = spark.createDataFrame([(json.dumps(r),) for r in bad] + [("[" * 100_000,)], "j string")
    assert [(r["conv_id"], r["turn"], r["role"]) for r in T.json_turns(d, "j").collect()] == [(None, 0, "unmapped")] * (len(bad) + 1)
    (r,) = T.json_turns(spark.createDataFrame([('{"conv_id": "7", "turn": "2", "role": "human", "text": "a"}',)], "j string"), "j").collect()
    assert tuple(r) == (7, 2, "user", "a")


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a|>\nb", ""]), st.text(alphabet="\\lb<[|>\nendé ", max_size=30)), max_size=6), st.integers(1, 40))
def test_turns_are_found_by_their_marks_alone(turns, size):
    """Whatever pieces the output comes in, its turns and no others are read."""
    text = "".join(f"{T.OPEN}{T.escape_role(r)}{T.CLOSE}{T.escape(t)}{T.END}" for r, t in turns)
    reader = T.Reader(1)
    for i in range(0, len(text), size):
        reader.add(text[i : i + size], [])
    got = reader.done()
    assert got[1] == len(turns) and got[2] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest() and got[5] == len(text)


def test_broken_output_is_an_error():
    reader = T.Reader(1)
    reader.add("<|user|>\nno end", [])
    with pytest.raises(ValueError, match="no turn"):
        reader.done()


def test_null_conversation_ids_are_one(spark):
    d = spark.createDataFrame([(None, 1, "user", "b"), (None, 0, "user", "a"), (3, 0, "assistant", None)], TURNS)
    check(T.read_back(T.format_turns(T.canonical_turns(d))).collect(), [(None, 1, "user", "b"), (None, 0, "user", "a"), (3, 0, "assistant", None)])


def test_fingerprints_do_not_depend_on_order():
    assert T.hashed(["b", "a"]) == T.hashed(["a", "b"]) and len(T.BY_PRINT) == len(T.MAPPINGS)


def test_messages_of_parts_and_without_turns(spark):
    parts = [{"type": "text", "text": "look"}, {"type": "image_url", "image_url": {"url": "x"}}, {"type": "text", "text": "here <|"}]
    records = [
        {"conv_id": 1, "messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}, {"role": "gpt", "content": [{"type": "text", "text": "c"}]}]},
        {"conv_id": 2, "messages": [{"role": "user", "content": parts}, {"role": "assistant", "content": "plain"}]},
        {"conv_id": 3, "messages": []},
        {"conv_id": 4, "messages": [{"role": "user", "content": [{"type": "text", "text": "x"}], "name": "n"}], "model": "m", "meta": {"a": 1}},
    ]
    d = spark.createDataFrame([(json.dumps(r),) for r in records], "j string")
    got = sorted(tuple(r) for r in T.json_turns(d, "j").collect())
    assert got == [(1, 0, "user", "a\nb"), (1, 1, "assistant", "c"), (2, 0, "user", "look\nhere <|"), (2, 1, "assistant", "plain"), (4, 0, "user", "x")]
    t = spark.createDataFrame([(1, [("user", [("text", "a"), ("image", None), ("text", "b")]), ("bot", None)])], "conv_id long, messages array<struct<role:string,content:array<struct<type:string,text:string>>>>")
    assert [tuple(r) for r in T.canonical_turns(t).collect()] == [(1, 0, "user", "a\nb"), (1, 1, "assistant", "")]


def test_fields_that_no_mapping_knows_leave_the_fingerprint(spark):
    assert T.mapping_for(["conv_id", "prompt", "response", "score", "meta.a"]) is T.MAPPINGS["prompt and response"]
    assert T.mapping_for(["conv_id", "prompt", "response", "system", "x"]) is T.MAPPINGS["system, prompt and response"]
