"""Rendering against a plain Python renderer, borders, decisions, parsing back."""

import json
import random

from pyspark.sql import functions as F

from turnloom import constants as K
from turnloom.functions.jsontext import call_items, json_items, read_calls
from turnloom.operators import chat, normalize, toolcalls


SYS, USER, BOT, END = "<|im_start|>system\n", "<|im_start|>user\n", "<|im_start|>assistant\n<think>\n", "<|im_end|>\n"
TOOLS = [{"name": "f", "d": "설명"}, {"name": "g"}]
HEAD = K.TOOLS_HEAD + '\n{"name": "f", "d": "설명"}\n{"name": "g"}' + K.TOOLS_TAIL
# (messages as role, content, reasoning, calls), prompt without tools, start of the prompt with tools
RENDERED = [
    ([("user", "hi", None, None)], USER + "hi" + END, SYS + HEAD),
    ([("system", "S", None, None), ("user", "", None, None)], SYS + "S" + END + USER + END, SYS + "S\n\n" + HEAD),
    ([("user", "u", None, None), ("system", "later", None, None)], USER + "u" + END + SYS + "later" + END, SYS + HEAD),
    ([("assistant", "\nx\n", None, None)], BOT + "\n</think>\n\nx\n" + END, SYS + HEAD),
    ([("assistant", "<think>\nwhy\n</think>\n\nso", None, None)], BOT + "why\n</think>\n\nso" + END, SYS + HEAD),
    ([("assistant", "a</think>b", None, None)], BOT + "a\n</think>\n\nb" + END, SYS + HEAD),
    ([("assistant", "<think>open", None, None)], BOT + "\n</think>\n\n<think>open" + END, SYS + HEAD),
    ([("assistant", "q</think></think>r", None, None)], BOT + "q\n</think>\n\nr" + END, SYS + HEAD),
    ([("assistant", "a</think>b", "\nr\n", None)], BOT + "r\n</think>\n\na</think>b" + END, SYS + HEAD),
    (
        [("assistant", "", None, '[{"name": "f", "arguments": {"a": "가"}}]')],
        BOT + '\n</think>\n\n<tool_call>\n{"name": "f", "arguments": {"a": "가"}}\n</tool_call>' + END, SYS + HEAD,
    ),
    (
        [("assistant", "hi", None, '[{"function": {"name": "g", "arguments": "{}"}}, {"name": "h", "arguments": {"b": 1.5}}]')],
        BOT + '\n</think>\n\nhi\n<tool_call>\n{"name": "g", "arguments": {}}\n</tool_call>\n<tool_call>\n{"name": "h", "arguments": {"b": 1.5}}\n</tool_call>' + END,
        SYS + HEAD,
    ),
    (
        [("tool", "1", None, None), ("tool", "2", None, None), ("user", "u", None, None), ("tool", "3", None, None)],
        "<|im_start|>user\n<tool_response>\n1\n</tool_response>\n<tool_response>\n2\n</tool_response>" + END + USER + "u" + END
        + "<|im_start|>user\n<tool_response>\n3\n</tool_response>" + END,
        SYS + HEAD,
    ),
]


def test_rendered_prompts(spark):
    rows = [(i, [{"role": r, "content": c, "reasoning_content": k, "tools": None, "tool_calls": x} for r, c, k, x in m]) for i, (m, _, _) in enumerate(RENDERED)]
    df = spark.createDataFrame(rows, F_SCHEMA)
    calls = df.select("i", F.posexplode("m").alias("p", "x")).select("i", "p", call_items("x.tool_calls").alias("c"))
    calls = calls.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "c"))), lambda s: s["c"]).alias("calls"))
    df = df.join(calls, "i").withColumn("lines", json_items(F.lit(json.dumps(TOOLS))))
    got = df.select("i", chat.render(F.col("m"), None, F.col("calls")).alias("plain"), chat.render(F.col("m"), F.col("lines"), F.col("calls")).alias("tooled"))
    for r in got.collect():
        messages, plain, start = RENDERED[r["i"]]
        assert r["plain"] == plain
        lead = SYS + messages[0][1] + END if messages[0][0] == "system" else ""
        assert r["tooled"] == start + plain.removeprefix(lead)


F_SCHEMA = "i int, m array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>"


def turns_of(rng, n):
    return [(0, i, rng.choice(["user", "assistant", "tool", "tool", "system"]), rng.choice(["x", "</think>y", "가"])) for i in range(n)]


def test_parts_join_to_the_whole(spark):
    """Splitting a long conversation anywhere does not change its prompt."""
    rng = random.Random(5)
    turns = turns_of(rng, 97)
    whole = spark.createDataFrame([(0, [(r, t, None, None, None) for _c, _i, r, t in turns])], F_SCHEMA)
    want = whole.select(chat.render(F.col("m"))).first()[0]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    for size in (1, 2, 3, 10, 1024):
        parts = chat.render_parts(chat.assemble_parts(df, size)).orderBy("part").collect()
        assert max(len(p["messages"]) for p in parts) <= size
        assert "".join(p["prompt"] for p in parts) == want
    assert "".join(r["piece"] for r in chat.render_turns(df).orderBy("turn").collect()) == want


def test_prompt_reads_back(spark):
    msgs = [("system", "S"), ("user", " u \n"), ("assistant", "a"), ("user", "b")]
    df = spark.createDataFrame([([(r, c, None, None, None) for r, c in msgs],)], "m array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>")
    back = df.select(chat.parse_prompt(chat.render(F.col("m"))).alias("p")).first()["p"]
    assert [(b["role"], b["content"]) for b in back] == [("system", "S"), ("user", "u"), ("assistant", "<think>\n\n</think>\n\na"), ("user", "b")]


def test_inject_and_split(spark):
    conv = [(i, [("user", "q", None, None, None), ("assistant", "a", None, None, None)]) for i in range(2000)]
    conv += [(9000, [("system", "s", None, None, None)]), (9001, [("user", "q", None, "[1]", None)])]
    df = spark.createDataFrame(conv, "i bigint, m array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>")
    out = df.select("i", chat.inject_system(F.col("m"), F.col("i")).alias("m")).collect()
    added = [r for r in out if r["i"] < 9000 and len(r["m"]) == 3]
    assert 300 < len(added) < 500 and len({r["m"][0]["content"] for r in added}) == 10
    assert all(len(r["m"]) == 1 for r in out if r["i"] >= 9000)
    one = df.where("i = 9001").select(chat.prompt_messages(F.col("m")).alias("p"), chat.conversation_tools(F.col("m")).alias("t")).first()
    assert one["p"] == [] and one["t"] is None


def test_history_rules(spark):
    df = spark.createDataFrame([([("user", str(k), None, None, None) for k in range(3)],)], F_SCHEMA.split(", ", 1)[1])
    sizes = df.select(
        F.size(chat.last_messages(F.col("m"), 9)), F.size(chat.history_for_prompt(F.col("m"), 0)), F.size(chat.history_for_client(F.col("m"), 0)),
        F.size(chat.history_for_page(F.col("m"), 1, F.lit(False))),
    ).first()
    assert tuple(sizes) == (3, 0, 1, 3)


def test_tool_json(spark):
    bodies = ["[1]", "{'a':1}", '{"a":1} x', '{"name":"get_exchange_rate","arguments":{"from_currency":"USD","to_currency":""}}',
              '{"name":"unit_converter","arguments":"{\\"value\\": 0, \\"from_unit\\": \\"km\\", \\"to_unit\\": \\"m\\"}"}', '{"name":"unit_converter","arguments":"oops"}', "NaN", ""]
    text = "".join(f"<tool_call>{b}</tool_call>" for b in bodies)
    df = spark.createDataFrame([(1, text)], "sample_id int, t string")
    calls = toolcalls.check_calls(toolcalls.explode_calls(df, F.col("t")), toolcalls.registry(spark)).orderBy("pos").collect()
    assert [c["status"] for c in calls] == ["other_json", "invalid", "invalid", "object", "object", "object", "other_json", "invalid"]
    assert [c["valid"] for c in calls] == [False, False, False, False, True, False, False, False]
    assert calls[5]["arguments"] == "{}"
    kept = df.select(toolcalls.kept_calls(read_calls(chat.call_bodies(F.col("t")))).alias("k")).first()["k"]
    assert [k["pos"] for k in kept] == [3, 4, 5]


def test_unknown_tool_is_an_error(spark):
    import pytest

    names = spark.createDataFrame([("nope",)], "name string")
    with pytest.raises(Exception, match="unknown tool: nope"):
        toolcalls.select_tools(names, toolcalls.registry(spark)).collect()


def test_roles_and_shapes(spark):
    from turnloom.schemas import RAW_CHAT_ROW

    rows = [
        {"conversations": [{"from": "narrator", "value": "x"}, {"from": "gpt"}]},
        {"conversations": [{"role": "user", "content": "c"}], "messages": [{"role": "user", "content": "m"}]},
        {"conversations": [], "messages": [{"content": "m"}]},
        {"instruction": "i", "output": ""},
        {"instruction": "i", "input": "n", "output": "o"},
        {"instruction": "i", "input": "", "output": "o"},
        {},
    ]
    full = [{f: r.get(f) for f in RAW_CHAT_ROW.fieldNames()} for r in rows]
    for r in full:
        for key in ("conversations", "messages"):
            if r[key] is not None:
                r[key] = [{n: m.get(n) for n in ("role", "content", "from", "value", "reasoning_content", "tools", "tool_calls")} for m in r[key]]
    df = spark.createDataFrame(full, RAW_CHAT_ROW)
    got = [[(m["role"], m["content"]) for m in r["conversation"]] if r["conversation"] else None for r in normalize.unify_chat(df).collect()]
    assert got == [
        [("user", "x"), ("assistant", "")], [("user", "c")], [("user", "m")], None, [("user", "i\n\nn"), ("assistant", "o")], [("user", "i"), ("assistant", "o")], None,
    ]


def test_attach_tools_without_system(spark):
    df = spark.createDataFrame([([("user", "q", None, None, None)], "[1]"), ([("user", "q", None, None, None)], "")], "m array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>, t string")
    out = [r["o"] for r in df.select(normalize.attach_tools(F.col("m"), F.col("t")).alias("o")).collect()]
    assert [(m["role"], m["content"], m["tools"]) for m in out[0]] == [("system", "", "[1]"), ("user", "q", None)]
    assert len(out[1]) == 1



TURNS = "conv_id bigint, turn bigint, role string, text string, tools string, tool_calls string"


def test_tools_and_calls_in_turns_and_parts(spark):
    """Tools of a late system message stand in the header, calls in their turn, wherever a part ends."""
    call = '[{"name": "f", "arguments": {"x": 1}}]'
    rows = [
        (7, 0, "system", "S", '[{"name": "old"}]', None), (7, 1, "user", "q", None, None), (7, 2, "system", "now", '[{"name":"f"}]', None),
        (7, 3, "assistant", "", None, call), (7, 4, "tool", "1", None, None), (7, 5, "tool", "2", None, None), (7, 6, "assistant", "done", None, None),
        (8, 0, "user", "hi", None, None), (8, 1, "assistant", "yes", None, call),
    ]
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    whole = spark.createDataFrame([(c, [(r[2], r[3], None, r[4], r[5]) for r in rows if r[0] == c]) for c in (7, 8)], F_SCHEMA)
    want = {r["i"]: r["p"] for r in whole.select("i", chat.render_chat(F.col("m")).alias("p")).collect()}
    assert '{"name": "f"}' in want[7] and "old" not in want[7] and want[7].count('{"name": "f", "arguments": {"x": 1}}') == 1
    assert want[8].endswith('yes\n<tool_call>\n{"name": "f", "arguments": {"x": 1}}\n</tool_call><|im_end|>\n') and "# Tools" not in want[8]
    pieces = chat.render_turns(df).orderBy("turn").collect()
    assert {c: "".join(r["piece"] for r in pieces if r["conv_id"] == c) for c in (7, 8)} == want
    for size in (2, 100):
        parts = chat.render_parts(chat.assemble_parts(df, size), with_tools=True).orderBy("part").collect()
        assert {c: "".join(r["prompt"] for r in parts if r["conv_id"] == c) for c in (7, 8)} == want


def test_rules_past_a_thousand_turns(spark):
    """Nothing changes in a conversation of 1,026 turns."""
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"t{k}", None, None) for k in range(1026)]
    rows[3] = (1, 3, "system", "s", "[1]", None)
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    recent = chat.recent_messages(df, 4).select(F.col("messages")["content"]).first()[0]
    assert recent == ["t1022", "t1023", "t1024", "t1025"]
    assert tuple(chat.prompt_summary(df).first()) == (1, 1025, "[1]")
    pieces = [r["piece"] for r in chat.context_pieces(df).orderBy("turn").collect()]
    assert pieces[0] == "user: t0" and pieces[1024] == "\nuser: t1024" and pieces[1025].endswith("t1025") and not pieces[1025].startswith("\n" + "assistant")
