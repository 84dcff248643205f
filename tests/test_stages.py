"""Stages end to end: files in, files out, counts, limits, training rows."""

import json

from pyspark.sql import functions as F

from turnloom.operators import tokens
from turnloom.plans import stages
from turnloom.functions.joins import with_key_stats
from turnloom.sources import jsonl


def lines(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def test_all_stages(spark, tmp_path):
    root = str(tmp_path / "out")
    texts = lines(tmp_path / "wiki.jsonl", [{"text": f" t{i} "} for i in range(5)] + [{"text": " "}, {"x": 1}])
    web = lines(tmp_path / "web.jsonl", [{"text": f"w{i}"} for i in range(9)])
    assert stages.pretrain(spark, root, texts) == {"accepted": 5}
    assert stages.pretrain(spark, root, texts, web, limit=2, web_limit=3) == {"accepted": 5}
    assert sorted(r["text"] for r in jsonl.read_text(spark, f"{root}/pretrain_ko").collect()) == ["t0", "t1", "w0", "w1", "w2"]

    chats = [{"conversations": [{"from": "human", "value": f"q{i}"}, {"from": "gpt", "value": "a"}]} for i in range(6)]
    chats += [{"instruction": "i", "output": "o"}, {"instruction": "i"}, {"messages": [{"role": "user", "content": "m"}]}]
    source = lines(tmp_path / "chat.jsonl", chats)
    assert stages.sft(spark, root, source) == {"accepted": 8, "skipped": 1, "broken": 0}
    assert jsonl.read_chat(spark, f"{root}/sft_ko_mini").where(F.size("conversations") > 0).count() == 8
    assert stages.sft(spark, root, source, limit=3, force=True) == {"accepted": 3, "skipped": 0, "broken": 0}
    got = [r["conversations"][0]["content"] for r in jsonl.read_chat(spark, f"{root}/sft_ko_mini").collect()]
    assert sorted(got) == ["q0", "q1", "q2"]

    assert stages.rlaif(spark, root, n=2) == {"accepted": 2}
    assert all(json.loads(r["value"])["conversations"] for r in spark.read.text(f"{root}/rlaif_ko").collect())

    pair = {"chosen": [{"role": "user", "content": "q"}], "rejected": [{"role": "user", "content": "r"}]}
    assert stages.dpo(spark, root, lines(tmp_path / "dpo.jsonl", [pair, {"chosen": pair["chosen"]}])) == {"accepted": 1, "skipped": 1, "broken": 0}

    dialogs = [{"messages": [{"role": "user", "content": "q"}], "functions": "[1]"}, {"conversations": [{"from": "observation", "value": "x"}]}, {}]
    assert stages.agent_rl(spark, root, lines(tmp_path / "d.jsonl", dialogs)) == {"accepted": 2, "skipped": 1, "broken": 0}
    rows = {r["conversations"][0]["role"]: r for r in jsonl.read_rl(spark, f"{root}/agent_rl_ko").collect()}
    assert rows["system"]["conversations"][0]["tools"] == "[1]" and rows["system"]["gt"] == [] and "tool" in rows

    maths = [{"question": "q", "chosen": [{"role": "assistant", "content": "= 1,200"}]}, {"prompt": "p", "answer": "5 ends."}, {"instruction": "i", "output": "x 42"}, {"output": "1"}]
    assert stages.agent_rl_math(spark, root, lines(tmp_path / "m.jsonl", maths)) == {"accepted": 3, "skipped": 1, "broken": 0}
    assert sorted(r["gt"][0] for r in jsonl.read_rl(spark, f"{root}/agent_rl_math_ko").collect()) == ["1200", "42", "5"]


def test_training_rows(spark):
    msg = [("user", "q", None, None, None), ("assistant", "answer", None, None, None)]
    chats = spark.createDataFrame([(i, msg) for i in range(50)], "id bigint, conversations array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>")
    rows = stages.training_rows(chats, "id", max_length=200, batch_size=8, epochs=2, world=2).collect()
    again = stages.training_rows(chats.repartition(7), "id", max_length=200, batch_size=8, epochs=2, world=2).collect()
    assert len(rows) == 100 and all(len(r["ids"]) == 200 == len(r["labels"]) for r in rows)
    key = lambda r: (r["epoch"], r["pos"])
    assert sorted(rows, key=key) == sorted(again, key=key)
    lengths = {sum(x != 0 for x in r["ids"]) for r in rows}
    assert len(lengths) >= 3  # some with a system prompt, some with the empty think block
    opening, closing = tokens.answer_marks()
    assert all(sum(x != -100 for x in r["labels"]) >= len("answer") + len(closing) for r in rows) and opening[0] == 1
    assert {r["rank"] for r in rows} == {0, 1}


def test_chosen_as_text_and_answers_as_text(spark, tmp_path):
    """A solution may be plain text or a list of messages; an expected answer may be one string."""
    lines = ['{"question": "q1", "chosen": "so it is 42"}', '{"question": "q2", "chosen": [{"role": "assistant", "content": "it is 1,200"}]}', '{"question": "q3", "chosen": ""}']
    (tmp_path / "math.jsonl").write_text("\n".join(lines))
    out = stages.agent_rl_math(spark, str(tmp_path / "out"), str(tmp_path / "math.jsonl"))
    assert out == {"accepted": 2, "skipped": 1, "broken": 0}
    (tmp_path / "rl.jsonl").write_text('{"conversations": [], "gt": "7"}\n{"conversations": [], "gt": ["8", "9"]}\n{"conversations": [], "gt": ""}\n')
    assert sorted(r["gt"] for r in jsonl.read_rl(spark, str(tmp_path / "rl.jsonl")).collect()) == [[], ["7"], ["8", "9"]]


def test_equal_rows_of_a_hot_key_spread(spark):
    """Salts are by place: equal rows of one key don't meet in one partition."""
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select(F.lit("k").alias("key"), F.lit(1).alias("x")).repartition(4)
    stats = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("x").alias("s"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = with_key_stats(rows, stats, "key", "n", hot_rows=1000)
        sizes = [r["c"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("c")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and len(sizes) > 1 and max(sizes) < 15_000


def test_skips_before_the_limit_and_broken_lines(spark, tmp_path):
    rows = ['{"instruction": "a", "output": "b"}', "{broken", '{"instruction": "only"}', '{"instruction": "c", "output": "d"}', '{"x": 1}', '{"instruction": "e", "output": "f"}']
    (tmp_path / "chat.jsonl").write_text("\n".join(rows))
    root, source = str(tmp_path / "out"), str(tmp_path / "chat.jsonl")
    assert stages.sft(spark, root, source, limit=2) == {"accepted": 2, "skipped": 1, "broken": 1}
    assert stages.sft(spark, root, source, limit=9, force=True) == {"accepted": 3, "skipped": 2, "broken": 1}


def test_first_lines_over_many_blocks(spark, tmp_path):
    """The cut falls into any block; only that block is ranked."""
    for k in range(4):
        (tmp_path / f"part-{k}.txt").write_text("".join(f"{k}-{i}\n" for i in range(5)))
    want = [f"{k}-{i}" for k in range(4) for i in range(5)]
    for n in (1, 5, 6, 14, 20, 30):
        assert sorted(r["value"] for r in jsonl.read_lines(spark, str(tmp_path), n).collect()) == want[:n]
