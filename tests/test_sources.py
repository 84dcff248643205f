"""Files: strict and tolerant readers, limits by line, guards, exports."""

import pytest

from turnloom.plans.tables import documents
from turnloom.sources import jsonl


def test_readers_and_writers(spark, tmp_path):
    path = str(tmp_path / "chat")
    df = spark.createDataFrame([([("user", "안녕", None, None, None)],)], "conversations array<struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>>")
    jsonl.write_jsonl(df, path)
    assert "안녕" in spark.read.text(path).first()[0]
    assert jsonl.read_chat(spark, path).first()["conversations"][0]["content"] == "안녕"
    with pytest.raises(Exception, match="(?i)exist"):
        jsonl.write_jsonl(df, path)
    jsonl.write_jsonl(df, path, force=True)


def test_strict_reader_fails_on_a_bad_line(spark, tmp_path):
    f = tmp_path / "rl.jsonl"
    f.write_text('{"conversations": [], "gt": ["1"]}\n{bad\n', encoding="utf-8")
    with pytest.raises(Exception):
        jsonl.read_rl(spark, str(f)).collect()
    f.write_text('{"conversations": [], "gt": ["1"]}\n', encoding="utf-8")
    assert jsonl.read_rl(spark, str(f)).first()["gt"] == ["1"]


def test_rejects_are_kept(spark, tmp_path):
    from turnloom.schemas import TEXT_ROW

    f = tmp_path / "t.jsonl"
    f.write_text('{"text": "a"}\n{bad\n{"x": 1}\n', encoding="utf-8")
    good, bad = jsonl.read_with_rejects(spark, str(f), TEXT_ROW)
    assert sorted(str(r["text"]) for r in good.collect()) == ["None", "a"]
    assert [r[0] for r in bad.collect()] == ["{bad"]


def test_corpus_reader(spark, tmp_path):
    lines = [
        '{"text": "a"}', "{bad}", '{"conversations": [{"content": "x"}, {"content": ""}, {"content": "y"}], "text": "no"}', '{"text": ""}',
        '{"conversations": []}', '{"text": 5}', '{"text": "t"} tail', '{"other": 1}', "{'text': 'q'}", '{"text": "a"}] x [{"b": 1}', '{"text": "a"}, {"text": "b"}',
        '{"text": "a"}} x {"v": 1', '{"text": "nan", "x": NaN}', '{"text": "dup", "text": "last"}', "", "[]", '{"text": "cut',
    ]
    f = tmp_path / "c.jsonl"
    f.write_bytes("\n".join(lines).encode() + b'\n{"text": "b\xffc"}\n')
    got = [r["text"] for r in jsonl.read_corpus(spark, str(f)).orderBy("ord").collect()]
    assert got == ["a", "x\ny", "5", "nan", "last", "bc"]
    assert [r["text"] for r in jsonl.read_corpus(spark, str(f), 2).collect()] == ["a"]


def test_lines(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"f{k}.txt").write_text("".join(f"{k}-{i}\n\n" for i in range(5)))
    assert jsonl.read_raw_lines(spark, str(tmp_path)).count() == 15
    assert [r["value"] for r in jsonl.read_lines(spark, str(tmp_path), 13).orderBy("ord").collect()][-3:] == ["1-0", "", "1-1"]


def test_stage_guards(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        jsonl.stage_output(spark, root, "rlaif")
    path = jsonl.stage_output(spark, root, "sft")
    jsonl.write_jsonl(spark.range(1), path)
    assert jsonl.stage_output(spark, root, "rlaif").endswith("rlaif_ko")
    with pytest.raises(FileExistsError):
        jsonl.stage_output(spark, root, "sft")
    assert jsonl.stage_output(spark, root, "sft", force=True) == path


def test_snapshot_and_peek(spark, tmp_path):
    path = str(tmp_path / "snap")
    df = documents(spark, "/root/testdata/sf0.001")
    jsonl.write_parquet(df.withColumnRenamed("lang", "subset"), path, partition_by=["subset"])
    assert jsonl.read_snapshot(spark, path, subset="de").count() == df.where("lang = 'de'").count()
    schema, sample = jsonl.peek(df)
    assert schema.startswith("struct<doc_id") and len(sample) == 300
    assert jsonl.source_catalogue(spark).count() == 6
