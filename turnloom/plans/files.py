"""Readers, writers and guards, on files that the given tables are written to."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.operators.normalize import message
from turnloom.plans import stages
from turnloom.plans import tables as t
from turnloom.plans.sqltext import strip
from turnloom.session import scratch_path
from turnloom.sources import jsonl


def _text_file(spark, lines, label: str) -> str:
    """Ready-made lines, one per row, in the shared folder."""
    path = scratch_path(spark, label)
    lines.write.text(path)
    return path


def file_text(spark, sf_dir):
    """Texts written as JSON lines and read back."""
    path = scratch_path(spark, "text")
    jsonl.write_jsonl(t.documents(spark, sf_dir).select("text"), path)
    return jsonl.read_text(spark, path)


FILE_TEXT = "select text from documents"


def _asked(kind: str):
    return F.array(message(F.lit("user"), F.col("source")), message(F.lit(kind), F.col("text")))


def file_chat(spark, sf_dir):
    """Conversations written as JSON lines and read with the fixed schema; fields never written are null."""
    path = scratch_path(spark, "chat")
    jsonl.write_jsonl(t.documents(spark, sf_dir).select(_asked("assistant").alias("conversations")), path)
    turns = jsonl.read_chat(spark, path).select(F.posexplode("conversations").alias("pos", "m"))
    return turns.select("pos", "m.role", "m.content", "m.tool_calls")


FILE_CHAT = """select cast(0 as integer) as pos, 'user' as role, source as content, cast(null as varchar) as tool_calls from documents
  union all select 1, 'assistant', text, null from documents"""


def file_pairs(spark, sf_dir):
    """Preference pairs written as JSON lines and read back."""
    path = scratch_path(spark, "pairs")
    jsonl.write_jsonl(t.preference_rows(spark, sf_dir).select("chosen", "rejected"), path)
    last = lambda side: F.try_element_at(side, F.lit(-1))["content"]
    return jsonl.read_pairs(spark, path).select(last("chosen").alias("chosen"), last("rejected").alias("rejected"))


FILE_PAIRS = f"with {t.PAIRS_SQL} select good as chosen, bad as rejected from pairs"


def file_answers(spark, sf_dir):
    """Rollout rows whose expected answer is written as a list, as one string, or as nothing."""
    docs, kind = t.documents(spark, sf_dir), F.col("doc_id") % 4
    chat, id_ = _asked("assistant").alias("conversations"), F.col("doc_id").cast("string")
    lines = (
        F.when(kind == 0, F.to_json(F.struct(chat, F.array(id_, F.lit("x")).alias("gt")))).when(kind == 1, F.to_json(F.struct(chat, id_.alias("gt"))))
        .when(kind == 2, F.to_json(F.struct(chat, F.lit("").alias("gt")))).otherwise(F.to_json(F.struct(chat)))
    )
    rows = jsonl.read_rl(spark, _text_file(spark, docs.select(lines.alias("value")), "answers"))
    return rows.select(F.get("conversations", F.lit(1))["content"].alias("content"), F.array_join("gt", ",").alias("gt"))


FILE_ANSWERS = """select text as content, case doc_id % 4 when 0 then doc_id || ',x' when 1 then cast(doc_id as varchar) when 2 then '' end as gt from documents"""


def file_corpus(spark, sf_dir):
    """Corpus lines of both shapes, with broken ones among them."""
    kind = F.col("doc_id") % 4
    turns = F.array(F.struct(F.col("source").alias("content")), F.struct(F.col("text").alias("content")))
    whole = F.to_json(F.struct("text"))
    line = F.when(kind == 0, whole).when(kind == 1, F.to_json(F.struct(turns.alias("conversations")))).when(kind == 2, F.concat(whole, F.lit(" x"))).otherwise(F.lit("{}"))
    path = _text_file(spark, t.documents(spark, sf_dir).select(line.alias("value")), "corpus")
    return jsonl.read_corpus(spark, path).select("text")


FILE_CORPUS = "select case when doc_id % 4 = 0 then text else source || chr(10) || text end as text from documents where doc_id % 4 < 2 and text <> ''"


def file_lines(spark, sf_dir):
    """Lines of all texts as they are, without blank ones."""
    path = _text_file(spark, t.documents(spark, sf_dir).select(F.replace("text", F.lit("\r"), F.lit("")).alias("value")), "lines")
    return jsonl.read_raw_lines(spark, path).select("value")


FILE_LINES = f"select value from (select unnest(string_split(replace(text, chr(13), ''), chr(10))) as value from documents) where {strip('value')} <> ''"


def file_snapshot(spark, sf_dir):
    """One split and subset of a partitioned copy: the other folders are not read."""
    path = scratch_path(spark, "snapshot")
    split = F.when(F.col("doc_id") % 3 == 0, "test").otherwise("train")
    jsonl.write_parquet(t.documents(spark, sf_dir).select("doc_id", "text", split.alias("split"), F.col("lang").alias("subset")), path, partition_by=["split", "subset"])
    return jsonl.read_snapshot(spark, path, "train", "en").select("doc_id", "text")


FILE_SNAPSHOT = "select doc_id, text from documents where doc_id % 3 <> 0 and lang = 'en'"


def stage_outputs(spark, sf_dir):
    """Stages run on derived files: rows of every output, and what the guards refused."""
    root, source = scratch_path(spark, "stages"), scratch_path(spark, "chats")
    texts = scratch_path(spark, "texts")
    mixed = t.mixed_rows(spark, sf_dir)
    jsonl.write_jsonl(mixed, source)
    jsonl.write_jsonl(t.documents(spark, sf_dir).select("text"), texts)

    def refused(run, error) -> bool:
        try:
            run()
        except error:
            return True
        return False

    early = refused(lambda: stages.rlaif(spark, root), FileNotFoundError)
    counts = {"pretrain_mini": stages.pretrain(spark, root, texts), "pretrain_full": stages.pretrain(spark, root, texts, texts, web_limit=100), "sft": stages.sft(spark, root, source)}
    twice = refused(lambda: stages.sft(spark, root, source), FileExistsError)
    counts["rlaif"] = stages.rlaif(spark, root, n=50)
    out = None
    for stage, seen in counts.items():
        lines = jsonl.read_raw_lines(spark, jsonl.stage_path(root, stage)).agg(F.count("*").alias("n_lines"))
        row = lines.select(F.lit(stage).alias("stage"), "n_lines", F.lit(seen["accepted"]).cast("bigint").alias("accepted"), F.lit(seen.get("skipped", 0)).cast("bigint").alias("skipped"))
        out = row if out is None else out.unionByName(row)
    return out.withColumns({"refused_early": F.lit(early), "refused_twice": F.lit(twice)})


STAGE_OUTPUTS = f"""with n as (select count(*) filter (where {strip("coalesce(text, '')")} <> '') as texts, count(*) as docs from documents),
{t.PARTS_SQL}, m as (select count(*) filter (where doc_id % 5 between 1 and 3 or (doc_id % 5 = 0 and tail <> '')) as fit from parts),
r as (select 'pretrain_mini' as stage, texts as k, 0 as s from n union all select 'pretrain_full', texts + least(texts, 100), 0 from n
  union all select 'sft', fit, docs - fit from n, m union all select 'rlaif', least(fit, 50), 0 from m)
select stage, cast(k as bigint) as n_lines, cast(k as bigint) as accepted, cast(s as bigint) as skipped, true as refused_early, true as refused_twice from r"""

QUERIES = {
    "file_text": (file_text, FILE_TEXT),
    "file_chat": (file_chat, FILE_CHAT),
    "file_pairs": (file_pairs, FILE_PAIRS),
    "file_answers": (file_answers, FILE_ANSWERS),
    "file_corpus": (file_corpus, FILE_CORPUS),
    "file_lines": (file_lines, FILE_LINES),
    "file_snapshot": (file_snapshot, FILE_SNAPSHOT),
    "stage_outputs": (stage_outputs, STAGE_OUTPUTS),
}
