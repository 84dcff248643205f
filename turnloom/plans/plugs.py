"""What users plug in: row functions, shapes, scorers, batches; the source catalogue; reports per case."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom import constants as K
from turnloom.functions import hooks
from turnloom.operators import manifest, normalize, rewards, toolcalls
from turnloom.operators.normalize import message
from turnloom.plans import tables as t
from turnloom.plans.sqltext import order_key, quoted
from turnloom.plans.tools import ALLOWED_SQL, allowed_tools, checked_calls
from turnloom.session import spread
from turnloom.sources import jsonl

_CHAT = "array<struct<role: string, content: string>>"


def plug_rows(spark, sf_dir):
    """A user's row function: question and answer as a conversation, rows without the middle part left out."""

    def asked(row):
        if not row["extra"]:
            return None
        said = [{"role": "user", "content": row["head"] + row["extra"]}, {"role": "assistant", "content": row["tail"]}]
        return {"doc_id": row["doc_id"], "conversation": said}

    parts = spread(t.documents(spark, sf_dir)).select("doc_id", *[c.alias(n) for n, c in t.text_parts().items()])
    made = hooks.map_rows(parts, asked, f"doc_id bigint, conversation {_CHAT}")
    return made.select("doc_id", F.posexplode("conversation").alias("pos", "m")).select("doc_id", "pos", "m.role", "m.content")


PLUG_ROWS = f"""with {t.PARTS_SQL} select doc_id, 0 as pos, 'user' as role, head || extra as content from parts where extra <> ''
union all select doc_id, 1, 'assistant', tail from parts where extra <> ''"""


def plug_shapes(spark, sf_dir):
    """A shape of the user's own, tried after the built-in ones, for rows that fit none of them."""
    bare = F.coalesce("conversations", "messages").isNull() & F.col("instruction").isNull()
    shapes = [*normalize.chat_shapes(), (bare, lambda: F.array(message(F.lit("user"), F.col("source")), message(F.lit("assistant"), F.col("lang"))))]
    kept, _ = normalize.split_rejects(t.mixed_rows(spark, sf_dir), normalize.no_shape(shapes))
    rows = normalize.unify_chat(kept, shapes).select("doc_id", F.posexplode("conversation").alias("pos", "m"))
    return rows.select("doc_id", "pos", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


PLUG_SHAPES = f"""with {t.MIXED_SQL} select doc_id, pos, role, content from mixed
union all select doc_id, 0, 'user', source from documents where doc_id % 5 = 4 union all select doc_id, 1, 'assistant', lang from documents where doc_id % 5 = 4"""


def plug_scores(spark, sf_dir):
    """A user's scorer: distinct words of the response and length of the last message, held to [-3, 3]."""

    def wordy(messages, responses):
        return [(len(set(text.split(" "))) - 48) / 16 + len(said[-1]["content"]) / 64 for said, text in zip(messages, responses)]

    asked = F.array(F.struct(F.lit("user").alias("role"), F.col("source").alias("content")))
    docs = spread(t.documents(spark, sf_dir)).select("doc_id", "source", "text")
    return rewards.with_model_scores(docs, wordy, asked, F.col("text")).select("doc_id", "rm_score")


PLUG_SCORES = """select doc_id, greatest(-3.0::double, least(3.0::double, (len(list_distinct(string_split(text, ' '))) - 48) / 16.0::double + length(source) / 64.0::double)) as rm_score
from documents"""

SHARD_ROWS = 512
BATCH_ROWS = 16
BATCH_TOKENS = 4096


def token_batches(spark, sf_dir):
    """One epoch's order cut into batches of at most 16 rows and 4,096 characters, in shards of 512 places."""
    placed = manifest.shuffled_positions(t.documents(spark, sf_dir).select("doc_id", "n_chars"), "doc_id", 42, 0)
    rows = placed.select(
        F.floor(F.col("pos") / SHARD_ROWS).cast("bigint").alias("shard"), F.col("pos").alias("place"),
        F.col("doc_id").alias("row_id"), F.col("n_chars").cast("bigint").alias("n_tokens"),
    )
    cut = hooks.token_batches(rows, BATCH_ROWS, BATCH_TOKENS)
    return cut.select("shard", "batch", "n_rows", "n_tokens", F.array_join(F.col("row_ids").cast("array<string>"), ",").alias("row_ids"))


# All shards walk at once: one row per shard and step.
TOKEN_BATCHES = f"""with recursive placed as (select doc_id, cast(n_chars as bigint) as n, row_number() over (order by {order_key(42, 0, 'doc_id')}, doc_id) - 1 as pos from documents),
walk as (
  select pos // {SHARD_ROWS} as shard, pos, doc_id, n, 0 as batch, 1 as filled, n as tokens from placed where pos % {SHARD_ROWS} = 0
  union all
  select w.shard, p.pos, p.doc_id, p.n, case when full_ then w.batch + 1 else w.batch end, case when full_ then 1 else w.filled + 1 end, case when full_ then p.n else w.tokens + p.n end
  from (select w.*, p.doc_id as next_id, p.n as next_n, w.filled = {BATCH_ROWS} or w.tokens + p.n > {BATCH_TOKENS} as full_
        from walk w join placed p on p.pos = w.pos + 1 and p.pos // {SHARD_ROWS} = w.shard) w join placed p on p.doc_id = w.next_id and p.pos = w.pos + 1)
select shard, batch, count(*) as n_rows, cast(sum(n) as bigint) as n_tokens, string_agg(cast(doc_id as varchar), ',' order by pos) as row_ids from walk group by shard, batch"""


def case_report(spark, sf_dir):
    """Per case: calls, unknown, failed, executed, calls of tools it was not offered, and whether it passed."""
    return toolcalls.case_report(checked_calls(spark, sf_dir), allowed_tools(spark, sf_dir))


CASE_REPORT = f"""with {t.CALLS_SQL}, {ALLOWED_SQL}, c as (select c.*, c.is_object and known as is_known, c.is_object and known and valid as good, c.is_object and a.name is null as not_offered
  from checked c left join allowed a on a.sample_id = c.sample_id and a.name = c.name and c.is_object)
select sample_id, count(*) as calls, count(*) filter (where not is_object) as malformed, count(*) filter (where is_object and not is_known) as "unknown",
  count(*) filter (where is_known and not good) as failed, count(*) filter (where good) as executed, count(*) filter (where not_offered) as not_offered,
  count(distinct case when good then name end) as tools_used, bool_and(coalesce(good, false) and not not_offered) as passed from c group by sample_id"""


def source_catalogue(spark, sf_dir):
    """The catalogue with what each stage writes and how many of the given rows feed it."""
    fed = {"pretrain": "documents", "sft": "conversations", "agent_rl": "events", "agent_rl_math": "documents"}
    counts = None
    for stage, name in fed.items():
        one = t.table(spark, sf_dir, name).agg(F.count("*").alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return jsonl.catalogue_report(spark, counts)


def _catalogue_sql() -> str:
    sources = ", ".join("(" + ", ".join(map(quoted, row)) + ")" for row in K.SOURCES)
    outputs = ", ".join(f"({quoted(name)}, {quoted(out)})" for name, _needs, out in K.STAGES)
    return f"""with s(source, stage, licence) as (values {sources}), o(name, output) as (values {outputs}),
n as (select 'pretrain' as stage, count(*) as n_rows from documents union all select 'sft', count(*) from conversations
  union all select 'agent_rl', count(*) from events union all select 'agent_rl_math', count(*) from documents)
select s.source, s.stage, s.licence, o.output, coalesce(n.n_rows, 0) as n_rows from s
join o on o.name = s.stage or (s.stage = 'pretrain' and o.name in ('pretrain_mini', 'pretrain_full')) left join n on n.stage = s.stage"""


SOURCE_CATALOGUE = _catalogue_sql()

QUERIES = {
    "plug_rows": (plug_rows, PLUG_ROWS),
    "plug_shapes": (plug_shapes, PLUG_SHAPES),
    "plug_scores": (plug_scores, PLUG_SCORES),
    "token_batches": (token_batches, TOKEN_BATCHES),
    "case_report": (case_report, CASE_REPORT),
    "source_catalogue": (source_catalogue, SOURCE_CATALOGUE),
}
