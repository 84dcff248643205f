"""Corpus assembly: clean-up, schema unification, counters, limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.constants import CHAT_ROLES, TOOL_DIALOG_ROLES
from turnloom.operators import manifest, normalize
from turnloom.plans import tables as t
from turnloom.session import spread
from turnloom.plans.sqltext import strip
from turnloom.sources import jsonl


def corpus_clean(spark, sf_dir):
    return normalize.clean_text(t.documents(spark, sf_dir)).select("doc_id", "source", "text")


CORPUS_CLEAN = f"select doc_id, source, {strip('text')} as text from documents where {strip("coalesce(text, '')")} <> ''"


def source_counts(spark, sf_dir):
    docs = normalize.clean_text(t.documents(spark, sf_dir).select("text"))
    pages = normalize.clean_text(t.table(spark, sf_dir, "pages").select(F.col("html").alias("text")))
    both = normalize.concat_sources(("documents", docs), ("pages", pages))
    counts = both.groupBy("source").agg(F.count("*").alias("n"))  # the rollup then expands one row per source
    return counts.rollup("source").agg(F.sum("n").alias("n_rows")).select(F.coalesce("source", F.lit("total")).alias("source"), "n_rows")


SOURCE_COUNTS = f"""with u as (select 'documents' as source from documents where {strip('text')} <> ''
  union all select 'pages' from pages where {strip('html')} <> '')
select source, count(*) as n_rows from u group by source union all select 'total', count(*) from u"""


def _flat(df, *extra):
    return df.select("doc_id", *extra, F.posexplode("conversation").alias("pos", "m")).select(
        "doc_id", *extra, "pos", F.col("m.role").alias("role"), F.col("m.content").alias("content")
    )


def normalize_mixed(spark, sf_dir):
    kept, _ = normalize.split_rejects(t.mixed_rows(spark, sf_dir), normalize.no_shape())
    return _flat(normalize.unify_chat(kept))


NORMALIZE_MIXED = f"with {t.MIXED_SQL} select doc_id, pos, role, content from mixed"


def accept_report(spark, sf_dir):
    return normalize.accept_report(t.mixed_rows(spark, sf_dir), normalize.no_shape())


ACCEPT_REPORT = f"""with {t.MIXED_SQL}, ok as (select distinct doc_id from mixed)
select source, count(ok.doc_id) as accepted, count(*) - count(ok.doc_id) as skipped, count(ok.doc_id) = 0 as all_skipped
from documents left join ok on ok.doc_id = documents.doc_id group by source"""


def role_map(spark, sf_dir):
    tag = (
        F.when((F.col("role") == "user") & (F.col("turn") % 3 == 0), "human").when(F.col("role") == "user", "observation")
        .when((F.col("role") == "assistant") & (F.col("turn") % 4 == 1), "gpt").when(F.col("role") == "assistant", "function_call")
        .when(F.col("conv_id") % 2 == 0, "narrator").otherwise("system")
    )
    tagged = t.conversations(spark, sf_dir).select(tag.alias("tag"))
    return (
        tagged.groupBy("tag").agg(F.count("*").alias("n_rows"))
        .select("tag", normalize.map_role(F.col("tag"), CHAT_ROLES).alias("chat_role"),
                normalize.map_role(F.col("tag"), TOOL_DIALOG_ROLES).alias("dialog_role"), "n_rows")
    )


ROLE_MAP = """with x as (select case when role = 'user' and turn % 3 = 0 then 'human' when role = 'user' then 'observation'
  when role = 'assistant' and turn % 4 = 1 then 'gpt' when role = 'assistant' then 'function_call'
  when conv_id % 2 = 0 then 'narrator' else 'system' end as tag from conversations)
select tag, case tag when 'gpt' then 'assistant' when 'system' then 'system' else 'user' end as chat_role,
  case tag when 'gpt' then 'assistant' when 'function_call' then 'assistant' when 'observation' then 'tool' when 'system' then 'system' else 'user' end as dialog_role,
  count(*) as n_rows from x group by tag"""


def pref_filter(spark, sf_dir):
    rows = t.preference_rows(spark, sf_dir)
    kept, _ = normalize.split_rejects(rows, normalize.pair_reason(F.col("chosen"), F.col("rejected")))
    side = lambda c: normalize.last_assistant(F.col(c))
    return kept.select("pair_id", side("chosen").alias("chosen_text"), side("rejected").alias("rejected_text"))


PREF_FILTER = f"with {t.PAIRS_SQL} select pair_id, good as chosen_text, bad as rejected_text from pairs where bad is not null"


def attach_tools(spark, sf_dir):
    rows = normalize.unify_tool_dialog(t.dialog_rows(spark, sf_dir)).where(F.col("conversation").isNotNull())
    placed = rows.withColumn("conversation", normalize.attach_tools(F.col("conversation"), F.col("dialog_tools")))
    return placed.select("doc_id", F.posexplode("conversation").alias("pos", "m")).select(
        "doc_id", "pos", F.col("m.role").alias("role"), F.col("m.content").alias("content"), F.col("m.tools").alias("tools")
    )


ATTACH_TOOLS = f"with {t.DIALOG_SQL} select doc_id, pos, role, content, tools from dialogs"


def _math(spark, sf_dir):
    solution = F.when(F.col("chosen_list").isNotNull(), normalize.last_assistant(F.col("chosen_list"))).otherwise(F.coalesce("chosen_text", F.lit("")))
    rows = normalize.math_rows(
        spread(t.math_source(spark, sf_dir)), normalize.first_filled(F.col("question"), F.col("prompt"), F.col("instruction")), solution
    )
    return rows, normalize.math_reason(F.col("question"), F.col("solution"), F.col("gt"))


def math_answers(spark, sf_dir):
    rows, reason = _math(spark, sf_dir)
    kept, _ = normalize.split_rejects(rows, reason)
    return kept.select("doc_id", "question", F.array_join(normalize.listed_gt(F.col("gt")), "|").alias("gt"))


MATH_ANSWERS = f"with {t.MATH_SQL} select doc_id, question, gt from math where question <> '' and gt <> ''"


def reject_report(spark, sf_dir):
    rows, reason = _math(spark, sf_dir)
    return rows.groupBy("source", F.coalesce(reason, F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n_rows"))


REJECT_REPORT = f"""with {t.MATH_SQL} select source, case when question = '' then 'no_question' when gt = '' then 'no_number' else 'accepted' end as outcome,
  count(*) as n_rows from math group by all"""


def limit_accepted(spark, sf_dir):
    """The first 100 rows that unify, in id order."""
    rows = manifest.first_accepted(t.mixed_rows(spark, sf_dir), normalize.no_shape().isNull(), F.col("doc_id"), 100)
    return _flat(normalize.unify_chat(rows))


LIMIT_ACCEPTED = f"""with {t.MIXED_SQL}, ids as (select distinct doc_id from mixed order by doc_id limit 100)
select doc_id, pos, role, content from mixed where doc_id in (select doc_id from ids)"""


def limit_read(spark, sf_dir):
    """What unifies among the first 100 rows, in id order."""
    rows = manifest.first_read(t.mixed_rows(spark, sf_dir), normalize.no_shape().isNull(), F.col("doc_id"), 100)
    return _flat(normalize.unify_chat(rows))


LIMIT_READ = f"""with {t.MIXED_SQL}, ids as (select doc_id from documents order by doc_id limit 100)
select doc_id, pos, role, content from mixed where doc_id in (select doc_id from ids)"""


def column_report(spark, sf_dir):
    return jsonl.column_report(t.documents(spark, sf_dir))


COLUMN_REPORT = " union all ".join(
    f"select '{c}' as column_name, '{ty}' as type, count({c}) as filled, max(length(cast({c} as varchar))) as longest from documents"
    for c, ty in (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"))
)

QUERIES = {
    "corpus_clean": (corpus_clean, CORPUS_CLEAN),
    "source_counts": (source_counts, SOURCE_COUNTS),
    "normalize_mixed": (normalize_mixed, NORMALIZE_MIXED),
    "accept_report": (accept_report, ACCEPT_REPORT),
    "role_map": (role_map, ROLE_MAP),
    "pref_filter": (pref_filter, PREF_FILTER),
    "attach_tools": (attach_tools, ATTACH_TOOLS),
    "math_answers": (math_answers, MATH_ANSWERS),
    "reject_report": (reject_report, REJECT_REPORT),
    "limit_accepted": (limit_accepted, LIMIT_ACCEPTED),
    "limit_read": (limit_read, LIMIT_READ),
    "column_report": (column_report, COLUMN_REPORT),
}
