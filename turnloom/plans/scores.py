"""Rule-based scores of logged responses."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import functions as F

from turnloom.functions import text
from turnloom.functions.arrays import repeat_penalty
from turnloom.functions.jsontext import read_calls
from turnloom.operators import chat, diagnostics, rewards, toolcalls, trajectories
from turnloom.plans import tables as t
from turnloom.session import spread
from turnloom.plans.sqltext import penalty, strip


def rep_penalty(spark, sf_dir):
    """Repeated word 3-grams over whole documents, counted inside the row."""
    return spread(t.documents(spark, sf_dir)).select("doc_id", F.round(repeat_penalty(F.col("text")), 6).alias("penalty"))


REP_PENALTY = f"select doc_id, round({penalty('text')}, 6) as penalty from documents"


def _scored(spark, sf_dir):
    return spread(t.responses(spark, sf_dir)).withColumn("rm_score", (F.col("turn") - 3) * F.lit(1.5))


def reward_basic(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    return rows.select("conv_id", "turn", F.round(rewards.basic_reward(F.col("response"), F.col("rm_score")), 6).alias("reward"))


def _format_sql(r: str, low: int) -> str:
    think = strip(f"split_part({r}, '</think>', 1)")
    return f"""(case when length({strip(r)}) between {low} and 800 then 0.5::double else -0.5::double end + case when contains({r}, '</think>') then
    case when length({think}) between 20 and 300 then 1.0::double else -0.5::double end +
    case when (length({r}) - length(replace({r}, '</think>', ''))) / 8 = 1 then 0.25::double else -0.25::double end else 0.0::double end)"""


def _after_think(r: str) -> str:
    return strip(f"substr({r}, instr({r}, '</think>') + 8)")


REWARD_BASIC = f"""with {t.RESPONSES_SQL}, x as (select *, case when contains(response, '</think>') then {_after_think('response')} else response end as answer from responses)
select conv_id, turn, round({_format_sql('response', 20)} - {penalty('answer')} + greatest(-3.0::double, least(3.0::double, (turn - 3) * 1.5::double)), 6) as reward from x"""


_GOOD = '<tool_call>{"name": "unit_converter", "arguments": {"value": 3, "from_unit": "km", "to_unit": "miles"}}</tool_call>'
_EMPTY = '<tool_call>{"name": "get_exchange_rate", "arguments": {"from_currency": "USD", "to_currency": ""}}</tool_call>'
_CITY = '<tool_call>{"name": "get_current_weather", "arguments": {"location": "Paris"}}</tool_call>'


def _trajectories(spark, sf_dir):
    """Two logged turns per response.

    The first turn makes none to three calls, some of them with an empty argument
    or of a tool that was not offered, some with a tag left open; the second is
    the response.  Expected answers, none to three and also twice the same, come
    from its text.
    """
    # Only a-z: engines differ in what they make of letters like the sharp s.
    word = F.translate(F.get(F.split("text", " "), F.lit(0)), ascii_lowercase, ascii_uppercase)
    kind, wants = (F.col("conv_id") + F.col("turn")) % 5, F.col("conv_id") % 3
    calls = (
        F.when(kind == 1, _GOOD).when(kind == 2, _GOOD + _EMPTY).when(kind == 3, f"{_GOOD} and {_CITY}{_GOOD}").when(kind == 4, "plan <tool_call>").otherwise("plan")
    )
    return _scored(spark, sf_dir).select(
        "conv_id", "turn", F.concat("response", F.lit(" 1,350.0 원")).alias("response"), "rm_score", "text",
        F.array(F.concat(F.lit("<think>a</think> "), calls), F.concat("response", F.lit(" 1,350.0 원"))).alias("turn_outputs"),
        F.when(wants == 0, F.array().cast("array<string>")).when(wants == 1, F.array(word)).otherwise(F.array(word, F.lit("1350"), word)).alias("gt"),
        (F.col("conv_id") % 5 == 0).alias("unfinished"),
        F.when(F.col("conv_id") % 2 == 0, F.array(F.lit("unit_converter"), F.lit("get_current_weather"), F.lit("get_exchange_rate")))
        .when(F.col("conv_id") % 7 != 0, F.array(F.lit("unit_converter"))).alias("offered"),
    )


def reward_agent(spark, sf_dir):
    scored = rewards.agent_rewards(_trajectories(spark, sf_dir), F.col("offered"))
    return scored.select("conv_id", "turn", F.col("n_calls").cast("bigint").alias("n_calls"), F.col("n_valid").cast("bigint").alias("n_valid"), F.round("reward", 6).alias("reward"))


def _gap_sql(x: str) -> str:
    return f"abs((length({x}) - length(replace({x}, '<tool_call>', ''))) / 11 - (length({x}) - length(replace({x}, '</tool_call>', ''))) / 12)"


# Calls are read from both turns with DuckDB's JSON functions and checked one by one.
_RUNS_SQL = f"""{t.RESPONSES_SQL}, x as (select conv_id, turn, text, response || ' 1,350.0 원' as r, conv_id % 5 = 0 as unfinished, translate(split_part(text, ' ', 1), '{ascii_lowercase}', '{ascii_uppercase}') as word,
    case (conv_id + turn) % 5 when 1 then '{_GOOD}' when 2 then '{_GOOD}{_EMPTY}' when 3 then '{_GOOD} and {_CITY}{_GOOD}' when 4 then 'plan <tool_call>' else 'plan' end as a1,
    case when conv_id % 2 = 0 then ['unit_converter', 'get_current_weather', 'get_exchange_rate'] when conv_id % 7 <> 0 then ['unit_converter'] else [] end as offered from responses),
a as (select *, case conv_id % 3 when 0 then [] when 1 then [word] else [word, '1350', word] end as gt,
  case when contains(r, '</think>') then {_after_think('r')} else {strip('r')} end as answer from x),
bodies as (select conv_id, turn, offered, unnest(list_concat(regexp_extract_all(a1, '(?s)<tool_call>(.*?)</tool_call>', 1), regexp_extract_all(answer, '(?s)<tool_call>(.*?)</tool_call>', 1))) as body from a),
k as (select conv_id, turn, count(*) as n_calls, count(*) filter (where list_contains(offered, json_extract_string(body, '$.name')) and case json_extract_string(body, '$.name')
    when 'unit_converter' then json_extract(body, '$.arguments.value') is not null and json_extract_string(body, '$.arguments.from_unit') <> '' and json_extract_string(body, '$.arguments.to_unit') <> ''
    when 'get_exchange_rate' then json_extract_string(body, '$.arguments.from_currency') <> '' and json_extract_string(body, '$.arguments.to_currency') <> ''
    when 'get_current_weather' then json_extract_string(body, '$.arguments.location') <> '' else false end) as n_valid from bodies where json_valid(body) group by conv_id, turn)"""
REWARD_AGENT = f"""with {_RUNS_SQL},
b as (select a.*, coalesce(k.n_calls, 0) as n_calls, coalesce(k.n_valid, 0) as n_valid, {_gap_sql('a1')} + {_gap_sql('answer')} as tags,
  case when unfinished then '' else split_part(answer, '</tool_call>', -1) end as tail from a left join k on a.conv_id = k.conv_id and a.turn = k.turn),
c as (select *, len(list_distinct(list_filter(gt, lambda g: (g <> '' and contains(lower(tail), lower(g))) or (g = '1350' and contains(tail, '1,350.0'))))) as hits,
  abs(n_valid - len(gt)) + n_calls - n_valid as gap from b)
select conv_id, turn, n_calls, n_valid,
  round(greatest(-3.0::double, least(3.0::double, case when n_calls > 0 then case when gap = 0 then 0.5::double else -0.5::double * gap end
      + case when len(gt) > 0 then 2.5::double * hits / len(gt) else 0.0::double end - case when unfinished then 0.5::double else 0.0::double end
      - {penalty("case when tail <> '' then tail else answer end")}
    else {_format_sql('r', 5)} + greatest(-3.0::double, least(3.0::double, (turn - 3) * 1.5::double)) - {penalty('answer')} end - 0.5::double * tags)), 6) as reward from c"""


def gt_match(spark, sf_dir):
    """Expected answers in whole documents: as text, as number, and not at all."""
    rows = spread(t.documents(spark, sf_dir)).select(
        "doc_id", F.concat("text", F.lit(" ("), F.format_number(F.col("n_chars").cast("double") + 0.5, 1), F.lit(")")).alias("text"),
        F.array(F.concat(F.lit(" "), (F.col("n_chars") + 0.5).cast("string")), F.substring("text", 1, 6), F.lit("no such words"), F.lit("  ")).alias("gt"),
    )
    found = rows.select("doc_id", rewards.matched_gt(F.col("text"), F.col("gt")).alias("found"), rewards.gt_coverage(F.col("text"), F.col("gt")).alias("coverage"))
    return found.select("doc_id", F.size("found").cast("bigint").alias("n_found"), F.round("coverage", 6).alias("coverage"))


# The number is in the text with thousands commas, so it matches as a number;
# the first characters always match; the rest never does.
GT_MATCH = f"""with x as (select doc_id, case when {strip('substr(text, 1, 6)')} = '' then 1 else 2 end as n from documents)
select doc_id, cast(n as bigint) as n_found, round(n / 4.0::double, 6) as coverage from x"""


def lone_numbers(spark, sf_dir):
    """Stand-alone numbers in whole documents: how many, the least and the greatest."""
    rows = spread(t.documents(spark, sf_dir)).select("doc_id", text.lone_numbers(F.col("text")).alias("n"))
    return rows.select("doc_id", F.size("n").cast("bigint").alias("n_numbers"), F.array_min("n").alias("least"), F.array_max("n").alias("greatest"))


_W = r"\p{L}\p{N}_."
LONE_NUMBERS = rf"""with p as (select doc_id, list_filter(string_split_regex(regexp_replace(replace(text, ',', ''), '([{_W}])[-+]', '\1 ', 'g'), '[^{_W}+-]+'), lambda x: regexp_full_match(x, '[-+]*\d+(\.\d+)?')) as l from documents),
n as (select doc_id, list_transform(l, lambda x: cast(regexp_extract(x, '[-+]?\d+(\.\d+)?$') as double)) as l from p)
select doc_id, len(l) as n_numbers, list_min(l) as least, list_max(l) as greatest from n"""


def tag_balance(spark, sf_dir):
    """|open - close| tool-call tags after the think part is cut off."""
    rows = _trajectories(spark, sf_dir)
    return rows.select("conv_id", "turn", rewards.tag_imbalance(F.col("turn_outputs")).alias("gap"))


TAG_BALANCE = f"with {_RUNS_SQL} select conv_id, turn, cast({_gap_sql('a1')} + {_gap_sql('answer')} as bigint) as gap from a"


def unfinished_flags(spark, sf_dir):
    """Runs that still called a tool on their last allowed turn (here turn 5)."""
    rows = t.responses(spark, sf_dir).select("conv_id", "turn", "response", F.array_repeat("response", F.least(F.floor(F.col("turn") / 2) + 1, F.lit(3)).cast("int")).alias("outs"))
    rows = rows.withColumn("calls", F.size(toolcalls.kept_calls(read_calls(chat.call_bodies(F.col("response"))))))
    return rows.select("conv_id", "turn", trajectories.is_unfinished(F.col("outs"), F.col("calls")).alias("unfinished"),
                       rewards.final_text(F.col("response"), trajectories.is_unfinished(F.col("outs"), F.col("calls"))).alias("final_text"))


UNFINISHED_FLAGS = f"""with {t.RESPONSES_SQL} select conv_id, turn, turn >= 4 and conv_id % 4 = 2 as unfinished,
  case when turn >= 4 and conv_id % 4 = 2 then '' when conv_id % 4 = 2 then text else response end as final_text from responses"""


def group_advantage(spark, sf_dir):
    """(reward - group mean) / (group deviation + 1e-4) per conversation."""
    rows = t.conversations(spark, sf_dir).where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("prompt_id"), F.col("turn").alias("gen"), (F.length("text") / F.lit(100.0)).alias("reward")
    )
    return diagnostics.group_advantages(rows).select("prompt_id", "gen", F.round("advantage", 6).alias("advantage"))


GROUP_ADVANTAGE = """with g as (select conv_id as prompt_id, turn as gen, cast(length(text) as double) / 100.0::double as reward from conversations where role = 'assistant')
select prompt_id, gen, round((reward - avg(reward) over w) / (stddev_pop(reward) over w + 0.0001::double), 6) as advantage from g window w as (partition by prompt_id)"""

QUERIES = {
    "rep_penalty": (rep_penalty, REP_PENALTY),
    "reward_basic": (reward_basic, REWARD_BASIC),
    "reward_agent": (reward_agent, REWARD_AGENT),
    "gt_match": (gt_match, GT_MATCH),
    "lone_numbers": (lone_numbers, LONE_NUMBERS),
    "tag_balance": (tag_balance, TAG_BALANCE),
    "unfinished_flags": (unfinished_flags, UNFINISHED_FLAGS),
    "group_advantage": (group_advantage, GROUP_ADVANTAGE),
}
