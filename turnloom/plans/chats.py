"""Rendering, parsing back, and decisions on whole conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom import constants as K
from turnloom.functions.draws import uniform
from turnloom.functions.joins import with_key_stats
from turnloom.functions.jsontext import call_items, json_items, read_calls
from turnloom.functions.text import count_of, truthy
from turnloom.operators import chat, normalize, toolcalls
from turnloom.plans import tables as t
from turnloom.plans.sqltext import WS, draw, pick, quoted, strip

TURN_SQL = """case when role = 'system' and turn = 0 then '<|im_start|>system' || chr(10) || text || '<|im_end|>' || chr(10)
  when role in ('user', 'system') then '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)
  else '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || ltrim(text, chr(10)) || '<|im_end|>' || chr(10) end"""


def _parts(spark, sf_dir):
    return chat.assemble_parts(t.conversations(spark, sf_dir))


def sft_render(spark, sf_dir):
    """Every conversation as prompt text (one row per part of 1024 turns)."""
    return chat.render_parts(_parts(spark, sf_dir)).select("conv_id", "part", F.size("messages").cast("bigint").alias("n_turns"), "prompt")


SFT_RENDER = f"""select conv_id, turn // 1024 as part, count(*) as n_turns, string_agg({TURN_SQL}, '' order by turn) as prompt
from conversations group by conv_id, turn // 1024"""


def chat_stats(spark, sf_dir):
    return chat.prompt_stats(t.conversations(spark, sf_dir)).select("conv_id", "n_turns", "n_chars", "assistant_chars", "assistant_share")


CHAT_STATS = f"""with p as (select conv_id, role, length({TURN_SQL}) as n from conversations)
select conv_id, count(*) as n_turns, cast(sum(n) as bigint) as n_chars, cast(sum(case when role = 'assistant' then n else 0 end) as bigint) as assistant_chars,
  round(sum(case when role = 'assistant' then n else 0 end)::double / sum(n)::double, 6) as assistant_share from p group by conv_id"""

# Tool turns: all turns from the third on in some conversations, user turns in others.
RETOLD_SQL = """retold as (select conv_id, turn, text, case when conv_id % 4 = 0 and turn >= 2 then 'tool'
  when conv_id % 4 = 1 and role = 'user' and turn > 0 then 'tool' else role end as role from conversations),
pieces as (select conv_id, turn, case when role = 'tool' then
    case when coalesce(lag(role) over w, '') <> 'tool' then '<|im_start|>user' else '' end || chr(10) || '<tool_response>' || chr(10) || text || chr(10) || '</tool_response>' ||
    case when coalesce(lead(role) over w, '') <> 'tool' then '<|im_end|>' || chr(10) else '' end
  else """ + TURN_SQL + """ end as piece from retold window w as (partition by conv_id order by turn))"""


def _retold(spark, sf_dir):
    role = (
        F.when((F.col("conv_id") % 4 == 0) & (F.col("turn") >= 2), "tool")
        .when((F.col("conv_id") % 4 == 1) & (F.col("role") == "user") & (F.col("turn") > 0), "tool").otherwise(F.col("role"))
    )
    return t.conversations(spark, sf_dir).withColumn("role", role)


def tool_turns(spark, sf_dir):
    """Rendered turn by turn, tool turns grouped into one user block."""
    return chat.render_turns(_retold(spark, sf_dir)).select("conv_id", "turn", "piece")


TOOL_TURNS = f"with {RETOLD_SQL} select conv_id, turn, piece from pieces"


def tool_turn_parts(spark, sf_dir):
    """The same in parts of 3 turns: borders must not change the text."""
    return chat.render_parts(chat.assemble_parts(_retold(spark, sf_dir), 3)).select("conv_id", "part", "prompt")


TOOL_TURN_PARTS = f"with {RETOLD_SQL} select conv_id, turn // 3 as part, string_agg(piece, '' order by turn) as prompt from pieces group by 1, 2"


def think_render(spark, sf_dir):
    """Assistant turns whose reasoning stands in the text or in its own field."""
    own = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("\n"), F.col("text"), F.lit("\n")))
    msg = normalize.message(F.lit("assistant"), F.concat(F.lit("\n"), F.col("response")), reasoning_content=own)
    none = F.lit(None).cast("string")
    return t.responses(spark, sf_dir).select("conv_id", "turn", chat.turn_piece(msg, F.lit(False), none, none).alias("piece"))


THINK_RENDER = f"""with {t.RESPONSES_SQL}, x as (select conv_id, turn, chr(10) || response as c, case when turn % 3 = 0 then chr(10) || text || chr(10) end as own from responses),
y as (select *, own is null and contains(c, '</think>') as split from x)
select conv_id, turn, '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) ||
  trim(case when split then ltrim(split_part(rtrim(split_part(c, '</think>', 1), chr(10)), '<think>', -1), chr(10)) else coalesce(own, '') end, chr(10)) ||
  chr(10) || '</think>' || chr(10) || chr(10) || ltrim(case when split then ltrim(split_part(c, '</think>', -1), chr(10)) else c end, chr(10)) || '<|im_end|>' || chr(10) as piece from y"""


def tools_render(spark, sf_dir):
    """A question and a tool call per assistant turn, with tools in the header and a generation prompt."""
    call = F.concat(F.lit('{"name": "unit_converter", "arguments": {"value": '), F.col("turn").cast("string"), F.lit("}}"))
    wrapped = F.concat(F.lit('{"type": "function", "function": {"name": "get_current_time", "arguments": "{\\"timezone\\":\\"'), F.col("conv_id").cast("string"), F.lit('\\"}"}}'))
    listed = F.concat(F.lit("["), call, F.lit(", "), wrapped, F.lit("]"))
    rows = t.responses(spark, sf_dir).select(
        "conv_id", "turn",
        F.when(F.col("conv_id") % 2 == 0, F.array(normalize.message(F.lit("system"), F.lit("S")))).otherwise(normalize.empty_messages()).alias("lead"),
        F.array(
            normalize.message(F.lit("user"), F.col("text")),
            normalize.message(F.lit("assistant"), F.when(F.col("turn") % 2 == 0, F.lit("")).otherwise(F.col("text")), tool_calls=listed),
        ).alias("rest"),
        F.lit('[{"name":"unit_converter"},{"name":"get_current_time"}]').alias("tools"), listed.alias("listed"),
    )
    # The calls sit on the last message; the earlier ones have none.
    none = F.lit(None).cast(chat.CALLS_DDL)
    rows = rows.withColumns({"messages": F.concat("lead", "rest"), "lines": json_items("tools"), "calls": call_items("listed")})
    per_message = F.concat(F.array_repeat(none, F.size("messages") - 1), F.array("calls"))
    open_flag = F.col("turn") % 3 == 0
    return rows.select(
        "conv_id", "turn", chat.render(F.col("messages"), F.col("lines"), per_message, add_generation_prompt=True, open_thinking=open_flag).alias("prompt")
    )


TOOLS_RENDER = f"""with {t.RESPONSES_SQL} select conv_id, turn, '<|im_start|>system' || chr(10) || case when conv_id % 2 = 0 then 'S' || chr(10) || chr(10) else '' end ||
  {quoted(K.TOOLS_HEAD)} || chr(10) || '{{"name": "unit_converter"}}' || chr(10) || '{{"name": "get_current_time"}}' || {quoted(K.TOOLS_TAIL)} ||
  '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) ||
  case when turn % 2 = 0 then '' else ltrim(text, chr(10)) || chr(10) end || '<tool_call>' || chr(10) || '{{"name": "unit_converter", "arguments": {{"value": ' || turn || '}}}}' || chr(10) || '</tool_call>' || chr(10) ||
  '<tool_call>' || chr(10) || '{{"name": "get_current_time", "arguments": {{"timezone":"' || conv_id || '"}}}}' || chr(10) || '</tool_call>' || '<|im_end|>' || chr(10) ||
  '<|im_start|>assistant' || chr(10) || case when turn % 3 = 0 then '<think>' || chr(10) else '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) end as prompt from responses"""


def _heads(spark, sf_dir):
    """Per conversation: turns, and its first message, marked when any message has tools.

    That is all that decides about a system prompt; the sums are combined before the shuffle.
    """
    turns = t.conversations(spark, sf_dir)
    tools = F.col("tools") if "tools" in turns.columns else F.lit(None).cast("string")
    first = F.min_by(F.struct("role", "text"), "turn")
    heads = turns.groupBy("conv_id").agg(F.count("*").alias("n"), first.alias("f"), F.max(truthy(tools)).alias("tools"))
    return heads.select("conv_id", "n", F.array(normalize.message(F.col("f.role"), F.col("f.text"), tools=F.col("tools"))).alias("first"))


def system_inject(spark, sf_dir):
    placed = _heads(spark, sf_dir).withColumn("m", chat.inject_system(F.col("first"), F.col("conv_id")))
    first = F.get("m", F.lit(0))
    return placed.select(
        "conv_id", (F.col("n") - 1 + F.size("m")).alias("n_messages"), first["role"].alias("first_role"), first["content"].alias("first_content")
    )


_PROMPTS_SQL = "[" + ", ".join(quoted(p.format(name="turnloom")) for p in K.SYSTEM_PROMPTS) + "]"
INJECT_SQL = f"""heads as (select conv_id, count(*) as n, max(case when turn = 0 then role end) as role0, max(case when turn = 0 then text end) as text0 from conversations group by conv_id),
inj as (select *, role0 <> 'system' and {draw('42sys', 'conv_id')} < 0.2 as hit, {_PROMPTS_SQL}[{pick('42prompt', 'conv_id', 10)} + 1] as sys from heads)"""
SYSTEM_INJECT = f"""with {INJECT_SQL} select conv_id, n + case when hit then 1 else 0 end as n_messages, case when hit then 'system' else role0 end as first_role,
  case when hit then sys else text0 end as first_content from inj"""


def rl_prompts(spark, sf_dir):
    """Prompts of a rollout pool, in pieces: system prompt drawn (turn -1), answer dropped,
    thinking drawn (the generation prompt stands in the answer's place)."""
    heads = _heads(spark, sf_dir).withColumn("m", chat.inject_system(F.col("first"), F.col("conv_id")))
    lead = heads.where(F.size("m") > 1).select("conv_id", F.lit(-1).cast("bigint").alias("turn"), chat.prompt_header(F.get("m", F.lit(0))).alias("piece"))
    tail = heads.select("conv_id", (F.col("n") - 1).alias("turn"), chat.generation_prompt(chat.thinking_flag(F.col("conv_id"))).alias("piece"))
    turns = with_key_stats(t.conversations(spark, sf_dir), heads.select("conv_id", "n"), "conv_id", "n")
    body = chat.render_turns(turns).where(F.col("turn") < F.col("n") - 1).select("conv_id", F.col("turn").cast("bigint").alias("turn"), "piece")
    return lead.unionByName(body).unionByName(tail)


RL_PROMPTS = f"""with {INJECT_SQL}
select conv_id, cast(-1 as bigint) as turn, '<|im_start|>system' || chr(10) || sys || '<|im_end|>' || chr(10) as piece from inj where hit
union all select conv_id, cast(turn as bigint), {TURN_SQL} from conversations join (select conv_id, n from heads) using (conv_id) where turn < n - 1
union all select conv_id, n - 1, '<|im_start|>assistant' || chr(10) ||
  case when {draw('42open', 'conv_id')} < 0.5 then '<think>' || chr(10) else '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) end from heads"""


def think_drop(spark, sf_dir):
    rows = chat.render_parts(_parts(spark, sf_dir))
    out = rows.withColumn("prompt", chat.drop_empty_think(F.col("prompt"), F.col("conv_id")))
    return out.select("conv_id", "part", count_of(F.col("prompt"), K.EMPTY_THINK).cast("bigint").alias("blocks"), "prompt")


THINK_DROP = f"""with p as ({SFT_RENDER}), e as (select '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) as block),
d as (select conv_id, part, case when contains(prompt, block) and {draw('42think', 'conv_id')} > 0.2 then replace(prompt, block, '') else prompt end as prompt, block from p, e)
select conv_id, part, cast((length(prompt) - length(replace(prompt, block, ''))) / length(block) as bigint) as blocks, prompt from d"""


def parse_back(spark, sf_dir):
    rows = chat.render_parts(_parts(spark, sf_dir))
    found = rows.select("conv_id", "part", F.posexplode(chat.parse_prompt(F.col("prompt"))).alias("pos", "m"))
    return found.select("conv_id", (F.col("part") * 1024 + F.col("pos")).alias("turn"), F.col("m.role").alias("role"), F.col("m.content").alias("content"))


PARSE_BACK = f"""select conv_id, turn, role, {strip("case when role = 'assistant' then '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || ltrim(text, chr(10)) else text end")} as content
from conversations"""


def parse_response(spark, sf_dir):
    rows = t.responses(spark, sf_dir).withColumn("s", chat.split_reasoning(F.col("response")))
    rows = rows.withColumn("calls", toolcalls.named_calls(read_calls(chat.call_bodies(F.col("s.rest")))))
    some = F.size("calls") > 0
    listed = F.transform("calls", lambda c: F.concat_ws(" ", c["id"], c["name"], c["arguments"]))
    return rows.select(
        "conv_id", "turn", chat.strip_calls(F.col("s.rest"), some).alias("content"), F.col("s.reasoning").alias("reasoning"),
        F.array_join(listed, "\n").alias("calls"), chat.finish_reason(some).alias("finish_reason"),
    )


PARSE_RESPONSE = f"""with {t.RESPONSES_SQL} select conv_id, turn, {strip("case conv_id % 4 when 1 then " + f"regexp_replace(substr(text,81), '^[{WS}]+', '')" + " when 2 then text else response end")} as content,
  case when conv_id % 4 = 1 then {strip('substr(text,1,80)')} end as reasoning, 
  case when conv_id % 4 = 2 then 'call_0 get_exchange_rate ' || replace(json_extract(regexp_extract(response, '<tool_call>(.*?)</tool_call>', 1), '$.arguments')::varchar, '":"', '": "').replace('","', '", "') else '' end as calls,
  case when conv_id % 4 = 2 then 'tool_calls' else 'stop' end as finish_reason from responses"""


def last_turns(spark, sf_dir):
    return chat.last_turns(t.conversations(spark, sf_dir), 3).select("conv_id", "turn", "role", "text")


LAST_TURNS = "select conv_id, turn, role, text from conversations qualify row_number() over (partition by conv_id order by turn desc) <= 3"


def history_windows(spark, sf_dir):
    """The three history rules: sizes kept and what comes first."""
    # No rule looks back further than 4 turns, so no more than these are put together.
    rows = chat.recent_messages(t.conversations(spark, sf_dir), 4)
    has_tools = F.col("conv_id") % 3 == 0
    out = rows.select(
        "conv_id", chat.history_for_prompt(F.col("messages"), 4).alias("p"), chat.history_for_client(F.col("messages"), 0).alias("c"),
        chat.history_for_page(F.col("messages"), 2, has_tools).alias("w"),
    )
    first = lambda c: F.get(c, F.lit(0))["content"]
    return out.select(
        "conv_id", F.size("p").cast("bigint").alias("n_prompt"), F.size("c").cast("bigint").alias("n_client"), F.size("w").cast("bigint").alias("n_page"),
        first("p").alias("first_prompt"), first("c").alias("first_client"), first("w").alias("first_page"),
    )


HISTORY_WINDOWS = f"""with n as (select conv_id, count(*) as n, list(text order by turn) as l from conversations group by conv_id)
select conv_id, least(n, 4) as n_prompt, cast(1 as bigint) as n_client, least(n, 3) + case when conv_id % 3 = 0 then 0 else 1 end as n_page,
  l[greatest(n - 4, 0) + 1] as first_prompt, l[n] as first_client,
  case when conv_id % 3 = 0 then l[greatest(n - 3, 0) + 1] else {quoted(K.HISTORY_SYSTEM_PROMPT.format(name='turnloom'))} end as first_page from n"""


def chosen_text(spark, sf_dir):
    """Last assistant text per conversation: one maximum per key, combined before the shuffle."""
    said = t.conversations(spark, sf_dir).where(F.col("role") == "assistant")
    return said.groupBy("conv_id").agg(F.max_by("text", "turn").alias("chosen"))


CHOSEN_TEXT = "select conv_id, arg_max(text, turn) as chosen from conversations where role = 'assistant' group by conv_id"


def prompt_split(spark, sf_dir):
    """Prompt without the answer, and the tools of the last system message with any."""
    listed = F.when((F.col("role") == "system") | ((F.col("conv_id") % 5 == 0) & (F.col("turn") == 2)), F.concat(F.lit('[{"name": "t'), F.col("turn").cast("string"), F.lit('"}]')))
    role = F.when((F.col("conv_id") % 5 == 0) & (F.col("turn") == 2), "system").otherwise(F.col("role"))
    turns = t.conversations(spark, sf_dir).withColumn("tools", listed).withColumn("role", role)
    return chat.prompt_summary(turns)


PROMPT_SPLIT = """with x as (select *, case when role = 'system' or (conv_id % 5 = 0 and turn = 2) then '[{"name": "t' || turn || '"}]' end as tools from conversations)
select conv_id, count(*) - 1 as n_prompt, arg_max(tools, turn) filter (where tools is not null) as tools from x group by conv_id"""


def context_text(spark, sf_dir):
    """Context of a score: earlier turns as lines, then the last question, one piece per turn."""
    return chat.context_pieces(t.conversations(spark, sf_dir)).select("conv_id", "turn", "piece")


CONTEXT_TEXT = f"""with n as (select *, count(*) over (partition by conv_id) as n from conversations)
select conv_id, turn, case when turn < n - 1 then case when turn > 0 then chr(10) else '' end || role || ': ' || text
  when n > 1 then {quoted(K.HISTORY_CONNECTOR)} || text else text end as piece from n"""


def thinking_requests(spark, sf_dir):
    """Requests switch thinking on in any of three fields."""
    rows = t.events(spark, sf_dir)
    a = F.col("event_type") == "click"
    b = F.get_json_object("props", "$.k").cast("int") % 10 == 0
    c = F.when(F.col("value") > 20, F.col("event_type") == "view")
    flag = chat.wants_thinking(a, b, c)
    return rows.select("event_id", flag.alias("open_thinking"), chat.generation_prompt(flag).alias("suffix"),
                       (uniform("42open", 0, F.col("event_id")) < 0.9).alias("drawn"))


THINKING_REQUESTS = f"""with x as (select event_id, event_type = 'click' or cast(json_extract_string(props, '$.k') as integer) % 10 = 0 or (value > 20 and event_type = 'view') as open_thinking from events)
select event_id, open_thinking, '<|im_start|>assistant' || chr(10) || case when open_thinking then '<think>' || chr(10) else '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) end as suffix,
  {draw('42open', 'event_id')} < 0.9 as drawn from x"""

QUERIES = {
    "sft_render": (sft_render, SFT_RENDER),
    "chat_stats": (chat_stats, CHAT_STATS),
    "tool_turns": (tool_turns, TOOL_TURNS),
    "tool_turn_parts": (tool_turn_parts, TOOL_TURN_PARTS),
    "think_render": (think_render, THINK_RENDER),
    "tools_render": (tools_render, TOOLS_RENDER),
    "system_inject": (system_inject, SYSTEM_INJECT),
    "rl_prompts": (rl_prompts, RL_PROMPTS),
    "think_drop": (think_drop, THINK_DROP),
    "parse_back": (parse_back, PARSE_BACK),
    "parse_response": (parse_response, PARSE_RESPONSE),
    "last_turns": (last_turns, LAST_TURNS),
    "history_windows": (history_windows, HISTORY_WINDOWS),
    "chosen_text": (chosen_text, CHOSEN_TEXT),
    "prompt_split": (prompt_split, PROMPT_SPLIT),
    "context_text": (context_text, CONTEXT_TEXT),
    "thinking_requests": (thinking_requests, THINKING_REQUESTS),
}
