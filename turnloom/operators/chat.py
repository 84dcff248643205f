"""Rendering conversations to prompts, and reading prompts back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom import constants as K
from turnloom.functions.arrays import drop_end, keep_last
from turnloom.functions.draws import pick, uniform
from turnloom.functions.joins import with_key_stats
from turnloom.functions.jsontext import call_item_lists, call_items, json_items
from turnloom.functions.text import WS, after_first, after_last, before_first, let, py_strip, truthy
from turnloom.operators.normalize import message

NL = "\n"
CALLS_DDL = "array<struct<name:string,arguments:string>>"


def _turn(role, body) -> Column:
    return F.concat(F.lit(K.BOS), role, F.lit(NL), body, F.lit(K.EOS + NL))


def _assistant_piece(m: Column, calls: Column | None) -> Column:
    content = F.coalesce(m["content"], F.lit(""))
    has_think = m["reasoning_content"].isNull() & F.contains(content, F.lit(K.THINK_CLOSE))
    inside = after_last(F.rtrim(before_first(content, K.THINK_CLOSE), F.lit(NL)), K.THINK_OPEN)
    reasoning = F.when(has_think, F.ltrim(inside, F.lit(NL))).otherwise(F.coalesce(m["reasoning_content"], F.lit("")))
    said = F.when(has_think, F.ltrim(after_last(content, K.THINK_CLOSE), F.lit(NL))).otherwise(content)

    body = F.concat(
        F.lit(K.THINK_OPEN + NL), F.btrim(reasoning, F.lit(NL)),
        F.lit(NL + K.THINK_CLOSE + NL + NL), F.ltrim(said, F.lit(NL)),
    )
    if calls is not None:
        lines = F.transform(
            calls,
            lambda c: F.concat(
                F.lit(K.CALL_OPEN + NL + '{"name": "'), c["name"], F.lit('", "arguments": '), c["arguments"],
                F.lit("}" + NL + K.CALL_CLOSE),
            ),
        )
        gap = F.when((said != "") & (F.size(calls) > 0), F.lit(NL)).otherwise(F.lit(""))
        body = F.concat(body, gap, F.array_join(lines, NL))
    return _turn(F.lit("assistant"), body)


def turn_piece(m: Column, is_first: Column, prev_role: Column, next_role: Column, calls: Column | None = None) -> Column:
    """The text one message adds to the prompt, given the roles next to it.

    ``calls`` is the parsed list of the message's tool calls, if it can have any.
    The first system message adds nothing here: the header holds it.
    """
    role, content = m["role"], F.coalesce(m["content"], F.lit(""))
    opens = is_first | (F.coalesce(prev_role, F.lit("")) != "tool")
    closes = F.coalesce(next_role, F.lit("")) != "tool"
    tool = F.concat(
        F.when(opens, F.lit(K.BOS + "user")).otherwise(F.lit("")),
        F.lit(NL + "<tool_response>" + NL), content, F.lit(NL + "</tool_response>"),
        F.when(closes, F.lit(K.EOS + NL)).otherwise(F.lit("")),
    )
    return (
        F.when((role == "user") | ((role == "system") & ~is_first), _turn(role, content))
        .when(role == "assistant", _assistant_piece(m, calls))
        .when(role == "tool", tool)
        .otherwise(F.lit(""))
    )


def prompt_header(first: Column, tool_lines: Column | None = None) -> Column:
    """What precedes the turns: the leading system message and the tool list."""
    lead, system = first["role"] == "system", F.coalesce(first["content"], F.lit(""))
    plain = F.when(lead, _turn(F.lit("system"), system)).otherwise(F.lit(""))
    if tool_lines is None:
        return plain
    listed = F.concat(
        F.lit(K.BOS + "system" + NL),
        F.when(lead, F.concat(system, F.lit(NL + NL))).otherwise(F.lit("")),
        F.lit(K.TOOLS_HEAD + NL), F.array_join(tool_lines, NL), F.lit(K.TOOLS_TAIL),
    )
    return F.when(F.size(tool_lines) > 0, listed).otherwise(plain)


def message_calls(messages: Column) -> Column:
    """The parsed tool calls of every message of a list."""
    return call_item_lists(F.transform(messages, lambda m: m["tool_calls"]))


def generation_prompt(open_thinking: Column | bool) -> Column:
    """The suffix that asks the model to speak."""
    flag = open_thinking if isinstance(open_thinking, Column) else F.lit(open_thinking)
    return F.concat(
        F.lit(K.BOS + "assistant" + NL),
        F.when(flag, F.lit(K.THINK_OPEN + NL)).otherwise(F.lit(K.EMPTY_THINK)),
    )


def render_body(
    messages: Column, calls: Column | None = None, at_head: Column | None = None,
    prev_role: Column | None = None, next_role: Column | None = None,
) -> Column:
    """All turns of a message list.

    For a list that is one part of a longer conversation, ``at_head`` tells
    whether it is the first part and the two roles are those beyond its borders.
    """
    at_head = F.lit(True) if at_head is None else at_head
    none = F.lit(None).cast("string")
    roles = F.transform(messages, lambda m: m["role"])
    before = F.concat(F.array(none if prev_role is None else prev_role), drop_end(roles))
    after = F.concat(F.slice(roles, F.lit(2), F.greatest(F.size(roles), F.lit(1))), F.array(none if next_role is None else next_role))
    joined = F.zip_with(messages, before, lambda m, p: F.struct(m.alias("m"), p.alias("prev")))
    joined = F.zip_with(joined, after, lambda z, n: z.withField("next", n))
    if calls is not None:
        joined = F.zip_with(joined, calls, lambda z, c: z.withField("calls", F.coalesce(c, F.array().cast(CALLS_DDL))))

    def piece(z: Column, i: Column) -> Column:
        return turn_piece(z["m"], at_head & (i == 0), z["prev"], z["next"], None if calls is None else z["calls"])

    return F.array_join(F.transform(joined, piece), "")


def render_chat(messages: Column, **prompt) -> Column:
    """A whole conversation as prompt text, with the tools and calls its messages hold."""
    return render(messages, json_items(conversation_tools(messages)), message_calls(messages), **prompt)


def render(
    messages: Column, tool_lines: Column | None = None, calls: Column | None = None,
    add_generation_prompt: bool = False, open_thinking: Column | bool = False,
) -> Column:
    """A whole conversation as prompt text."""
    parts = [prompt_header(F.get(messages, F.lit(0)), tool_lines), render_body(messages, calls)]
    if add_generation_prompt:
        parts.append(generation_prompt(open_thinking))
    return F.concat(*parts)


# --- turn tables ----------------------------------------------------------------


def turn_message(turns: DataFrame) -> Column:
    """A turn row as one message; optional fields are used when the table has them."""
    extra = {f: F.col(f) for f in ("reasoning_content", "tools", "tool_calls") if f in turns.columns}
    return message(F.col("role"), F.col("text"), **extra)


def _listed_tools(turns: DataFrame) -> Column:
    """Tools that a turn row lists, null for most."""
    if "tools" not in turns.columns:
        return F.lit(None).cast("string")
    return F.when(F.col("role") == "system", truthy(F.col("tools")))


def assemble_parts(turns: DataFrame, part_turns: int = 1024) -> DataFrame:
    """Turn rows -> message lists of at most ``part_turns`` turns.

    ``turn`` is the index of the message in its conversation (0, 1, 2 ...).  A
    conversation of ordinary length gives one row, part 0.  A longer one gives
    several, so no group grows with the data even if one conversation holds a
    third of all rows; each part knows the roles just beyond its borders, which
    is all that rendering needs from its neighbours.  Where turns have tools, part
    0 knows those of the conversation's last system message that has any.  One shuffle.
    """
    part = F.floor(F.col("turn") / F.lit(part_turns)).cast("bigint")
    within = F.col("turn") % F.lit(part_turns)
    spots = F.array_compact(
        F.array(
            F.struct(part.alias("part"), F.lit("own").alias("kind")),
            F.when((within == 0) & (F.col("turn") > 0), F.struct((part - 1).alias("part"), F.lit("after").alias("kind"))),
            F.when(within == part_turns - 1, F.struct((part + 1).alias("part"), F.lit("before").alias("kind"))),
            F.when(_listed_tools(turns).isNotNull(), F.struct(F.lit(0).cast("bigint").alias("part"), F.lit("tools").alias("kind"))),
        )
    )
    msg = turn_message(turns)
    spread = turns.select("conv_id", "turn", "role", msg.alias("msg"), F.explode(spots).alias("s")).select(
        "conv_id", F.col("s.part").alias("part"), "turn", F.col("s.kind").alias("kind"), "role", "msg"
    )
    own = F.col("kind") == "own"
    grouped = spread.groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list(F.when(own, F.struct("turn", F.col("msg").alias("m"))))).alias("ordered"),
        F.max(F.when(F.col("kind") == "before", F.col("role"))).alias("prev_role"),
        F.max(F.when(F.col("kind") == "after", F.col("role"))).alias("next_role"),
        F.max_by(F.col("msg.tools"), F.when(F.col("kind") == "tools", F.col("turn"))).alias("tools"),
    )
    return grouped.where(F.size("ordered") > 0).select(
        "conv_id", "part", F.transform("ordered", lambda s: s["m"]).alias("messages"), "prev_role", "next_role", "tools"
    )


def render_parts(parts: DataFrame, with_tools: bool = False) -> DataFrame:
    """Prompt text per part; the parts of a conversation in order are its prompt.

    ``with_tools`` renders tools and calls, which takes a pass through Python.
    """
    head = F.col("part") == 0
    lines, calls = (json_items("tools"), message_calls(F.col("messages"))) if with_tools else (None, None)
    header = F.when(head, prompt_header(F.get("messages", F.lit(0)), lines)).otherwise(F.lit(""))
    body = render_body(F.col("messages"), calls, at_head=head, prev_role=F.col("prev_role"), next_role=F.col("next_role"))
    return parts.withColumn("prompt", F.concat(header, body))


def render_turns(turns: DataFrame) -> DataFrame:
    """Prompt text per turn row, without assembling anything.

    Only tool turns look at their neighbours, so only they are joined, on the
    unique key (conversation, turn).  The tools of a conversation are joined to
    its first turn; a table without tools or calls skips that work.
    """
    key = ["conv_id", "turn"]
    tool = F.col("role") == "tool"
    prev_tool = turns.where(tool).select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit("tool").alias("prev_role"))
    next_tool = turns.where(tool).select("conv_id", (F.col("turn") - 1).alias("turn"), F.lit("tool").alias("next_role"))
    placed = turns.where(tool).join(prev_tool, key, "left").join(next_tool, key, "left")
    none = F.lit(None).cast("string")
    rows = turns.where(~tool).withColumns({"prev_role": none, "next_role": none}).unionByName(placed)
    msg = turn_message(turns)
    first = F.col("turn") == 0
    lines, calls = None, None
    if "tools" in turns.columns:
        listed = turns.where(_listed_tools(turns).isNotNull()).groupBy("conv_id").agg(F.max_by("tools", "turn").alias("listed"))
        listed = listed.withColumn("turn", F.lit(0).cast(turns.schema["turn"].dataType))
        rows = rows.join(listed, key, "left").withColumn("lines", json_items("listed")).drop("listed")
        lines = F.col("lines")
    if "tool_calls" in turns.columns:
        rows = rows.withColumn("calls", F.coalesce(call_items("tool_calls"), F.array().cast(CALLS_DDL)))
        calls = F.col("calls")
    header = F.when(first, prompt_header(msg, lines)).otherwise(F.lit(""))
    piece = F.concat(header, turn_piece(msg, first, F.col("prev_role"), F.col("next_role"), calls))
    return rows.withColumn("piece", piece).drop("lines", "calls")


def prompt_stats(turns: DataFrame) -> DataFrame:
    """Per conversation: turns, prompt characters and the assistant's share.

    Sums of per-turn numbers, so a long conversation is pre-aggregated before
    the shuffle and never held as one row.
    """
    chars, said = F.length("piece"), F.col("role") == "assistant"
    return (
        render_turns(turns)
        .groupBy("conv_id")
        .agg(
            F.count("*").alias("n_turns"),
            F.sum(chars).alias("n_chars"),
            F.sum(F.when(said, chars).otherwise(F.lit(0))).alias("assistant_chars"),
        )
        .withColumn("assistant_share", F.round(F.col("assistant_chars") / F.col("n_chars"), 6))
    )


# --- decisions before and after rendering ---------------------------------------


def inject_system(conversation: Column, row_id: Column, ratio: float = 0.2, seed: str = "42", epoch: int = 0,
                  name: str = "turnloom") -> Column:
    """Puts one of the stock system prompts first for a share of conversations.

    Conversations with tools, or that already start with a system message, stay.
    """
    prompts = F.array(*[F.lit(p.format(name=name)) for p in K.SYSTEM_PROMPTS])
    has_tools = F.exists(conversation, lambda m: truthy(m["tools"]).isNotNull())
    leads = F.coalesce(F.get(conversation, F.lit(0))["role"], F.lit("")) == "system"
    drawn = uniform(f"{seed}sys", epoch, row_id) < ratio
    text = F.element_at(prompts, pick(f"{seed}prompt", epoch, row_id, len(K.SYSTEM_PROMPTS)) + 1)
    fresh = F.array(message(F.lit("system"), text))
    return F.when(~has_tools & ~leads & drawn, F.concat(fresh, conversation)).otherwise(conversation)


def drop_empty_think(prompt: Column, row_id: Column, keep_ratio: float = 0.2, seed: str = "42", epoch: int = 0) -> Column:
    """Deletes every empty think block, except for a share of rows that keep them."""
    drop = F.contains(prompt, F.lit(K.EMPTY_THINK)) & (uniform(f"{seed}think", epoch, row_id) > keep_ratio)
    return F.when(drop, F.replace(prompt, F.lit(K.EMPTY_THINK), F.lit(""))).otherwise(prompt)


def thinking_flag(row_id: Column, ratio: float = 0.5, seed: str = "42", epoch: int = 0) -> Column:
    return uniform(f"{seed}open", epoch, row_id) < ratio


def wants_thinking(*fields: Column) -> Column:
    """True when any of the request fields says so; null counts as no."""
    out = F.lit(False)
    for f in fields:
        out = out | F.coalesce(f, F.lit(False))
    return out


def prompt_messages(conversation: Column) -> Column:
    """Everything but the last message, which is the answer."""
    return drop_end(conversation)


def conversation_tools(conversation: Column) -> Column:
    """Tools of the last system message that has any."""
    listed = F.filter(conversation, lambda m: (m["role"] == "system") & truthy(m["tools"]).isNotNull())
    return F.try_element_at(listed, F.lit(-1))["tools"]


# --- reading text back ----------------------------------------------------------


def parse_prompt(prompt: Column) -> Column:
    """Prompt text -> array of (role, content)."""
    pattern = F.lit(K.TURN_PATTERN.replace("WS", WS))

    def both(text: Column) -> Column:
        return F.zip_with(
            F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2)),
            lambda r, c: F.struct(r.alias("role"), py_strip(c).alias("content")),
        )

    return let(prompt, both)


def call_bodies(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(K.CALL_PATTERN), F.lit(1))


def split_reasoning(text: Column) -> Column:
    """struct(reasoning, rest): the first think block, or all before a lone close tag."""
    block = r"(?s)<think>(.*?)</think>"

    def cut(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(block), F.lit(1))
        has_block, has_close = F.size(found) > 0, F.contains(t, F.lit(K.THINK_CLOSE))
        reasoning = F.when(has_block, py_strip(F.get(found, F.lit(0)))).when(has_close, py_strip(before_first(t, K.THINK_CLOSE)))
        rest = (
            F.when(has_block, F.regexp_replace(t, rf"(?s)<think>.*?</think>[{WS}]*", ""))
            .when(has_close, py_strip(after_first(t, K.THINK_CLOSE)))
            .otherwise(t)
        )
        return F.struct(reasoning.alias("reasoning"), rest.alias("rest"))

    return let(text, cut)


def strip_calls(text: Column, any_parsed: Column) -> Column:
    """Content without its tool-call tags, once at least one of them was read."""
    return py_strip(F.when(any_parsed, F.regexp_replace(text, K.CALL_PATTERN, "")).otherwise(text))


def finish_reason(any_parsed: Column) -> Column:
    return F.when(any_parsed, "tool_calls").otherwise("stop")


def prompt_summary(turns: DataFrame) -> DataFrame:
    """Per conversation: messages before the answer, and the tools of the last system message that has any."""
    listed = F.when(F.col("role") == "system", truthy(F.col("tools")))
    return turns.groupBy("conv_id").agg(
        (F.count("*") - 1).alias("n_prompt"), F.max_by("tools", F.when(listed.isNotNull(), F.col("turn"))).alias("tools")
    )


def context_pieces(turns: DataFrame) -> DataFrame:
    """Earlier turns as 'role: content' lines, then the last question; one ``piece`` per turn row.

    The pieces of a conversation in order are its context.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    placed = with_key_stats(turns, sizes, "conv_id", "n_turns")
    line = F.concat(F.when(F.col("turn") > 0, NL).otherwise(""), F.col("role"), F.lit(": "), F.col("text"))
    last = F.coalesce("text", F.lit(""))
    question = F.when(F.col("n_turns") > 1, F.concat(F.lit(K.HISTORY_CONNECTOR), last)).otherwise(last)
    return placed.withColumn("piece", F.when(F.col("turn") < F.col("n_turns") - 1, line).otherwise(question)).drop("n_turns")


def recent_messages(turns: DataFrame, k: int) -> DataFrame:
    """The last k messages of each conversation as one list, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "msg")))
    kept = last_turns(turns, k).select("conv_id", "turn", turn_message(turns).alias("msg"))
    return kept.groupBy("conv_id").agg(F.transform(ordered, lambda s: s["msg"]).alias("messages"))


def last_messages(messages: Column, k: int | Column) -> Column:
    """The last k messages, the whole conversation when it is shorter."""
    return keep_last(messages, k)


def history_for_client(messages: Column, k: int) -> Column:
    """Client rule: no history still sends the question itself."""
    return keep_last(messages, k or 1)


def history_for_page(messages: Column, k: int, has_tools: Column, name: str = "turnloom") -> Column:
    """Page rule: k earlier messages and the question, a stock system prompt unless tools are on."""
    fresh = F.array(message(F.lit("system"), F.lit(K.HISTORY_SYSTEM_PROMPT.format(name=name))))
    kept = keep_last(messages, k + 1)
    return F.when(has_tools, kept).otherwise(F.concat(fresh, kept))


def history_for_prompt(messages: Column, k: int) -> Column:
    """Prompt rule, before the new question is appended: the last k, none for 0."""
    return keep_last(messages, k)


def last_turns(turns: DataFrame, k: int) -> DataFrame:
    """The last k turn rows of each conversation.

    A rank filter over a window: Spark keeps only k rows per key on the map side
    before the shuffle, so a huge conversation stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").desc()))
    return turns.withColumn("back", rank).where(F.col("back") <= k)
