"""The given tables, and row shapes that Spark derives from them.

The tables hold plain text; tags, calls, pairs and mixed shapes are derived here
so that every operator has whole tables to work on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.operators.normalize import message
from turnloom.schemas import LOOSE_MSG
from turnloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def conversations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


def responses(spark, sf_dir) -> DataFrame:
    """Assistant turns: plain, with a think block, with a good or a broken tool call."""
    call = '<tool_call>{"name": "get_exchange_rate", "arguments": {"from_currency": "USD", "to_currency": "KRW"}}</tool_call>'
    text, kind = F.col("text"), F.pmod("conv_id", F.lit(4))
    shaped = (
        F.when(kind == 0, text)
        .when(kind == 1, F.concat(F.lit("<think>"), F.substring(text, 1, 80), F.lit("</think>"), F.substring(text, F.lit(81), F.length(text))))
        .when(kind == 2, F.concat(F.lit(call), text))
        .otherwise(F.concat(F.lit('<tool_call>{"name": "nope", '), text))
    )
    return conversations(spark, sf_dir).where(F.col("role") == "assistant").select("conv_id", "turn", "text", shaped.alias("response"))


RESPONSES_SQL = """responses as (
  select conv_id, turn, text, case conv_id % 4 when 0 then text
    when 1 then concat('<think>', substr(text,1,80), '</think>', substr(text,81))
    when 2 then concat('<tool_call>{"name": "get_exchange_rate", "arguments": {"from_currency": "USD", "to_currency": "KRW"}}</tool_call>', text)
    else concat('<tool_call>{"name": "nope", ', text) end as response
  from conversations where role = 'assistant')"""


def text_parts() -> dict[str, Column]:
    """The whole text in three pieces; the middle one is empty for even ids."""
    text, even = F.col("text"), F.pmod("doc_id", F.lit(2)) == 0
    rest = F.when(even, F.lit(81)).otherwise(F.lit(121))
    return {
        "head": F.substring(text, 1, 80),
        "extra": F.when(even, F.lit("")).otherwise(F.substring(text, 81, 40)),
        "tail": F.substring(text, rest, F.length(text)),
    }


PARTS_SQL = """parts as (
  select doc_id, source, lang, substr(text, 1, 80) as head,
    case when doc_id % 2 = 0 then '' else substr(text, 81, 40) end as extra,
    case when doc_id % 2 = 0 then substr(text, 81) else substr(text, 121) end as tail
  from documents)"""


def loose(**given: Column) -> Column:
    """A message as published: any of the known keys, the others missing."""
    return F.struct(*[given[f].alias(f) if f in given else F.expr(f"cast(null as string) as `{f}`") for f in LOOSE_MSG.fieldNames()])


def mixed_rows(spark, sf_dir) -> DataFrame:
    """Five row shapes: instruction, tagged, messages, role/content, and one that fits nothing."""
    kind = F.pmod("doc_id", F.lit(5))
    head, extra, tail = F.col("head"), F.col("extra"), F.col("tail")
    asker = F.when(F.col("extra") == "", F.lit("human")).otherwise(F.lit("narrator"))
    tagged = F.array(loose(**{"from": asker, "value": F.concat(head, extra)}), loose(**{"from": F.lit("gpt"), "value": tail}))
    plain = F.array(loose(role=F.lit("user"), content=F.concat(head, extra)), loose(role=F.lit("assistant"), content=tail))
    return (
        spread(documents(spark, sf_dir))
        .select("doc_id", "source", "lang", *[c.alias(n) for n, c in text_parts().items()])
        .select(
            "doc_id", "source", "lang",
            F.when(kind == 1, tagged).when(kind == 3, plain).alias("conversations"),
            F.when(kind == 2, plain).alias("messages"),
            F.when(kind == 0, head).alias("instruction"), F.when(kind == 0, extra).alias("input"), F.when(kind == 0, tail).alias("output"),
            F.lit(None).cast("string").alias("tools"), F.lit(None).cast("string").alias("functions"),
        )
    )


MIXED_SQL = PARTS_SQL + """, mixed as (
  select doc_id, source, 0 as pos, 'user' as role, case when extra = '' then head else head || chr(10) || chr(10) || extra end as content
    from parts where doc_id % 5 = 0 and head <> '' and tail <> ''
  union all select doc_id, source, 1, 'assistant', tail from parts where doc_id % 5 = 0 and head <> '' and tail <> ''
  union all select doc_id, source, 0, 'user', head || extra from parts where doc_id % 5 in (1, 2, 3)
  union all select doc_id, source, 1, 'assistant', tail from parts where doc_id % 5 in (1, 2, 3))"""


def dialog_rows(spark, sf_dir) -> DataFrame:
    """Tool dialogs in both message shapes and columns, tools in either column or none."""
    kind = F.pmod("doc_id", F.lit(4))
    head, extra, tail = F.col("head"), F.col("extra"), F.col("tail")
    with_system = F.array(
        loose(role=F.lit("user"), content=head), loose(role=F.lit("system"), content=F.col("source")),
        loose(role=F.lit("system"), content=F.col("lang")), loose(role=F.lit("assistant"), content=F.concat(extra, tail)),
    )
    tagged = F.array(
        loose(**{"from": F.lit("human"), "value": head}), loose(**{"from": F.lit("function_call"), "value": extra}),
        loose(**{"from": F.lit("observation"), "value": tail}),
    )
    plain = F.array(loose(role=F.lit("user"), content=F.concat(head, extra)), loose(role=F.lit("assistant"), content=tail))
    listed = F.concat(F.lit('[{"name": "'), F.col("source"), F.lit('"}]'))
    return (
        spread(documents(spark, sf_dir))
        .select("doc_id", "source", "lang", *[c.alias(n) for n, c in text_parts().items()])
        .select(
            "doc_id",
            F.when(kind == 0, with_system).when(kind == 1, tagged).alias("conversations"),
            F.when(kind == 2, plain).alias("messages"),
            F.when(kind.isin(1, 2), listed).alias("tools"), F.when(kind.isin(0, 1), F.concat(listed, F.lit(" "))).alias("functions"),
        )
    )


DIALOG_SQL = PARTS_SQL + """, listed as (select *, '[{"name": "' || source || '"}]' as tools from parts), dialogs as (
  select doc_id, 0 as pos, 'user' as role, head as content, null as tools from listed where doc_id % 4 = 0
  union all select doc_id, 1, 'system', source, tools || ' ' from listed where doc_id % 4 = 0
  union all select doc_id, 2, 'system', lang, null from listed where doc_id % 4 = 0
  union all select doc_id, 3, 'assistant', extra || tail, null from listed where doc_id % 4 = 0
  union all select doc_id, 0, 'system', '', tools from listed where doc_id % 4 in (1, 2)
  union all select doc_id, 1, 'user', head, null from listed where doc_id % 4 = 1
  union all select doc_id, 2, 'assistant', extra, null from listed where doc_id % 4 = 1
  union all select doc_id, 3, 'tool', tail, null from listed where doc_id % 4 = 1
  union all select doc_id, 1, 'user', head || extra, null from listed where doc_id % 4 = 2
  union all select doc_id, 2, 'assistant', tail, null from listed where doc_id % 4 = 2)"""


def math_source(spark, sf_dir) -> DataFrame:
    """Question under one of three names; solution as text or as a message list."""
    solution = F.concat(
        F.col("text"), F.lit(" = "), F.col("n_chars").cast("string"), F.when(F.pmod("doc_id", F.lit(3)) == 0, F.lit(".")).otherwise(F.lit(""))
    )
    kind = F.pmod("doc_id", F.lit(3))
    asked = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.lit("")).otherwise(F.col("text"))
    return documents(spark, sf_dir).select(
        "doc_id", "source",
        F.when(kind == 0, asked).alias("question"), F.when(kind == 1, asked).alias("prompt"), F.when(kind == 2, asked).alias("instruction"),
        F.when(
            F.pmod("doc_id", F.lit(2)) == 0,
            F.array(message(F.lit("assistant"), F.lit("0")), message(F.lit("assistant"), solution), message(F.lit("user"), F.lit("7"))),
        ).alias("chosen_list"),
        F.when(F.pmod("doc_id", F.lit(2)) == 1, solution).alias("chosen_text"),
    )


# RE2 has no look-ahead: the character after the number is read instead, and a
# sign is set apart so that it can start the next number.
LAST_NUMBER_SQL = r"""coalesce(replace(list_extract(regexp_extract_all(replace({x}, '-', ' -'), '(-?\d[\d,]*(?:\.\d+)?)($|[^\d.])', 1), -1), ',', ''), '')"""

MATH_SQL = (
    """math as (
  select doc_id, source, case when doc_id % 7 = 0 then '' else text end as question,
    """
    + LAST_NUMBER_SQL.format(x="(text || ' = ' || cast(n_chars as varchar) || case when doc_id % 3 = 0 then '.' else '' end)")
    + """ as gt from documents)"""
)


def preference_rows(spark, sf_dir) -> DataFrame:
    """Good documents, paired with the next document where that one is bad."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rated = docs.join(labels, "doc_id")
    good = rated.where(F.col("quality") == 1).select("doc_id", "source", F.col("text").alias("good"))
    bad = rated.where(F.col("quality") == 0).select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("bad"))
    asked = message(F.lit("user"), F.col("source"))
    return good.join(bad, "doc_id", "left").select(
        F.col("doc_id").alias("pair_id"),
        F.array(asked, message(F.lit("assistant"), F.col("good"))).alias("chosen"),
        F.when(F.col("bad").isNotNull(), F.array(asked, message(F.lit("assistant"), F.col("bad")))).alias("rejected"),
    )


PAIRS_SQL = """rated as (select d.doc_id, d.source, d.text, l.quality from documents d join labels l on d.doc_id = l.doc_id),
pairs as (select c.doc_id as pair_id, c.source, c.text as good, r.text as bad
  from (select * from rated where quality = 1) c left join (select * from rated where quality = 0) r on r.doc_id = c.doc_id + 1)"""


def logged_tokens(spark, sf_dir) -> DataFrame:
    """Per-token numbers of logged rollouts: 64 per row from the vectors."""
    vec = F.col("embedding").cast("array<double>")
    length = F.pmod("vec_id", F.lit(48)) + 1
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("sample_id"), F.col("label").cast("bigint").alias("prompt_id"),
        F.transform(vec, lambda x: -F.abs(x) * 2.0).alias("new_logps"),
        F.transform(vec, lambda x: -F.abs(x) * 1.5).alias("old_logps"),
        F.transform(vec, lambda x: -F.abs(x) * 1.75).alias("ref_logps"),
        vec.alias("values"),
        F.transform(vec, lambda _x, i: F.when(i < length, 0).otherwise(1)).alias("mask"),
        F.transform(vec, lambda x, i: F.when(F.pmod(i * 7 + F.col("vec_id"), F.lit(29)) == 0, 2).otherwise(3 + i)).cast("array<int>").alias("ids"),
        (F.pmod("vec_id", F.lit(13)) / 4.0 - 1.5).alias("reward"),
    )


TOKENS_SQL = """toks as (
  select vec_id as sample_id, cast(label as bigint) as prompt_id, vec_id, i - 1 as i, cast(embedding[i] as double) as v,
    -abs(cast(embedding[i] as double)) * 2.0::double as new_lp, -abs(cast(embedding[i] as double)) * 1.5::double as old_lp,
    -abs(cast(embedding[i] as double)) * 1.75::double as ref_lp,
    case when i - 1 < vec_id % 48 + 1 then 0 else 1 end as m,
    case when ((i - 1) * 7 + vec_id) % 29 = 0 then 2 else 3 + i - 1 end as id,
    (vec_id % 13) / 4.0::double - 1.5::double as reward
  from (select *, unnest(range(1, len(embedding) + 1)) as i from embeddings))"""


def call_texts(spark, sf_dir) -> DataFrame:
    """One response per event, with one or two tool calls; some are not valid."""
    n = F.round(F.col("value") * 100).cast("bigint").cast("string")
    unit = F.concat(F.lit('{"name": "unit_converter", "arguments": {"value": '), n, F.lit(', "from_unit": "km", "to_unit": "miles"}}'))
    rate = F.lit('{"name": "get_exchange_rate", "arguments": "{\\"from_currency\\": \\"USD\\", \\"to_currency\\": \\"\\"}"}')
    place = F.when(F.pmod("event_id", F.lit(2)) == 0, F.lit("Paris")).otherwise(F.lit(""))
    weather = F.concat(F.lit('{"name": "get_current_weather", "arguments": {"location": "'), place, F.lit('"}}'))
    time = F.lit('{"name": "get_current_time", "arguments": {}}')
    kind = F.pmod("event_id", F.lit(5))
    broken = (
        F.when(kind == 0, F.lit("[1]")).when(kind == 1, F.lit("{'a': 1}")).when(kind == 2, F.lit('{"name": "x"} y'))
        .when(kind == 3, F.lit('{"name": "no_such_tool", "arguments": {"a": 1}}')).otherwise(F.lit('{"name": "cut", "arguments": '))
    )
    what = F.col("event_type")
    body = F.when(what == "view", unit).when(what == "click", rate).when(what == "purchase", weather).when(what == "signup", time).otherwise(broken)
    wrap = lambda b: F.concat(F.lit("<tool_call>\n"), b, F.lit("\n</tool_call>"))
    second = F.when(F.pmod("event_id", F.lit(3)) == 0, wrap(time)).otherwise(F.lit(""))
    return spread(events(spark, sf_dir)).select("event_id", F.col("user_id").alias("sample_id"), "event_type", F.concat(F.col("props"), wrap(body), second).alias("response"))


CALLS_SQL = r"""bodies as (
  select event_id, user_id as sample_id, event_type, case event_type
    when 'view' then '{"name": "unit_converter", "arguments": {"value": ' || cast(cast(round(value * 100) as bigint) as varchar) || ', "from_unit": "km", "to_unit": "miles"}}'
    when 'click' then '{"name": "get_exchange_rate", "arguments": "{\"from_currency\": \"USD\", \"to_currency\": \"\"}"}'
    when 'purchase' then '{"name": "get_current_weather", "arguments": {"location": "' || case when event_id % 2 = 0 then 'Paris' else '' end || '"}}'
    when 'signup' then '{"name": "get_current_time", "arguments": {}}'
    else case event_id % 5 when 0 then '[1]' when 1 then '{''a'': 1}' when 2 then '{"name": "x"} y'
      when 3 then '{"name": "no_such_tool", "arguments": {"a": 1}}' else '{"name": "cut", "arguments": ' end end as body
  from events),
calls as (
  select event_id, sample_id, 0 as pos, body from bodies
  union all select event_id, sample_id, 1, '{"name": "get_current_time", "arguments": {}}' from bodies where event_id % 3 = 0),
parsed as (
  select *, json_valid(body) as ok, case when json_valid(body) then json_type(body::json) = 'OBJECT' else false end as is_object,
    case when json_valid(body) then json_extract_string(body, '$.name') end as name,
    case when json_valid(body) then case when json_type(json_extract(body, '$.arguments')) = 'VARCHAR'
      then json_extract_string(body, '$.arguments') else json_extract(body, '$.arguments')::varchar end end as args
  from calls),
checked as (
  select *, name in ('calculate_math','unit_converter','get_current_weather','get_current_time','get_exchange_rate','translate_text') as known,
    case name when 'unit_converter' then json_extract(args, '$.value') is not null
        and coalesce(json_extract_string(args, '$.from_unit'), '') <> '' and coalesce(json_extract_string(args, '$.to_unit'), '') <> ''
      when 'get_exchange_rate' then coalesce(json_extract_string(args, '$.from_currency'), '') <> '' and coalesce(json_extract_string(args, '$.to_currency'), '') <> ''
      when 'get_current_weather' then coalesce(json_extract_string(args, '$.location'), '') <> ''
      when 'get_current_time' then true else false end as valid
  from parsed)"""


def chunks(spark, sf_dir, size: int = 64) -> DataFrame:
    """Documents as a stream of text pieces with event times.

    Every other document has a think close tag put into it, and every third ends
    on a tool call; two of four start in thinking, one with and one without a tag.
    """
    pieces = F.regexp_extract_all("text", F.lit(f"(?s)(.{{1,{size}}})"), F.lit(1))
    return (
        spread(documents(spark, sf_dir))
        .select("doc_id", marked_text().alias("text"))
        .select("doc_id", F.size(pieces).alias("n"), F.posexplode(pieces).alias("seq", "chunk"))
        .select(
            F.col("doc_id").alias("response_id"), "seq", F.timestamp_seconds(F.lit(1704067200) + F.col("seq")).alias("ts"), "chunk",
            (F.col("seq") == F.col("n") - 1).alias("done"), (F.pmod("doc_id", F.lit(4)) < 2).alias("open_thinking"),
        )
    )


def marked_text() -> Column:
    text = F.col("text")
    cut = F.concat(F.substring(text, 1, 100), F.lit("</think>\n\n"), F.substring(text, F.lit(101), F.length(text)))
    marked = F.when(F.pmod("doc_id", F.lit(2)) == 0, cut).otherwise(text)
    call = F.lit('<tool_call>{"name": "get_current_time"}</tool_call>')
    return F.when(F.pmod("doc_id", F.lit(3)) == 0, F.concat(marked, call)).otherwise(marked)


MARKED_SQL = """marked as (
  select doc_id, case when doc_id % 2 = 0 then substr(text, 1, 100) || '</think>' || chr(10) || chr(10) || substr(text, 101) else text end ||
    case when doc_id % 3 = 0 then '<tool_call>{"name": "get_current_time"}</tool_call>' else '' end as text
  from documents)"""
