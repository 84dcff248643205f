"""Tool calls in logged responses: reading, checking, table-backed results."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from turnloom import constants as K
from turnloom.functions.text import py_strip
from turnloom.operators import toolcalls
from turnloom.plans import tables as t
from turnloom.session import spread
from turnloom.plans.sqltext import WS, quoted, strip


def _values(rows, names):
    lines = ", ".join("(" + ", ".join(quoted(v) if isinstance(v, str) else f"{v!r}::double" for v in row) + ")" for row in rows)
    return f"(values {lines}) as v({names})"


def _calls(spark, sf_dir):
    return toolcalls.explode_calls(t.call_texts(spark, sf_dir), F.col("response")).drop("response")


def checked_calls(spark, sf_dir):
    return toolcalls.check_calls(_calls(spark, sf_dir), toolcalls.registry(spark))


def call_parse(spark, sf_dir):
    """Every tool-call body: exactly one JSON object, other JSON, or not JSON."""
    return _calls(spark, sf_dir).select(
        "event_id", "pos", "status", "name", F.size("present").cast("bigint").alias("n_present"), F.size("truthy").cast("bigint").alias("n_truthy")
    )


CALL_PARSE = f"""with {t.CALLS_SQL} select event_id, pos, case when is_object then 'object' when ok then 'other_json' else 'invalid' end as status,
  case when is_object then name end as name, case when is_object then len(json_keys(args)) else 0 end as n_present,
  case when is_object then len(list_filter(json_keys(args), lambda k: json_extract_string(args, '$.' || k) not in ('', '0'))) else 0 end as n_truthy from parsed"""


def strict_calls(spark, sf_dir):
    """Calls whose body is {...}, with ids by position."""
    rows = t.call_texts(spark, sf_dir).select("event_id", F.explode(toolcalls.strict_calls(F.col("response"))).alias("c"))
    return rows.select("event_id", "c.*")


STRICT_CALLS = f"""with {t.CALLS_SQL}, texts as (select event_id, string_agg('<tool_call>' || chr(10) || body || chr(10) || '</tool_call>', '' order by pos) as response from calls group by event_id),
found as (select event_id, regexp_extract_all(response, '(?s)<tool_call>[{WS}]*(\\{{.*?\\}})[{WS}]*</tool_call>', 1) as l from texts),
items as (select event_id, unnest(l) as body, unnest(range(0, len(l))) as n from found),
good as (select event_id, n, json_extract_string(body, '$.name') as name, json_type(json_extract(body, '$.arguments')) = 'VARCHAR' as is_text,
  json_extract(body, '$.arguments')::varchar as args from items where json_valid(body))
select event_id, 'call_' || n as id, name, case when is_text then args else replace(replace(replace(args, '":', '": '), ',"', ', "'), ':  ', ': ') end as arguments from good"""


def tool_validity(spark, sf_dir):
    """Per call: name in the registry, and all required arguments given."""
    return checked_calls(spark, sf_dir).select("event_id", "pos", "known", "valid")


TOOL_VALIDITY = f"with {t.CALLS_SQL} select event_id, pos, is_object and coalesce(known, false) as known, is_object and coalesce(known, false) and coalesce(valid, false) as valid from checked"


def allowed_tools(spark, sf_dir):
    """The tools each user was offered: those behind their larger events."""
    name = (
        F.when(F.col("event_type") == "view", "unit_converter").when(F.col("event_type") == "purchase", "get_current_weather")
        .when(F.col("event_type") == "signup", "get_current_time").otherwise("no_such_tool")
    )
    return t.events(spark, sf_dir).where(F.col("value") > 10).select(F.col("user_id").alias("sample_id"), name.alias("name"))


ALLOWED_SQL = """allowed as (select distinct user_id as sample_id, case event_type when 'view' then 'unit_converter' when 'purchase' then 'get_current_weather'
  when 'signup' then 'get_current_time' else 'no_such_tool' end as name from events where value > 10)"""


def offered_validity(spark, sf_dir):
    """A call counts only if its tool was offered to that sample."""
    checked = toolcalls.check_calls(_calls(spark, sf_dir), toolcalls.registry(spark), allowed_tools(spark, sf_dir))
    return checked.groupBy("name").agg(F.count("*").alias("calls"), F.count_if("valid").alias("valid"))


OFFERED_VALIDITY = f"""with {t.CALLS_SQL}, {ALLOWED_SQL}
select c.name, count(*) as calls, count(*) filter (where c.is_object and coalesce(c.known, false) and coalesce(c.valid, false) and a.name is not null) as valid
from (select *, case when is_object then name end as nm from checked) c left join allowed a on a.sample_id = c.sample_id and a.name = c.nm group by c.name"""


def offered_calls(spark, sf_dir):
    """Calls whose name is among the sample's own tools (set membership)."""
    return toolcalls.allowed_calls(_calls(spark, sf_dir), allowed_tools(spark, sf_dir)).select("event_id", "pos", "sample_id", "name")


OFFERED_CALLS = f"with {t.CALLS_SQL}, {ALLOWED_SQL} select event_id, pos, c.sample_id, c.name from checked c join allowed a on a.sample_id = c.sample_id and a.name = c.name where c.is_object"


def tool_report(spark, sf_dir):
    return toolcalls.call_report(checked_calls(spark, sf_dir).where(F.col("name").isNotNull()), ["name"])


TOOL_REPORT = f"""with {t.CALLS_SQL} select name, count(*) as calls, count(*) filter (where not known) as unknown, count(*) filter (where known and not valid) as failed,
  count(*) filter (where known and valid) as executed from checked where is_object group by name"""


def unknown_tools(spark, sf_dir):
    named = _calls(spark, sf_dir).where(F.col("name").isNotNull())
    return toolcalls.unknown_calls(named, toolcalls.registry(spark)).select("event_id", "pos", "name")


UNKNOWN_TOOLS = f"with {t.CALLS_SQL} select event_id, pos, name from checked where is_object and not known"


def select_tools(spark, sf_dir):
    """Definition of the tool behind each known call."""
    known = checked_calls(spark, sf_dir).where("known").select("event_id", "pos", "name")
    return toolcalls.select_tools(known, toolcalls.registry(spark)).select("event_id", "pos", "name", F.get_json_object("tool", "$.function.parameters.required").alias("required"))


SELECT_TOOLS = f"""with {t.CALLS_SQL} select event_id, pos, c.name, v.required from checked c join
  {_values([(name, json.dumps(need['present'] + need['truthy'], separators=(',', ':'))) for name, need in K.REQUIRED_ARGS.items()], 'name, required')} on v.name = c.name where c.is_object"""


def case_calls(spark, sf_dir):
    """Per sample: calls and how many use a tool it was offered.  Calls are counted per name before the join."""
    named = _calls(spark, sf_dir).where(F.col("name").isNotNull()).groupBy("sample_id", "name").agg(F.count("*").alias("n"))
    offered = toolcalls.looked_up(
        named, allowed_tools(spark, sf_dir).distinct().withColumn("offered", F.lit(True)), ["sample_id", "name"], {"offered": F.lit(False)}
    )
    return offered.groupBy("sample_id").agg(F.sum("n").alias("calls"), F.sum(F.when(F.col("offered"), F.col("n")).otherwise(0)).alias("in_case"))


CASE_CALLS = f"""with {t.CALLS_SQL}, {ALLOWED_SQL} select c.sample_id, count(*) as calls, count(a.name) as in_case
  from checked c left join allowed a on a.sample_id = c.sample_id and a.name = c.name where c.is_object group by 1"""


def key_lookup(spark, sf_dir):
    """One argument looked up: a supplier's nation, some of them not in the table."""
    asked = t.table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") + F.col("s_suppkey") % 3 * 10).cast("int").alias("nationkey"))
    names = t.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("nation"))
    return toolcalls.looked_up(asked, names, ["nationkey"], {"nation": F.lit("unknown")}).select("s_suppkey", "nationkey", "nation")


KEY_LOOKUP = """with x as (select s_suppkey, cast(s_nationkey + s_suppkey % 3 * 10 as integer) as nationkey from supplier)
select s_suppkey, nationkey, coalesce(n_name, 'unknown') as nation from x left join nation on n_nationkey = nationkey"""


def pair_lookup(spark, sf_dir):
    """A value scaled by the factor of two arguments: the greatest balance of a nation and segment, where it is not negative."""
    customers = t.table(spark, sf_dir, "customer")
    on = ["c_nationkey", "c_mktsegment"]
    factors = customers.groupBy(*on).agg(F.max("c_acctbal").alias("factor")).where(F.col("factor") >= 5000)
    asked = customers.select("c_custkey", *on, F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey") / 3).alias("value"))
    return toolcalls.scaled(asked, factors, on).select("c_custkey", "result")


PAIR_LOOKUP = """with f as (select c_nationkey, c_mktsegment, max(c_acctbal) as factor from customer group by 1, 2 having max(c_acctbal) >= 5000)
select c_custkey, round_even(case when c_custkey % 7 <> 0 then c_custkey / 3.0::double else 0.0::double end * coalesce(factor, 1.0::double), 4) as result
from customer c left join f on f.c_nationkey = c.c_nationkey and f.c_mktsegment = c.c_mktsegment"""


def text_lookup(spark, sf_dir):
    """Whole texts looked up with their language: the first document with both, its own id where there is one only."""
    docs, on = t.documents(spark, sf_dir), ["text", "lang"]
    firsts = docs.groupBy(*on).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where(F.col("n") > 1).drop("n")
    return toolcalls.looked_up(docs.select("doc_id", *on), firsts, on, {"first_id": F.col("doc_id")}).select("doc_id", "first_id")


TEXT_LOOKUP = """with f as (select text, lang, min(doc_id) as first_id from documents group by 1, 2 having count(*) > 1)
select doc_id, coalesce(first_id, doc_id) as first_id from documents d left join f on f.text = d.text and f.lang = d.lang"""


def result_text(spark, sf_dir):
    """What a tool turn carries: the first 2048 characters, or an error."""
    kind = F.col("doc_id") % 5
    result = F.when(kind == 0, F.lit(None).cast("string")).when(kind == 1, F.lit("{}")).otherwise(F.concat(F.lit('{"result": "'), F.col("text"), F.lit('"}')))
    return t.documents(spark, sf_dir).select("doc_id", toolcalls.result_text(result).alias("content"))


RESULT_TEXT = """select doc_id, case when doc_id % 5 in (0, 1) then '{"error": "tool not found"}' else substr('{"result": "' || text || '"}', 1, 2048) end as content from documents"""


def text_length(spark, sf_dir):
    return spread(t.documents(spark, sf_dir)).select("doc_id", toolcalls.text_length(F.col("text")).alias("n")).select(
        "doc_id", F.col("n.characters").cast("bigint").alias("characters"), F.col("n.words").cast("bigint").alias("words")
    )


TEXT_LENGTH = f"select doc_id, length(text) as characters, len(regexp_extract_all(text, '[^{WS}]+')) as words from documents"


def call_deltas(spark, sf_dir):
    """Streamed call pieces: an id, a name in two pieces, then the words of the arguments."""
    rows = spread(t.documents(spark, sf_dir)).select(F.col("doc_id").alias("response_id"), py_strip(F.col("text")).alias("text"))
    none = F.lit(None).cast("string")

    def piece(id_=none, name=none, arguments=none):
        return F.struct(id_.alias("id"), name.alias("name"), arguments.alias("arguments"))

    opening = F.array(piece(id_=F.concat(F.lit("call_"), F.col("response_id").cast("string")), name=F.lit("unit_")), piece(name=F.lit("converter")))
    words = F.transform(F.split("text", " "), lambda w: piece(arguments=w))
    deltas = rows.select("response_id", (F.col("response_id") % 3).cast("int").alias("call_index"), F.posexplode(F.concat(opening, words)).alias("seq", "p"))
    return toolcalls.merge_call_deltas(deltas.select("response_id", "call_index", "seq", "p.*"))


CALL_DELTAS = f"""with w as (select doc_id, string_split({strip('text')}, ' ') as l from documents)
select doc_id as response_id, cast(doc_id % 3 as integer) as call_index, 'call_' || doc_id as id, 'unit_converter' as name, array_to_string(l, '') as arguments from w"""

QUERIES = {
    "call_parse": (call_parse, CALL_PARSE),
    "strict_calls": (strict_calls, STRICT_CALLS),
    "tool_validity": (tool_validity, TOOL_VALIDITY),
    "offered_validity": (offered_validity, OFFERED_VALIDITY),
    "offered_calls": (offered_calls, OFFERED_CALLS),
    "tool_report": (tool_report, TOOL_REPORT),
    "unknown_tools": (unknown_tools, UNKNOWN_TOOLS),
    "select_tools": (select_tools, SELECT_TOOLS),
    "case_calls": (case_calls, CASE_CALLS),
    "key_lookup": (key_lookup, KEY_LOOKUP),
    "pair_lookup": (pair_lookup, PAIR_LOOKUP),
    "text_lookup": (text_lookup, TEXT_LOOKUP),
    "result_text": (result_text, RESULT_TEXT),
    "text_length": (text_length, TEXT_LENGTH),
    "call_deltas": (call_deltas, CALL_DELTAS),
}
