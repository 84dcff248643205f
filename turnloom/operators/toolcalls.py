"""Tool calls: reading, checking against the registry, table-backed results."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom import constants as K
from turnloom.functions.jsontext import read_call, read_calls
from turnloom.functions.text import split_words
from turnloom.operators.chat import call_bodies

# The registry is fixed data of some dozens of rows.


def literal_table(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A constant table that stays in the JVM; names are separated by spaces."""
    cols = names.split()

    def cell(value) -> Column:
        if isinstance(value, list):
            return F.array(*[F.lit(v) for v in value]).cast("array<string>")
        return F.lit(value)

    structs = [F.struct(*[cell(v).alias(c) for v, c in zip(row, cols)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def registry(spark: SparkSession) -> DataFrame:
    """name, definition as JSON, and the arguments that must be given."""
    rows = []
    for name, need in K.REQUIRED_ARGS.items():
        tool = {"type": "function", "function": {"name": name, "parameters": {"type": "object", "required": need["present"] + need["truthy"]}}}
        rows.append((name, json.dumps(tool, ensure_ascii=False), need["present"], need["truthy"]))
    return literal_table(spark, rows, "name tool need_present need_truthy")


def select_tools(names: DataFrame, tools: DataFrame) -> DataFrame:
    """Registry entry of each name.  An unknown name is an error, as in a dict lookup."""
    known = names.join(tools, "name", "left")
    missing = F.concat(F.lit("unknown tool: "), F.coalesce(F.col("name"), F.lit("null")))
    return known.withColumn("tool", F.coalesce("tool", F.raise_error(missing).cast("string")))


def explode_calls(df: DataFrame, text: Column) -> DataFrame:
    """One row per tool-call tag: pos, status, name, arguments, argument keys."""
    bodies = df.select("*", F.posexplode(call_bodies(text)).alias("pos", "_body"))
    return bodies.withColumn("_call", read_call(F.col("_body"))).select("*", "_call.*").drop("_body", "_call")


def kept_calls(calls: Column) -> Column:
    """Calls that are JSON objects; anything else counts as malformed."""
    return F.filter(calls, lambda c: c["status"].isin("object", "bad_arguments"))


def named_calls(calls: Column) -> Column:
    """Calls as (id, name, arguments); the id counts tags, not successes."""
    return F.transform(
        kept_calls(calls), lambda c: F.struct(F.concat(F.lit("call_"), c["pos"]).alias("id"), c["name"].alias("name"), c["printed"].alias("arguments"))
    )


def strict_calls(text: Column) -> Column:
    """Only bodies of the form {...}; null without any."""
    bodies = F.regexp_extract_all(text, F.lit(r"(?s)<tool_call>[\p{Z}\x09-\x0d\x1c-\x1f\x85]*(\{.*?\})[\p{Z}\x09-\x0d\x1c-\x1f\x85]*</tool_call>"), F.lit(1))
    named = named_calls(read_calls(bodies))
    return F.when(F.size(named) > 0, named)


def arguments_ok(present: Column, truthy: Column, need_present: Column, need_truthy: Column) -> Column:
    """All required arguments are there; strings must also be non-empty."""
    return (F.size(F.array_except(need_present, present)) == 0) & (F.size(F.array_except(need_truthy, truthy)) == 0)


def check_calls(calls: DataFrame, tools: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Adds ``known`` and ``valid`` per call.

    ``allowed`` (sample_id, name) limits a sample to its own tools; without it
    every registry tool is allowed.
    """
    dim = tools.select("name", "need_present", "need_truthy", F.lit(True).alias("in_registry"))
    out = calls.join(dim, "name", "left").withColumn("known", F.coalesce("in_registry", F.lit(False)))
    ok = F.col("known") & arguments_ok(F.col("present"), F.col("truthy"), F.col("need_present"), F.col("need_truthy"))
    if allowed is not None:
        mark = allowed.select("sample_id", "name").distinct().withColumn("allowed", F.lit(True))
        out = out.join(mark, ["sample_id", "name"], "left")
        ok = ok & F.coalesce("allowed", F.lit(False))
    out = out.withColumn("valid", F.coalesce(ok, F.lit(False)) & (F.col("status") == "object"))
    return out.drop("in_registry", "need_present", "need_truthy", "allowed")


def unknown_calls(calls: DataFrame, tools: DataFrame) -> DataFrame:
    return calls.join(tools.select("name"), "name", "left_anti")


def allowed_calls(calls: DataFrame, allowed: DataFrame) -> DataFrame:
    """Calls whose name is among the sample's own tools."""
    return calls.join(allowed.select("sample_id", "name").distinct(), ["sample_id", "name"], "left_semi")


# --- table-backed results ---------------------------------------------------------


def looked_up(calls: DataFrame, table: DataFrame, on: list[str], defaults: dict[str, Column]) -> DataFrame:
    """Adds the table's columns to calls whose arguments it holds, else the defaults.

    ``table`` has one row per key.  How it is joined is left to Spark's size check.
    """
    return calls.join(table, on, "left").withColumns({name: F.coalesce(F.col(name), default) for name, default in defaults.items()})


def scaled(calls: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """value * factor of the key, half-even at 4 places; unknown keys have factor 1, a missing value is 0."""
    placed = looked_up(calls, table, on, {"factor": F.lit(1.0)})
    return placed.withColumn("result", F.bround(F.coalesce("value", F.lit(0.0)) * F.col("factor"), 4)).drop("factor")


def result_text(result: Column) -> Column:
    """The text a tool turn carries: missing or empty results become an error."""
    filled = F.when((result == "") | (result == "{}") | (result == "null"), F.lit(None)).otherwise(result)
    return F.substring(F.coalesce(filled, F.lit(K.TOOL_NOT_FOUND)), 1, K.TOOL_RESULT_CHARS)


def text_length(text: Column) -> Column:
    """struct(characters, words)."""
    return F.struct(F.length(text).alias("characters"), F.size(split_words(text)).alias("words"))


def call_report(checked: DataFrame, by: list[str]) -> DataFrame:
    """Calls, unknown names, failed checks and executed calls per group."""
    return checked.groupBy(*by).agg(
        F.count("*").alias("calls"),
        F.count_if(~F.col("known")).alias("unknown"),
        F.count_if(F.col("known") & ~F.col("valid")).alias("failed"),
        F.count_if(F.col("valid")).alias("executed"),
    )


def case_report(checked: DataFrame, offered: DataFrame, case: str = "sample_id") -> DataFrame:
    """One row per case: its calls by outcome, calls of tools it was not offered, and whether all of them passed.

    Calls are counted per case and name before anything is joined, so a case
    with very many calls meets its offers as one row per name.
    """
    names = call_report(checked, [case, "name"])
    mark = offered.select(case, "name").distinct().withColumn("_offered", F.lit(True))
    held = names.join(mark, [case, "name"], "left").withColumn("_offered", F.coalesce("_offered", F.lit(False)))
    named = F.col("name").isNotNull()

    def total(n: Column, where: Column | None = None) -> Column:
        return F.sum(n if where is None else F.when(where, n).otherwise(0))

    calls = F.col("calls")
    return held.groupBy(case).agg(
        total(calls).alias("calls"), total(calls, ~named).alias("malformed"), total(F.col("unknown"), named).alias("unknown"),
        total(F.col("failed"), named).alias("failed"), total(F.col("executed")).alias("executed"),
        total(calls, named & ~F.col("_offered")).alias("not_offered"), F.count_if(F.col("executed") > 0).alias("tools_used"),
        F.bool_and((F.col("executed") == calls) & F.col("_offered")).alias("passed"),
    )


def _packed_deltas(deltas: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """Neighbouring rows with the same ``by`` as one row of lists; a list that is all null is null.

    Sorts nothing and moves no row, so it packs what already lies together; the
    rest stays in lists of one.  A list whose seq rises from ``first`` to ``last``
    is ``straight``.
    """
    types = {f.name: f.dataType for f in deltas.schema}
    lists = ["seq", *fields]
    ends = [T.StructField("first", types["seq"]), T.StructField("last", types["seq"]), T.StructField("straight", T.BooleanType())]
    schema = T.StructType([*[T.StructField(c, types[c]) for c in by], *ends, *[T.StructField(c, T.ArrayType(types[c])) for c in lists]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, seq = batch.num_rows, batch.column("seq")
            if not n:
                continue
            begins, falls = np.zeros(n, bool), np.zeros(n, bool)
            begins[0] = True
            for c in by:
                begins[1:] |= np.diff(pc.dictionary_encode(batch.column(c), null_encoding="encode").indices.to_numpy()) != 0
            falls[1:] = ~pc.fill_null(pc.greater(seq[1:], seq[:-1]), False).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(begins)
            offsets = pa.array(np.append(starts, n).astype(np.int32))
            columns = [batch.column(c).take(pa.array(starts)) for c in by]
            odd = (falls & ~begins) | seq.is_null().to_numpy(zero_copy_only=False)
            columns += [seq.take(pa.array(starts)), seq.take(pa.array(np.append(starts[1:], n) - 1)), pa.array(~np.logical_or.reduceat(odd, starts))]
            columns.append(pa.ListArray.from_arrays(offsets, seq))
            for c in fields:
                nothing = np.logical_and.reduceat(batch.column(c).is_null().to_numpy(zero_copy_only=False), starts)
                columns.append(pa.ListArray.from_arrays(offsets, batch.column(c), mask=pa.array(nothing)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return deltas.select(*by, *lists).mapInArrow(pack, schema)


def merge_call_deltas(deltas: DataFrame, run_deltas: int = 1024) -> DataFrame:
    """Streamed pieces of tool calls, joined in order: one row per (response, index).

    Rows: response_id, seq, call_index, id, name, arguments (pieces, may be null).
    Pieces are joined in runs of neighbouring sequence numbers first, so that a
    call with very many pieces is sorted and joined in many tasks; its runs, a
    thousandth of the rows, are joined after that.  Pieces go to their run as
    lists, without a struct and empty fields for each.  Where lists follow one
    another they are joined as they are; only others are sorted piece by piece.
    """
    key, fields = ["response_id", "call_index"], ["id", "name", "arguments"]
    run = F.floor(F.col("seq") / F.lit(run_deltas)).cast("bigint").alias("run")
    filled = deltas.select(*key, run, "seq", *[F.nullif(F.col(f), F.lit("")).alias(f) for f in fields])
    packs = F.col("packs")

    def follows(pack: Column, i: Column) -> Column:
        return pack["straight"] & ((i == 0) | (pack["first"] > F.get(packs, i - 1)["last"]))

    def pieces(pack: Column) -> Column:
        return F.transform(pack["seq"], lambda seq, i: F.struct(seq.alias("seq"), *[F.coalesce(F.get(pack[f], i), F.lit("")).alias(f) for f in fields]))

    def straight(field: str) -> Column:
        return F.flatten(F.transform(packs, lambda p: F.coalesce(p[field], F.array().cast("array<string>"))))

    gathered = F.array_sort(F.collect_list(F.struct("first", "last", "straight", "seq", *fields))).alias("packs")
    held = _packed_deltas(filled, [*key, "run"], fields).groupBy(*key, "run").agg(gathered)
    mixed = F.when(~F.forall(F.transform(packs, follows), lambda x: x), F.array_sort(F.flatten(F.transform(packs, pieces))))
    o = F.col("o")
    runs = held.select(*key, "run", "packs", mixed.alias("o")).select(
        *key, "run", *[F.array_join(F.when(o.isNull(), straight(f)).otherwise(o[f]), "").alias(f) for f in fields]
    )
    ordered = F.array_sort(F.collect_list(F.struct("run", *fields)))
    return runs.groupBy(*key).agg(ordered.alias("o")).select(*key, *[F.array_join(o[f], "").alias(f) for f in fields])
