"""Strict JSON checks.

Spark's own JSON functions accept single quotes and text after the value, and
some reorder keys.  Where a row counts as valid only if it is exactly one JSON
value, the few short bodies cut out by native expressions go through one
Arrow-batched check; rows without a body only carry an empty array.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STR, _STRS = T.StringType(), T.ArrayType(T.StringType())
CALL = T.StructType(
    [
        T.StructField("status", _STR), T.StructField("name", _STR), T.StructField("arguments", _STR),
        T.StructField("present", _STRS), T.StructField("truthy", _STRS), T.StructField("printed", _STR),
    ]
)
CALLS = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), *CALL.fields]))
LISTED_CALLS = T.ArrayType(T.StructType([T.StructField("name", _STR), T.StructField("arguments", _STR)]))


def _dump(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def _load(text):
    """(True, value) for exactly one JSON value, else (False, None)."""
    try:
        return True, json.loads(text)
    except (ValueError, RecursionError):
        return False, None


def _call(body: str) -> tuple:
    """Status, name, read arguments, which of their keys are set and non-empty, and the arguments as given.

    ``arguments`` looks into arguments that are JSON in a string; ``printed`` keeps the string.
    """
    ok, value = _load(body.strip())
    if not ok or not isinstance(value, dict):
        return "other_json" if ok else "invalid", None, None, [], [], None
    name, args = value.get("name", ""), value.get("arguments", {})
    printed = _dump(args)
    if isinstance(args, str):
        ok, args = _load(args)
        args = args if ok else {}
    keys = args if isinstance(args, dict) else {}
    return (
        "object" if isinstance(args, dict) else "bad_arguments",
        name if isinstance(name, str) else _dump(name),
        _dump(args),
        [k for k, v in keys.items() if v is not None],
        [k for k, v in keys.items() if v],
        printed,
    )


@F.pandas_udf(CALL)
def read_call(body: pd.Series) -> pd.DataFrame:
    """The body of one tool-call tag -> a parsed call."""
    return pd.DataFrame([_call(b) for b in body], columns=CALL.fieldNames())


@F.pandas_udf(CALLS)
def read_calls(bodies: pd.Series) -> pd.Series:
    """Bodies of a row's tool-call tags -> parsed calls, in order, one per body."""
    names = CALL.fieldNames()
    return bodies.map(lambda found: [] if found is None else [{"pos": i, **dict(zip(names, _call(b)))} for i, b in enumerate(found)])


@F.pandas_udf(_STRS)
def json_items(text: pd.Series) -> pd.Series:
    """A JSON list in a string -> its items, each printed on its own."""

    def items(raw):
        ok, value = _load(raw) if raw else (False, None)
        return [_dump(v) for v in value] if ok and isinstance(value, list) else None

    return text.map(items)


def _listed(raw: str | None) -> list[dict] | None:
    def one(call):
        call = call.get("function") or call
        args = call.get("arguments")
        return {"name": str(call.get("name") or ""), "arguments": args if isinstance(args, str) else _dump(args)}

    ok, value = _load(raw) if raw else (False, None)
    return [one(c) for c in value if isinstance(c, dict)] if ok and isinstance(value, list) else None


@F.pandas_udf(LISTED_CALLS)
def call_items(text: pd.Series) -> pd.Series:
    """A JSON list of calls in a string -> name and printed arguments.

    A call may be wrapped in a ``function`` field; arguments that are already a
    string are kept as they are.
    """
    return text.map(_listed)


@F.pandas_udf(T.ArrayType(LISTED_CALLS))
def call_item_lists(texts: pd.Series) -> pd.Series:
    """The same for a list of such strings, one per message."""
    return texts.map(lambda row: None if row is None else [_listed(raw) for raw in row])


def strict_object(line: Column, ddl: str) -> Column:
    """A line that is exactly one JSON object, else null; stays in the JVM.

    Spark's parser stops at the end of the first value.  Inside a list and as a
    member of an object, text after the value is an error in at least one of the
    two, and a second value shows in the length of the list.
    """
    options = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}
    listed = F.from_json(F.concat(F.lit("["), line, F.lit("]")), f"array<{ddl}>", options)
    member = F.from_json(F.concat(F.lit('{"v":'), line, F.lit("}")), "struct<v:string,_bad:string>", options)
    return F.when((F.size(listed) == 1) & member["_bad"].isNull() & member["v"].isNotNull(), F.get(listed, F.lit(0)))
