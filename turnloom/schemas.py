"""Explicit schemas of every stage; nothing is inferred from data."""

from pyspark.sql import types as T

_S = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


MSG = _strings("role", "content", "reasoning_content", "tools", "tool_calls")
MSG_DDL = "struct<role:string,content:string,reasoning_content:string,tools:string,tool_calls:string>"
MSG_FIELDS = MSG.fieldNames()

TEXT_ROW = _strings("text")
CHAT_ROW = T.StructType([T.StructField("conversations", T.ArrayType(MSG))])
PAIR_ROW = T.StructType(
    [T.StructField("chosen", T.ArrayType(MSG)), T.StructField("rejected", T.ArrayType(MSG))]
)
RL_ROW = T.StructType(
    [T.StructField("conversations", T.ArrayType(MSG)), T.StructField("gt", T.ArrayType(_S))]
)

# A row as upstream sets publish it, before the shapes are unified.
LOOSE_MSG = _strings("role", "content", "from", "value", "reasoning_content", "tools", "tool_calls")
RAW_CHAT_ROW = T.StructType(
    [
        T.StructField("conversations", T.ArrayType(LOOSE_MSG)),
        T.StructField("messages", T.ArrayType(LOOSE_MSG)),
        T.StructField("instruction", _S),
        T.StructField("input", _S),
        T.StructField("output", _S),
        T.StructField("tools", _S),
        T.StructField("functions", _S),
    ]
)

# A corpus line of the vocabulary trainer: either of two shapes.
CORPUS_ROW = T.StructType(
    [T.StructField("text", _S), T.StructField("conversations", T.ArrayType(_strings("content")))]
)

ROLLOUT_ROW = T.StructType(
    [
        T.StructField("prompt_id", T.LongType()),
        T.StructField("gen", T.IntegerType()),
        T.StructField("prompt", _S),
        T.StructField("completion", _S),
        T.StructField("rm_score", T.DoubleType()),
        T.StructField("completion_ids", T.ArrayType(T.IntegerType())),
        T.StructField("mask", T.ArrayType(T.IntegerType())),
        T.StructField("old_logps", T.ArrayType(T.DoubleType())),
        T.StructField("new_logps", T.ArrayType(T.DoubleType())),
        T.StructField("ref_logps", T.ArrayType(T.DoubleType())),
        T.StructField("values", T.ArrayType(T.DoubleType())),
    ]
)
