"""Places where a user plugs in Python of their own: rows, scorers, batches.

All three work on what Spark hands to a task, a batch of rows or a bounded
partition, and check what the user's code returns before it becomes a column.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

RowFunction = Callable[[dict], "dict | None"]
Scorer = Callable[[list, list], Sequence[float]]
SCORE_LIMIT = 3.0


def map_rows(df: DataFrame, row_function: RowFunction, schema: str | StructType) -> DataFrame:
    """The rows that a user's function makes of each row; None leaves a row out.

    The function gets a row as a dict and returns a dict.  Keys it leaves out are
    null.  A key that the schema lacks, or a value of another type, fails the job
    with the key's name, so that nothing is lost by a slip in spelling.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = set(wanted.names)
    arrow = to_arrow_schema(wanted)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                out = row_function(row)
                if out is None:
                    continue
                if unknown := sorted(set(out) - names):
                    raise ValueError(f"the row function returned keys that the schema lacks: {', '.join(unknown)}")
                made.append(out)
            columns = []
            for f in arrow:
                try:
                    columns.append(pa.array([r.get(f.name) for r in made], type=f.type))
                except (pa.ArrowInvalid, pa.ArrowTypeError) as wrong:
                    raise TypeError(f"the row function's {f.name!r} is no {f.type}: {wrong}") from wrong
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(mapped, wanted)


def score_rows(df: DataFrame, scorer: Scorer, messages: Column, response: Column, out: str = "rm_score", limit: float = SCORE_LIMIT) -> DataFrame:
    """Adds the score of a user's model, held to [-limit, limit].

    The scorer gets a batch: a list of message lists and a list of responses, and
    returns as many numbers.  None and NaN become null.  Rows whose response is
    null are not scored.  The other columns pass unchanged and may be of any type.
    """
    for taken in ("_messages", "_response"):
        if taken in df.columns:
            raise ValueError(f"the table already has a column {taken}")
    with_inputs = df.drop(out).select("*", messages.alias("_messages"), response.alias("_response"))
    kept = df.drop(out).columns
    schema = StructType([*df.drop(out).schema.fields, StructField(out, DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = batch.column(batch.schema.names.index("_response")).to_pylist()
            given = batch.column(batch.schema.names.index("_messages")).to_pylist()
            asked = [i for i, text in enumerate(said) if text is not None]
            values: list[float | None] = [None] * len(said)
            if asked:
                got = list(scorer([given[i] or [] for i in asked], [said[i] for i in asked]))
                if len(got) != len(asked):
                    raise ValueError(f"the scorer returned {len(got)} scores for {len(asked)} responses")
                for i, value in zip(asked, got):
                    number = None if value is None else float(value)
                    values[i] = None if number is None or math.isnan(number) else max(-limit, min(limit, number))
            columns = [batch.column(batch.schema.names.index(name)) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.float64())], names=[*kept, out])

    return with_inputs.mapInArrow(scored, schema)


class TokenBatches:
    """Table function: rows in order cut into batches by rows and by tokens.

    Reads (shard, place, row_id, n_tokens) and gives one row per batch: shard,
    batch, n_rows, n_tokens, row_ids.  A batch ends before the row that would
    exceed ``max_rows`` or ``max_tokens``; a row beyond ``max_tokens`` has a
    batch to itself.  Where a batch ends depends on where the last one did, so
    this is a walk; ``shard`` bounds its length.
    """

    NEEDS = ("shard", "place", "row_id", "n_tokens")

    @staticmethod
    def analyze(rows: AnalyzeArgument, max_rows: AnalyzeArgument, max_tokens: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument must be a table")
        have = set(rows.dataType.names)
        if missing := [n for n in TokenBatches.NEEDS if n not in have]:
            raise ValueError(f"the table lacks {', '.join(missing)}")
        for name, bound in (("max_rows", max_rows), ("max_tokens", max_tokens)):
            if not bound.isConstantExpression or bound.value is None or bound.value < 1:
                raise ValueError(f"{name} must be a constant of at least 1")
        row_id = rows.dataType["row_id"].dataType
        schema = StructType(
            [
                StructField("shard", LongType()), StructField("batch", IntegerType()), StructField("n_rows", LongType()),
                StructField("n_tokens", LongType()), StructField("row_ids", ArrayType(row_id)),
            ]
        )
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn("shard")], orderBy=[OrderingColumn("place")])

    def __init__(self):
        self.shard, self.batch, self.ids, self.tokens = None, 0, [], 0

    def _flush(self):
        done = (self.shard, self.batch, len(self.ids), self.tokens, self.ids)
        self.batch, self.ids, self.tokens = self.batch + 1, [], 0
        return done

    def eval(self, row, max_rows: int, max_tokens: int):
        size = row["n_tokens"] or 0
        if self.ids and (len(self.ids) == max_rows or self.tokens + size > max_tokens):
            yield self._flush()
        self.shard = row["shard"]
        self.ids.append(row["row_id"])
        self.tokens += size

    def terminate(self):
        if self.ids:
            yield self._flush()


def token_batches(rows: DataFrame, max_rows: int, max_tokens: int) -> DataFrame:
    """Batches of rows (shard, place, row_id, n_tokens): one row per batch, see ``TokenBatches``."""
    cut = F.udtf(TokenBatches, useArrow=True)
    return cut(rows.select(*TokenBatches.NEEDS).asTable(), F.lit(max_rows), F.lit(max_tokens))
