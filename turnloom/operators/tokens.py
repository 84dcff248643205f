"""Token arrays: truncation, padding, labels, masks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom import constants as K
from turnloom.functions.bpe import Codec, base_vocab
from turnloom.functions.arrays import drop_end, drop_start, keep_last, pad_left, pad_right, total_int


def int_array(ids: Column) -> Column:
    return ids.cast("array<int>")


def pretrain_ids(ids: Column, max_length: int) -> Column:
    """BOS, at most max_length-2 ids, EOS, padding on the right."""
    framed = F.concat(F.array(F.lit(K.BOS_ID)), F.slice(ids, 1, max_length - 2), F.array(F.lit(K.EOS_ID)))
    return pad_right(framed, max_length, K.PAD_ID)


def pretrain_labels(input_ids: Column) -> Column:
    return F.transform(input_ids, lambda x: F.when(x == K.PAD_ID, K.IGNORE_LABEL).otherwise(x))


def fixed_length(ids: Column, max_length: int) -> Column:
    return pad_right(F.slice(ids, 1, max_length), max_length, K.PAD_ID)


def _occurrences(ids: np.ndarray, pattern: np.ndarray) -> np.ndarray:
    if len(ids) < len(pattern):
        return np.empty(0, dtype=np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(ids, len(pattern))
    return np.flatnonzero((windows == pattern).all(axis=1))


def answer_spans(ids: np.ndarray, opening: np.ndarray, closing: np.ndarray) -> list[tuple[int, int]]:
    """[start, stop) of every answer, its closing mark included.

    An answer without a closing mark runs to the end of the array.
    """
    opens, closes = _occurrences(ids, opening), _occurrences(ids, closing)
    spans, at = [], 0
    while (nth := np.searchsorted(opens, at)) < len(opens):
        start = int(opens[nth]) + len(opening)
        end = np.searchsorted(closes, start)
        at = int(closes[end]) + len(closing) if end < len(closes) else len(ids)
        spans.append((start, at))
    return spans


def answer_labels(opening: list[int], closing: list[int], max_length: int):
    """A Column function ids -> labels: ids inside answers, -100 elsewhere.

    A scan with state over long arrays, which array functions would do by copying
    at every step; here it is one Arrow batch and one numpy search per row.
    """

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def label(ids: pd.Series) -> pd.Series:
        head, tail = np.asarray(opening, dtype="int32"), np.asarray(closing, dtype="int32")

        def one(row):
            arr = np.asarray(row, dtype="int32")
            out = np.full(len(arr), K.IGNORE_LABEL, dtype="int32")
            for start, stop in answer_spans(arr, head, tail):
                out[start : min(stop, max_length)] = arr[start : min(stop, max_length)]
            return out

        return ids.map(one, na_action="ignore")

    return label


def answer_marks(vocab: list[str] | None = None, merges: list[tuple[str, str]] | None = None) -> tuple[list[int], list[int]]:
    """Ids of what opens and closes an answer, under a vocabulary."""
    codec = Codec(vocab or base_vocab(), merges or [])
    return codec.encode(f"{K.BOS}assistant\n"), codec.encode(f"{K.EOS}\n")


def loss_mask(labels: Column) -> Column:
    return F.transform(labels, lambda x: F.when(x == K.IGNORE_LABEL, 0).otherwise(1))


def shifted(ids: Column, mask: Column) -> dict[str, Column]:
    """Next-token view: x without the last id, y and mask without the first."""
    return {"x": drop_end(ids), "y": drop_start(ids), "mask": drop_start(mask)}


def mark_pads(ids: Column, real: Column) -> Column:
    """Keeps the ids of real tokens only (strips left padding)."""
    pairs = F.zip_with(ids, real, lambda i, m: F.struct(i.alias("i"), m.alias("m")))
    return F.transform(F.filter(pairs, lambda p: p["m"] == 1), lambda p: p["i"])


def left_padded(ids: Column, max_length: int, width: Column | int) -> Column:
    """The last max_length ids, padded on the left."""
    return pad_left(keep_last(ids, max_length), width, K.PAD_ID)


def batch_width(df: DataFrame, ids: str, batch: str) -> DataFrame:
    """Adds ``width``, the longest array of the row's batch.

    Batches are of fixed size by construction (see the manifest), so a window
    group never grows with the data.
    """
    return df.withColumn("width", F.max(F.size(ids)).over(Window.partitionBy(batch)))


def dense_batches(df: DataFrame, ids: str, batch: str, order: str) -> DataFrame:
    """(batch, n_rows, width, ids, mask): every batch as one tensor of bytes.

    ``ids`` holds the rows in order, each padded on the right to the longest, as
    little-endian 32-bit integers; ``mask`` has one bit a token, lowest first, each
    row starting a new byte.  Batches are of fixed size by construction, which
    bounds the aggregate.  Null lists are rows without tokens.
    """
    listed = F.coalesce(F.col(ids), F.array().cast("array<int>"))
    rows = df.groupBy(batch).agg(F.array_sort(F.collect_list(F.struct(order, listed.alias("_ids")))).alias("_rows"))
    rows = rows.withColumn("width", F.array_max(F.transform("_rows", lambda r: F.size(r["_ids"]))))

    def word(i: Column) -> Column:
        h = F.lpad(F.hex(i), 8, "0")
        return F.concat(*[F.substring(h, at, 2) for at in (7, 5, 3, 1)])

    def bits(n: Column) -> Column:
        full, rest = F.floor(n / 8).cast("int"), F.pmod(n, F.lit(8))
        some = F.when(rest > 0, F.lpad(F.hex(F.pow(F.lit(2), rest).cast("int") - 1), 2, "0")).otherwise("")
        return F.rpad(F.concat(F.repeat(F.lit("FF"), full), some), 2 * F.ceil(F.col("width") / 8).cast("int"), F.lit("0"))

    padded = F.transform("_rows", lambda r: F.array_join(F.transform(pad_right(r["_ids"], F.col("width"), K.PAD_ID), word), ""))
    masks = F.transform("_rows", lambda r: bits(F.size(r["_ids"])))
    return rows.select(
        batch, F.size("_rows").alias("n_rows"), "width",
        F.unhex(F.array_join(padded, "")).alias("ids"), F.unhex(F.array_join(masks, "")).alias("mask"),
    )


def rectangular(ids: Column, width: Column, value=K.PAD_ID) -> Column:
    return pad_right(ids, width, value)


def attention(ids: Column, width: Column) -> Column:
    return pad_right(F.transform(ids, lambda _x: F.lit(1)), width, 0)


def repair_logps(logps: Column, ids: Column) -> Column:
    """As many log-probs as ids: missing ones are 0.0 in front, extra ones go."""
    missing = F.greatest(F.size(ids) - F.size(logps), F.lit(0))
    return keep_last(F.concat(F.array_repeat(F.lit(0.0), missing), logps), F.size(ids))


def label_coverage(mask: Column) -> Column:
    """Tokens that carry loss."""
    return total_int(F.transform(mask, lambda m: m.cast("bigint")))

