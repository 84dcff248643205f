"""Array expressions: padding, folding, n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.text import let, py_words


def pad_right(ids: Column, width: int | Column, value) -> Column:
    width = width if isinstance(width, Column) else F.lit(width)
    return F.concat(ids, F.array_repeat(F.lit(value), F.greatest(width - F.size(ids), F.lit(0))))


def pad_left(ids: Column, width: int | Column, value) -> Column:
    width = width if isinstance(width, Column) else F.lit(width)
    return F.concat(F.array_repeat(F.lit(value), F.greatest(width - F.size(ids), F.lit(0))), ids)


def keep_last(ids: Column, n: int | Column) -> Column:
    """The last n items, all of them when there are fewer."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.slice(ids, F.greatest(F.size(ids) - n, F.lit(0)) + 1, n)


def drop_end(ids: Column, n: int = 1) -> Column:
    return F.slice(ids, F.lit(1), F.greatest(F.size(ids) - F.lit(n), F.lit(0)))


def drop_start(ids: Column, n: int = 1) -> Column:
    return F.slice(ids, F.lit(n + 1), F.greatest(F.size(ids) - F.lit(n), F.lit(0)))


def total(values: Column) -> Column:
    """Sum of doubles."""
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def total_int(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def masked(values: Column, mask: Column) -> Column:
    return F.zip_with(values, mask, lambda x, m: x * m)


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens, joined by a character no token contains."""

    def build(toks: Column) -> Column:
        length = F.greatest(F.size(toks) - F.lit(n - 1), F.lit(0))
        grams = F.slice(toks, F.lit(1), length)
        for shift in range(1, n):
            grams = F.zip_with(grams, F.slice(toks, F.lit(shift + 1), length), lambda a, b: F.concat(a, F.lit("\u0001"), b))
        return grams

    return let(tokens, build)


def repeat_penalty(text: Column, n: int = 3, cap: float = 0.5) -> Column:
    """Share of repeated n-grams times 2*cap, at most cap; 0 without n-grams."""

    def score(grams: Column) -> Column:
        count = F.size(grams).cast("double")
        extra = count - F.size(F.array_distinct(grams))
        return F.when(count > 0, F.least(F.lit(cap), extra * F.lit(cap * 2) / count)).otherwise(F.lit(0.0))

    return let(ngrams(py_words(text), n), score)
