"""Text expressions with the semantics of Python's str, on native Spark functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.constants import ANSWER_PATTERN

# Character classes for Java patterns: what Python calls \s and \w.
WS = r"\p{Z}\x09-\x0d\x1c-\x1f\x85"
WORD = r"\p{L}\p{N}_"
WS_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once for use several times in an expression.

    A lambda variable is computed once per row; a plain column expression used
    inside another lambda would be computed once per element.
    """
    return F.transform(F.array(value), body).getItem(0)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row, however often it is used.

    A filter on a projected column is pushed below the projection and would
    compute the value a second time; a generated column it cannot pass.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def py_strip(c: Column) -> Column:
    """str.strip().  Most texts have clean ends, and then nothing is scanned."""
    edges = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    clean = F.translate(edges, WS_CHARS, "") == edges
    return F.when(clean, c).otherwise(F.btrim(c, F.lit(WS_CHARS)))


def truthy(c: Column) -> Column:
    """Null for a missing or empty string."""
    return F.nullif(c, F.lit(""))


def count_of(c: Column, needle: str) -> Column:
    """Occurrences of a literal, not overlapping."""
    return F.floor((F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))) / F.lit(len(needle))).cast("int")


def before_first(c: Column, tag: str) -> Column:
    return F.substring_index(c, tag, 1)


def after_first(c: Column, tag: str) -> Column:
    """What follows the first tag; the whole text when there is none."""
    at = F.instr(c, tag)
    return F.when(at > 0, F.substring(c, at + F.lit(len(tag)), F.length(c))).otherwise(c)


def after_last(c: Column, tag: str) -> Column:
    return F.substring_index(c, tag, -1)


def py_words(c: Column) -> Column:
    """Lower-case word tokens and single punctuation marks."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"([{WORD}]+|[^{WORD}{WS}])"), F.lit(1))


def split_words(c: Column) -> Column:
    """str.split(): runs of anything but white space."""
    return F.regexp_extract_all(c, F.lit(f"([^{WS}]+)"), F.lit(1))


def last_number(c: Column) -> Column:
    """The last numeric literal with commas removed, '' when there is none."""
    found = F.regexp_extract_all(c, F.lit(ANSWER_PATTERN), F.lit(1))
    return F.coalesce(F.replace(F.try_element_at(found, F.lit(-1)), F.lit(","), F.lit("")), F.lit(""))


def lone_numbers(c: Column) -> Column:
    """Numbers that stand alone (no letter, digit or full stop next to them)."""
    bare = F.replace(c, F.lit(","), F.lit(""))
    pattern = rf"(?<![{WORD}.])([-+]?\p{{Nd}}+(?:\.\p{{Nd}}+)?)(?![{WORD}.])"
    return F.transform(F.regexp_extract_all(bare, F.lit(pattern), F.lit(1)), lambda x: x.try_cast("double"))
