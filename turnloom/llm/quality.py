"""Quality rules: a table of thresholds compiled into one projection of ratios.

Everything is built-in Spark expressions inside the row: no shuffle, no Python.
Words are runs of anything but white space (space and characters 9 to 13).

* A null, empty or blank text has no words; all its counts are 0 and it fails.
* A ratio whose denominator is 0 passes; the word minimum rejects such texts.
* Other columns pass through untouched, also when they are named like a count.
* Repeated rows are judged alike, each on its own; an empty table stays empty.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import let
from turnloom.llm.common import SPACE_RUN

SYMBOLS = r"[#*$%&|<>]"
# Very common words of four languages.
STOP_WORDS = (
    "the of and to a in is it that for on with as was be by at are this from or an "
    "le la les de des du et un une est que qui dans pour sur par au pas avec elle "
    "der die das und ist ein eine den von zu mit sich auf für nicht im dem "
    "el los las y en con para del se no lo su por es como"
).split()


@dataclass(frozen=True)
class Threshold:
    """Keep when low <= 100 * part / whole <= high, in whole numbers; None: no bound."""

    part: str
    whole: str | None
    low: int | None = None
    high: int | None = None


MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BASE = (
    Threshold("n_words", None, low=MIN_WORDS),
    Threshold("n_repeat_words", "n_words", high=MAX_REPEAT_PERCENT),
)
RULES = (
    Threshold("word_chars", "n_words", low=200, high=1500),
    Threshold("n_symbols", "n_words", high=10),
    Threshold("n_stop_words", "n_words", low=1),
    Threshold("n_dup_lines", "n_lines", high=50),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != F.lit(""))


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that stand in the text at least twice.

    Most texts repeat no window.  They are told by hashes alone, as different
    hashes cannot belong to equal windows; the others compare the windows.
    """

    def word(i: Column) -> Column:
        return F.get(words, i)

    def covered(n: Column) -> Column:
        starts = F.sequence(F.lit(0), n - 3)
        windows = F.sort_array(
            F.transform(starts, lambda i: F.struct(F.concat_ws(" ", word(i), word(i + 1), word(i + 2)).alias("w"), i.alias("i")))
        )

        def spans(sorted_windows: Column) -> Column:
            def twin(x: Column, k: Column) -> Column:
                before = F.get(sorted_windows, k - 1)["w"] == x["w"]
                after = F.get(sorted_windows, k + 1)["w"] == x["w"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            at = F.sort_array(F.transform(F.filter(sorted_windows, twin), lambda x: x["i"]))
            return let(at, lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
                F.lit(0).cast("bigint"),
                lambda total, x: total + x,
            ))

        hashes = F.transform(starts, lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))
        return F.when(F.size(F.array_distinct(hashes)) == n - 2, F.lit(0).cast("bigint")).otherwise(let(windows, spans))

    return let(F.size(words), lambda n: F.when(n < 3, F.lit(0).cast("bigint")).otherwise(covered(n)))


def measures(text: Column) -> Column:
    """The struct of counts that thresholds name."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of(words: Column) -> Column:
        line_counts = let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("unlike")))
        return let(line_counts, lambda line: F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            (line["all"] - line["unlike"]).cast("bigint").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            line["all"].cast("bigint").alias("n_lines"),
            F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        ))

    return let(words_of(text), of)


def compiled(rules: tuple[Threshold, ...], m: Column) -> Column:
    """One condition for a table of thresholds: true when all of them hold."""

    def holds(rule: Threshold) -> Column:
        part = m[rule.part] if rule.whole is None else m[rule.part] * 100
        whole = F.lit(1) if rule.whole is None else m[rule.whole]
        bounds = [part >= whole * rule.low] if rule.low is not None else []
        bounds += [part <= whole * rule.high] if rule.high is not None else []
        return reduce(and_, bounds, F.lit(True))

    return reduce(and_, map(holds, rules), F.lit(True))


def judge(docs: DataFrame, text: str = "text", rules: tuple[Threshold, ...] = RULES, base: tuple[Threshold, ...] = BASE) -> DataFrame:
    """Adds ``_quality``: the counts, ``base_failed`` and ``kept``.

    The struct is generated, not projected, so that a later filter cannot make
    Spark compute it a second time.
    """
    measured = docs.withColumn("_measures", F.explode(F.array(measures(F.col(text)))))
    failed = ~compiled(base, F.col("_measures"))
    verdict = F.struct("_measures.*", failed.alias("base_failed"), (~failed & compiled(rules, F.col("_measures"))).alias("kept"))
    return measured.withColumn("_quality", verdict).drop("_measures")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass, with their own columns only."""
    return judge(docs, text).where(F.col("_quality.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document."""
    judged = judge(docs.select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[F.col(f"_quality.{n}").alias(n) for n in names])


_STOP_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    len(ls) AS n_lines, len(list_filter(ws, lambda x: x IN ({_STOP_LIST}))) AS n_stop
    FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words AND 100 * n_symbols <= 10 * n_words
    AND 100 * n_stop >= n_words AND 100 * n_dup_lines <= 50 * n_lines AS kept FROM b
"""
