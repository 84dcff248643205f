"""URL filters: rules first, then a classifier over words segmented from the URL.

A URL is cut into pieces (runs of letters or of digits in host and path).  A
letter piece may be several words written together; a unigram model of the words
in the pages' texts finds the most probable split (Viterbi).  Multinomial naive
Bayes, trained on the URLs that a rule decides, scores the words of the others.

The model of words is never moved whole: the substrings of the distinct pieces
meet the word counts in a join, and only hits go to the splitting.  Words of more
than ``ANCHOR`` letters, of any length, are found by their first ones and then
compared whole, so a piece makes a bounded number of substrings per letter.  Scores are
whole numbers (log odds times 1e9), so sums don't depend on their order.

* A null URL or one without ``://`` has an empty host and path and no rule; its
  verdict is that of the class prior.
* A score of 0 or more allows.  Without labelled URLs everything scores 0.
* Rows that share a URL get the same verdict; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.session import cut_lineage

ANCHOR = 24
SMALL_PIECES = 100_000
_UNIT = 1e9


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains when the path starts as given."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def _first_rule(rules: tuple[Rule, ...], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of its text and verdict."""
    fits = [
        F.when(
            ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path)),
            F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict")),
        )
        for rule in sorted(rules, key=lambda r: -len(r.text))
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<text: string, verdict: string>"))


def pieces_of(host: Column, path: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.concat(host, F.lit("/"), path)), F.lit(r"([\p{L}\p{M}]+|\p{Nd}+)"), F.lit(1))


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) over the visible texts of all pages."""
    shown = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    words = F.regexp_extract_all(F.lower(F.coalesce(shown, F.lit(""))), F.lit(r"([\p{L}\p{M}]+)"), F.lit(1))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def split_words(piece: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable words of a piece; ``known`` has counts by (start, end).

    An unknown run, of any length, is ten times less probable with each letter.  Of
    equal splits the one whose last word starts first is taken.  The best start of
    an unknown run is the same for all its ends, so it is kept while the ends go by.
    """
    ending: dict[int, list[tuple[int, int]]] = {}
    for (start, end), n in sorted(known.items()):
        ending.setdefault(end, []).append((start, n))
    letter, unknown = log(10), log((total + 10) / 10)
    best, came = [0.0] * (len(piece) + 1), [0] * (len(piece) + 1)
    run_from, run_cost = 0, 0.0  # cost before the run, less a letter's cost for each letter before it
    for end in range(1, len(piece) + 1):
        if best[end - 1] - (end - 1) * letter < run_cost:
            run_from, run_cost = end - 1, best[end - 1] - (end - 1) * letter
        ways = [(best[start] - log(n / total), start) for start, n in ending.get(end, [])]
        best[end], came[end] = min([(run_cost + end * letter + unknown, run_from), *ways])
    words, end = [], len(piece)
    while end:
        words.append(piece[came[end] : end])
        end = came[end]
    return words[::-1]


def segmented(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """(piece, word) with one row per word of each distinct piece; digits stay whole."""
    counts, _ = cut_lineage(counts, "url-words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    letters = pieces.where(F.col("piece").rlike(r"^[^\d]"))
    spans = letters.select("piece", F.posexplode(F.split("piece", "")).alias("start", "_c")).where("_c <> ''")
    ends = F.sequence(F.col("start") + 1, F.least(F.col("start") + ANCHOR, F.length("piece")))
    spans = spans.select("piece", "start", F.explode(ends).alias("end"))
    spans = spans.withColumn("word", F.substring("piece", F.col("start") + 1, F.col("end") - F.col("start")))
    short = spans.join(counts.where(F.length("word") <= ANCHOR), "word")
    heads = counts.where(F.length("word") > ANCHOR).select(F.substring("word", 1, ANCHOR).alias("word"), F.col("word").alias("_whole"), "n")
    long = spans.where(F.col("end") - F.col("start") == ANCHOR).join(heads, "word")
    long = long.where(F.substring("piece", F.col("start") + 1, F.length("_whole")) == F.col("_whole"))
    long = long.withColumn("end", F.col("start") + F.length("_whole"))
    found = short.select("piece", "start", "end", "n").unionByName(long.select("piece", "start", "end", "n"))
    hits = found.groupBy("piece").agg(F.collect_list(F.struct("start", "end", "n")).alias("known"))
    rows = pieces.join(hits, "piece", "left").crossJoin(F.broadcast(total))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for piece, known, total in zip(batch["piece"], batch["known"], batch["total"]):
                table = {} if known is None else {(k["start"], k["end"]): k["n"] for k in known}
                words = [piece] if piece[:1].isdecimal() else split_words(piece, table, max(1, int(total)))
                out += [(piece, w) for w in words]
            yield pd.DataFrame(out, columns=["piece", "word"])

    return rows.mapInPandas(split, "piece string, word string")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; score is null where a rule decides."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", _first_rule(rules, F.col("host"), F.col("path")))
    urls = rows.groupBy("host", "path").agg(F.count("*").alias("rows"), F.first("_rule").alias("_rule"))
    urls = urls.withColumn("allow", F.when(F.col("_rule.verdict") == "allow", F.col("rows")).otherwise(0))
    urls = urls.withColumn("block", F.when(F.col("_rule.verdict") == "block", F.col("rows")).otherwise(0))
    urls, _ = cut_lineage(urls.select("host", "path", F.col("_rule").isNull().alias("open"), "allow", "block"), "urls")

    exploded = urls.select("host", "path", "open", "allow", "block", F.explode(pieces_of(F.col("host"), F.col("path"))).alias("piece"))
    per_piece = exploded.groupBy("piece").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    per_piece, _ = cut_lineage(per_piece, "url-pieces")
    words, _ = cut_lineage(segmented(per_piece.select("piece"), word_counts(pages)), "piece-words")
    per_word = words.join(per_piece, "piece").groupBy("word").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    sums = per_word.agg(F.coalesce(F.sum("allow"), F.lit(0)).alias("_a"), F.coalesce(F.sum("block"), F.lit(0)).alias("_b"), F.count("*").alias("_v"))
    odds = F.log((F.col("allow") + 1) / (F.col("_a") + F.col("_v"))) - F.log((F.col("block") + 1) / (F.col("_b") + F.col("_v")))
    weights = per_word.crossJoin(F.broadcast(sums)).select("word", F.round(odds * _UNIT).cast("bigint").alias("w"))
    weighed = words.join(weights, "word").groupBy("piece").agg(F.sum("w").alias("w"))
    weighed, _ = cut_lineage(weighed, "piece-weights")
    if weighed.count() <= SMALL_PIECES:
        weighed = F.broadcast(weighed)

    prior = urls.agg(F.coalesce(F.sum("allow"), F.lit(0)).alias("_a"), F.coalesce(F.sum("block"), F.lit(0)).alias("_b"))
    prior = prior.select(F.round((F.log(F.col("_a") + 1) - F.log(F.col("_b") + 1)) * _UNIT).cast("bigint").alias("_prior"))
    scores = exploded.where("open").join(weighed, "piece").groupBy("host", "path").agg(F.sum("w").alias("_score"))
    scored = rows.where("_rule IS NULL").join(scores, ["host", "path"], "left").crossJoin(F.broadcast(prior))
    score = F.coalesce("_score", F.lit(0)) + F.coalesce("_prior", F.lit(0))
    open_rows = scored.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.when(score >= 0, "allow").otherwise("block").alias("verdict"), (score / F.lit(_UNIT)).alias("score"))
    ruled = rows.where("_rule IS NOT NULL").select("page_id", "host", "path", F.col("_rule.text").alias("rule"), F.col("_rule.verdict").alias("verdict"), F.lit(None).cast("double").alias("score"))
    return ruled.unionByName(open_rows)
