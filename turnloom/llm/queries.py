"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnloom.llm import alignment, covertree, dac, html, jaccard, lexical, mixing, packing, quality, urls, warc, wordcodes, wordscores
from turnloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


QUERIES: dict[str, tuple[Query, str | None]] = {
    "op1_token_ids": (over("documents", dac.round_trip), None),
    "op2_best_fit_packing": (over("documents", packing.pack_documents), None),
    "op3_ngram_jaccard": (over("documents", jaccard.link), None),
    "op4_cross_entropy_difference": (lambda spark, sf_dir: wordscores.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")), None),
    "op5_pareto_mix": (over("documents", mixing.report), mixing.SQL),
    "op6_min_cut_text": (over("pages", html.extract), None),
    "op7_url_filter": (over("pages", lambda pages: urls.judge(pages).drop("score")), None),
    "op8_cover_tree": (over("embeddings", covertree.link), None),
    "op9_warc_captures": (over("pages", warc.round_trip), None),
    "op10_quality_rules": (over("documents", quality.report), quality.SQL),
    "op11_lexical_rank": (lambda spark, sf_dir: lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")), lexical.SQL),
    "op12_bpe_words": (over("documents", wordcodes.round_trip), None),
    "op13_token_alignment": (over("documents", alignment.align), None),
}
