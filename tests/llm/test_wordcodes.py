"""Encoding by distinct words and decoding by pieces, against the library text by text."""

import hashlib

import pytest

from tests.llm.test_llm_queries import rows, run
from turnloom.llm import wordcodes

ODD = [(None, "a b"), (None, "a b"), (1, None), (2, ""), (3, " \t"), (4, "<|endoftext|>x <|startoftext|> É́ İ ΣΑΣ x　y 12"), (4, "x" * 3000), (5, "<|ENDOFTEXT|> it's 12,5!!")]


def ids_of(text):
    return wordcodes.library().encode(text or "", add_special_tokens=False).ids


def text_of(ids):
    return wordcodes.library().decode(ids, skip_special_tokens=False)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(docs):
    coded = [(d, ids_of(t)) for d, t in docs]
    return sorted(((d, len(ids), sha(" ".join(map(str, ids))), sha(text_of(ids))) for d, ids in coded), key=str)


@pytest.mark.parametrize("chars", [50_000])
def test_query(spark, monkeypatch, chars):
    monkeypatch.setattr(wordcodes, "RUN_CHARS", chars)
    assert sorted(run(spark, "op12_bpe_words"), key=str) == wanted(rows("documents", "doc_id, text"))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(d, t, "z", 1) for d, t in ODD], "doc_id int, text string, ids string, run int").repartition(3)
    assert sorted((tuple(r) for r in wordcodes.round_trip(docs).collect()), key=str) == wanted(ODD)
    coded = wordcodes.encode(docs)
    assert sorted((r.doc_id, r.ids) for r in coded.collect() if r.doc_id is not None) == sorted((d, ids_of(t)) for d, t in ODD if d is not None)
    back = sorted((r.text for r in wordcodes.decode(coded.withColumnRenamed("z", "z")).collect()))
    assert back == sorted(text_of(ids_of(t)) for _, t in ODD)


def test_nothing(spark):
    docs = spark.createDataFrame(ODD, "doc_id int, text string")
    assert wordcodes.round_trip(docs.limit(0)).count() == 0 and wordcodes.decode(wordcodes.encode(docs.limit(0))).count() == 0
    null_ids = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in wordcodes.decode(null_ids).collect()] == ["", ""]


def test_blocks_of_runs(spark, monkeypatch):
    """With more splits than fragments, a fragment's runs are dealt to several groups."""
    monkeypatch.setattr(wordcodes, "FRAGMENTS", 2)
    docs = spark.createDataFrame([(i, f"word{i % 7} and word{i % 5}") for i in range(200)], "doc_id int, text string").repartition(7)
    got = sorted(tuple(r) for r in wordcodes.round_trip(docs).collect())
    assert got == sorted(wanted([(i, f"word{i % 7} and word{i % 5}") for i in range(200)]), key=lambda r: r[0])
