"""Encoding by join of distinct words, against the codec and the library text by text."""

import hashlib

import pytest

from tests.test_vocab import library
from turnloom.functions import bpe, joins
from turnloom.operators import vocab, wordcoding
from turnloom.plans import vocabulary
from turnloom.plans.tables import documents

SF = "/root/testdata/sf0.001"
ODD = ["<|im_start|>user\n안녕 세상 it's 42!<|im_end|>\n", "a  b\n\n c\t", "", None, "!<|im_start|><|im_end|>?", "<|im_start", "<think>\n\n</think>x<think", "\u2028 a\u0085b"]


@pytest.fixture(scope="module")
def learned(spark):
    return vocab.learn_vocab(vocab.pretoken_counts(documents(spark, SF)), 1200)


def test_codes_like_the_library(spark, learned):
    docs = [(i, t) for i, t in enumerate([r["text"] for r in documents(spark, SF).select("text").collect()] + ODD)]
    tok = library([t for _, t in docs[: -len(ODD)]], 1200)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "i int, t string, ids string")
    coded = wordcoding.encode_texts(df, ["i"], "t", learned)
    got = {r["i"]: r["ids"] for r in coded.collect()}
    assert got == {i: tok.encode(t or "").ids for i, t in docs}
    counts = {r["i"]: r["n_tokens"] for r in wordcoding.token_counts(df, ["i"], "t", learned).collect()}
    assert counts == {i: len(ids) for i, ids in got.items()}
    back = {r["i"]: bytes(r["bytes"]).decode() for r in wordcoding.decode_texts(coded, ["i"], learned).collect()}
    assert back == {i: t or "" for i, t in docs}


def test_hot_words(spark, learned, monkeypatch):
    """Words that are broadcast and salted get the same ids as those that are shuffled."""
    whole = joins.with_key_stats
    monkeypatch.setattr(wordcoding, "with_key_stats", lambda *a: whole(*a, hot_rows=20))
    docs = [(i, "the the end of the text " * (i % 5)) for i in range(40)]
    codec = bpe.Codec(learned.tokens, learned.merges)
    got = wordcoding.encode_texts(spark.createDataFrame(docs, "i int, t string"), ["i"], "t", learned)
    assert {r["i"]: r["ids"] for r in got.collect()} == {i: codec.encode(t) for i, t in docs}


def test_query_of_learned_arrays(spark, learned, monkeypatch):
    monkeypatch.setattr(vocabulary, "_learned", lambda *_: learned)
    codec = bpe.Codec(learned.tokens, learned.merges)
    want = {}
    for r in documents(spark, SF).collect():
        ids = codec.encode(r["text"])
        want[r["doc_id"]] = (len(ids), hashlib.md5(",".join(map(str, ids)).encode()).hexdigest(), max(0, 512 - 2 - len(ids)))
    got = vocabulary.bpe_pretrain_arrays(spark, SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_md5"], r["n_ignored"]) for r in got} == want


def test_query_of_compression(spark, learned, monkeypatch):
    monkeypatch.setattr(vocabulary, "_learned", lambda *_: learned)
    codec, by = bpe.Codec(learned.tokens, learned.merges), {}
    for r in documents(spark, SF).collect():
        if r["text"]:
            by.setdefault(r["lang"], []).append(len(r["text"]) / len(codec.encode(r["text"])))
    got = {r["lang"]: (r["n_rows"], r["chars_per_token"]) for r in vocabulary.bpe_compression(spark, SF).collect()}
    assert got == {lang: (len(x), pytest.approx(sum(x) / len(x), abs=2e-6)) for lang, x in by.items()}


def test_limit_ships_what_it_needs(spark):
    """The first ids of long texts, from a prefix of them that is cut before Python."""
    from pyspark.sql import functions as F

    texts = [*ODD, "<|im_start|>" * 50, "<|buffer9|>" * 9 + "안" * 500, " \n" * 300 + "x", "<think>" * 4 + "</thi" * 90]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    codec = bpe.Codec(bpe.base_vocab(), [])
    for limit in (1, 5, 40):
        out = df.select("i", bpe.encoder(limit=limit)(F.col("t")).alias("ids"))
        assert {r["i"]: r["ids"] for r in out.collect()} == {i: None if t is None else codec.encode(t, limit) for i, t in enumerate(texts)}
        assert "encode_ids(left(" in out._jdf.queryExecution().analyzed().toString()


def test_texts_are_not_moved_to_encode_them(spark, learned):
    """No word is shuffled; reserved tokens, few kept words and null texts give the codec's ids, and rows that share keys become one."""
    codec = bpe.Codec(learned.tokens, learned.merges)
    docs = [(i, t) for i, t in enumerate([*ODD, "<|buffer3|><think> a<|im_end|>", "a" * 3000, " the the" * 40])]
    df = spark.createDataFrame(docs, "i int, t string").repartition(2)
    coded = wordcoding.encode_texts(df, ["i"], "t", learned)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and plan.count("Exchange") == df._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert {r["i"]: r["ids"] for r in coded.collect()} == {i: codec.encode(t or "") for i, t in docs}
    few = wordcoding._Coder(learned, 2)
    assert [few.ids(w).tolist() for w in ["the", " a", "b", "the", "<think>"]] == [codec.encode(w) for w in ["the", " a", "b", "the", "<think>"]] and len(few.known) <= 2
    twice = spark.createDataFrame([(1, "a the"), (1, "b"), (None, "c"), (None, None)], "i int, t string")
    got = {r["i"]: r["ids"] for r in wordcoding.encode_texts(twice, ["i"], "t", learned).collect()}
    assert got == {1: codec.encode("a") + codec.encode("b") + codec.encode(" the"), None: codec.encode("c")}
    counts = {r["i"]: r["n_tokens"] for r in wordcoding.token_counts(twice, ["i"], "t", learned).collect()}
    assert counts == {i: len(ids) for i, ids in got.items()}
