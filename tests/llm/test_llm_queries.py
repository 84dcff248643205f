"""The queries over whole small tables, against SQL or brute force."""

from collections import defaultdict
from functools import cache

import duckdb
import pytest

import corpus_pipeline
from tests.compare import difference, duck, rows_of_duck, rows_of_spark
from tests.llm import plain
from turnloom.llm import packing, tokenizing
from turnloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def rows(name, columns):
    return duckdb.connect().sql(f"select {columns} from read_parquet('{SF}/{name}.parquet')").fetchall()


@cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizing.tokenizer_path(tokenizing.TOKENIZER))


def ids_of(text):
    return library().encode(text or "", add_special_tokens=False).ids


def run(spark, name):
    return sorted(tuple(r) for r in QUERIES[name][0](spark, SF).collect())


@pytest.mark.parametrize("name", sorted(n for n, (_q, sql) in QUERIES.items() if sql))
def test_sql(spark, name):
    query, sql = QUERIES[name]
    assert difference(rows_of_spark(query(spark, SF)), rows_of_duck(duck(SF), sql)) is None


def test_token_ids(spark):
    want, start = [], 0
    for doc, text in sorted(rows("documents", "doc_id, text")):
        ids = ids_of(text) + [1]
        want.append((doc, start, len(ids), plain.crc(ids)))
        start += len(ids)
    assert run(spark, "op1_token_ids") == want


def check_packing(got, want, capacity=2048):
    """got: pieces with places; want: {(doc, piece): (start, length, crc)}."""
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark):
    want = {}
    for doc, text in rows("documents", "doc_id, text"):
        ids = ids_of(text) + [0]
        for a in range(0, len(ids), 2048):
            want[(doc, a // 2048)] = (a, len(ids[a : a + 2048]), plain.crc(ids[a : a + 2048]))
    used = check_packing(QUERIES["op2_best_fit_packing"][0](spark, SF).collect(), want)
    assert used <= 1.01 * sum(w[1] for w in want.values()) / 2048 + 1


def test_jaccard(spark):
    assert run(spark, "op3_ngram_jaccard") == plain.jaccard(rows("documents", "doc_id, text"))


def test_captures(spark):
    got = sorted((tuple(r) for r in QUERIES["op9_warc_captures"][0](spark, SF).collect()), key=str)
    assert got == sorted(plain.captures(rows("pages", "page_id, html")), key=str)


def test_near_vectors(spark):
    assert run(spark, "op8_cover_tree") == plain.near(rows("embeddings", "vec_id, embedding, label"))


def test_pipeline_stages(spark):
    """Each stage against brute force on what its predecessor kept."""
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "ngram_jaccard", "pareto_mix", "best_fit_packing"]
    good = {r.doc_id for r in QUERIES["op10_quality_rules"][0](spark, SF).collect() if r.kept}
    first = stages["quality_rules"](spark, docs, SF).cache()
    assert first.columns == names and {r.doc_id for r in first.collect()} == good
    second = stages["ngram_jaccard"](spark, first, SF).cache()
    want = {d for d, _, low in plain.jaccard([(r.doc_id, r.text) for r in first.collect()], percent=80, size=5) if d == low}
    assert second.columns == names and sorted(r.doc_id for r in second.collect()) == sorted(want)
    third = stages["pareto_mix"](spark, second, SF).cache()
    from turnloom.llm import mixing

    taken = {r.doc_id: r.taken for r in mixing.report(second).collect()}
    sizes, copies = defaultdict(int), defaultdict(int)
    for r in third.collect():
        sizes[r.doc_id] += len(plain.words(r.text))
        copies[r.doc_id] += 1
    assert third.columns == names and {d: n for d, n in taken.items() if n} == {d: n for d, n in sizes.items() if n}
    assert max(copies.values()) <= 2
    last = stages["best_fit_packing"](spark, third, SF).collect()
    pieces = defaultdict(int)
    for r in last:
        pieces[r.doc_id, r.piece] += 1
    assert {d: n for (d, k), n in pieces.items() if k == 0} == dict(copies)
    assert packing.CAPACITY == 2048
