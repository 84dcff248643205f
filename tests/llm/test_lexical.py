"""Ranked search against plain Python; the query over the tables is held against its SQL."""

from collections import Counter
from math import floor, log
import re

import numpy as np
import pytest

from turnloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = [
    (None, "a b"), (None, "a b"), (1, None), (2, ""), (3, " \t-"), (4, "É́ İ ΣΑΣ x　y 12 <0x41> Ab aB"), (5, "b " * 4500), (5, "b c"), (7, "c_d-e"), (6, "c c d"),
    *[(100 + i, "the same words of a large group of copies") for i in range(40)],
    *[(200 + i, "the " * (1 + i % 7) + f"word{i % 5} word{i % 3} copies") for i in range(40)],
]
ITEMS = [(1, "a b c"), (1, "AB é"), (None, None), (3, "zzz"), (4, ""), (5, "the copies of the group"), (6, "word1 word2 the"), (None, "c d")]


def found(text):
    return [t.translate({i: i + 32 for i in range(65, 91)}) for t in TERM.findall(text or "")]


def plain(docs, items, top=10):
    tf = [Counter(found(t)) for _, t in docs]
    size = [sum(c.values()) for c in tf]
    n_docs, n_terms = sum(n > 0 for n in size), sum(size)
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, _), own, n in zip(docs, tf, size):
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * own[t] // (1000 * own[t] + 8 * m)) for t in set(found(text)) & own.keys())
            if score:
                scores.append((-score, doc is None, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [4096, 8])
def test_ranks(spark, monkeypatch, block):
    """Nulls, repeated rows, ties over many blocks, clashing columns; blocks of any size."""
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    docs = spark.createDataFrame([(d, t, "x") for d, t in DOCS], "doc_id int, text string, item_id string").repartition(3)
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id int, text string, score int")
    got = sorted((tuple(r) for r in lexical.rank(docs, items).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == plain(DOCS, ITEMS)


def test_empty(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id int, text string"), spark.createDataFrame(ITEMS, "item_id int, text string")
    assert lexical.rank(docs.limit(0), items).count() == 0 and lexical.rank(docs, items.limit(0)).count() == 0


def test_bounds_hold():
    """No bound is below the exact score, and most documents without a term have none."""
    rng = np.random.default_rng(5)
    block = lexical._Block(512, 4096)
    texts = [[f"w{x}".encode() for x in rng.zipf(1.3, rng.integers(1, 40)) % 300] for _ in range(200)]
    for i, t in enumerate(texts):
        block.add(i, t, 1)
    import pandas as pd

    row = next(pd.DataFrame([block.row()], columns=[c.split()[0] for c in lexical._INDEX.split(", ")]).itertuples())
    stats = lexical.Statistics(200, sum(map(len, texts)))
    held = lexical.Candidates(row, stats).exact()
    keys = np.sort(rng.choice(held.keys, 50, replace=False))
    weights = rng.integers(1, 9000, 50)
    bounds = held.bounds(keys, weights)
    at = lexical._found(held.keys, keys)
    loose = 0
    for d in range(200):
        for k in range(50):
            exact = held.score(d, at[k : k + 1], weights[k : k + 1])
            assert bounds[k, d] >= exact
            loose += bool(bounds[k, d]) and not exact
    assert loose < 0.05 * 200 * 50
