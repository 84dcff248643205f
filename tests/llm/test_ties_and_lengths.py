"""Rows that share all their keys, and words of any length."""

from collections import Counter
from math import log

import numpy as np
import pytest

from tests.llm import plain
from turnloom.llm import mixing, packing, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("splits", [1, 7])
def test_equal_rows_meet_the_target(spark, splits):
    docs = [(None, "a b c d e", None, "x", k) for k in range(1000)] + [(k, "w " * 20, None, "y", k) for k in range(500)]
    docs += [(7, "one two three", None, None, 0)] * 300 + [(None, None, None, "x", 0)] * 40
    frame = spark.createDataFrame(docs, DOCS).repartition(splits)
    rows = mixing.copies(frame).select("source", "_mix.*").collect()
    assert len(rows) == len(docs)
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source] += r.size * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 2
    assert all(abs(taken[s] - target[s]) <= size / 2 + 1e-6 for s, size in (("x", 5), ("y", 20), (None, 3)))
    assert mixing.copies(frame).groupBy("source").sum("_mix.copies").collect() == mixing.copies(frame).groupBy("source").sum("_mix.copies").collect()


def test_rows_without_ids_are_dealt_evenly(spark):
    rows = [(None, 0, 0, 1 + k % 50, 9) for k in range(4000)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    out = packing.pack(pieces, 100, group_pieces=500).toPandas()
    groups = Counter(int(s) >> 32 for s in out["sequence_id"])
    assert len(groups) == 8 and max(groups.values()) < 650
    assert out.groupby("sequence_id")["length"].sum().max() <= 100 and len(out) == 4000


def test_long_words_are_found_whole(spark):
    longest = "donaudampfschifffahrtsgesellschaft"
    other = longest[:26] + "xyz"
    counts = spark.createDataFrame([(longest, 4), (other, 1), ("die", 30), ("a" * 5000, 2), ("der", 30)], "word string, n long")
    texts = ["die" + longest, longest + "der" + other, "a" * 5003, longest[:30], "der2", "7"]
    got = {}
    for piece, word in urls.segmented(spark.createDataFrame([(t,) for t in texts], "piece string"), counts).collect():
        got.setdefault(piece, []).append(word)
    assert got["die" + longest] == ["die", longest]
    assert got[longest + "der" + other] == [longest, "der", other]
    assert sorted(map(len, got["a" * 5003])) == [3, 5000]
    assert got[longest[:30]] == [longest[:30]]
    assert got["7"] == ["7"]


def test_splits_of_random_pieces():
    rng = np.random.default_rng(3)
    counts = {"".join(rng.choice(list("ab"), rng.integers(1, 6))): int(rng.integers(1, 40)) for _ in range(14)}
    total = sum(counts.values())

    def cost(words):
        return -sum(log(counts[w] / total) if w in counts else log(10 / (total + 10)) - len(w) * log(10) for w in words)

    for _ in range(60):
        piece = "".join(rng.choice(list("abc"), rng.integers(1, 12)))
        known = {(i, j): counts[piece[i:j]] for i in range(len(piece)) for j in range(i + 1, len(piece) + 1) if piece[i:j] in counts}
        got = urls.split_words(piece, known, total)
        assert "".join(got) == piece
        assert cost(got) == pytest.approx(plain.best_split(piece, counts, total, len(piece))[0])


def test_pages_count_words_of_any_length(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "<p>" + "x" * 40 + " y</p>")], "page_id long, url string, html string")
    assert {r.word: r.n for r in urls.word_counts(pages).collect()} == {"x" * 40: 1, "y": 1}
