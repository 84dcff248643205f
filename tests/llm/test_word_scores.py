"""Cross-entropy difference under word bigrams, against plain counts."""

import random
from collections import Counter
from math import log

import pytest

from tests.llm import plain
from turnloom.llm import wordscores
from turnloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def expected(docs, good):
    """docs: (doc_id, text); good: ids of targets.  Rows (doc_id, n, target, background)."""
    split = [(d, [*plain.words(plain.lowered(t)), None]) for d, t in docs if plain.words(t)]
    vocabulary = len({w for _, ws in split for w in ws})
    k = wordscores.STRENGTH

    def model(rows, scale):
        one, two, before = Counter(), Counter(), Counter()
        for _, ws in rows:
            for v, w in zip(["\0", *ws], ws):
                one[w] += scale
                two[v, w] += scale
                before[v] += scale
        total = sum(one.values())
        return lambda v, w: log((two[v, w] + k * (one[w] + 1) / (total + vocabulary)) / (before[v] + k))

    chosen = [x for x in split if x[0] in good]
    n, t = (sum(len(ws) for _, ws in rows) for rows in (split, chosen))
    models = model(chosen, 1), model(split, t / n if t and n else 1)
    out = [(d, 0, None, None) for d, t in docs if not plain.words(t)]
    return out + [(d, len(ws), *(-sum(m(v, w) for v, w in zip(["\0", *ws], ws)) / len(ws) for m in models)) for d, ws in split]


@pytest.mark.parametrize("share", [1, 30, 1024])  # no hot words but the end mark; some; nearly all
def test_word_scores_are_the_model(spark, monkeypatch, share):
    monkeypatch.setattr(wordscores, "HOT_SHARE", share)
    monkeypatch.setattr(wordscores, "CHARS", 500)
    rng = random.Random(6)
    names = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choice(names[: rng.choice([3, 10, 60])]) for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, " \n"), (None, "w1 w2"), (None, None), (5, "W1 w2"), (5, "W1 w2"), (103, "only")]
    good = {i for i in range(0, 60, 3)}
    labels = spark.createDataFrame([(i, 1, 0) for i in good] + [(1, 1, 0), (1, 0, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for marks, ids in ((labels, good), (labels.limit(0), set())):
        got = sorted(wordscores.score(frame, marks).collect(), key=str)
        want = sorted(expected(docs, ids), key=lambda r: f"Row(doc_id={r[0]}, n_tokens={r[1]}, ce_target={r[2]}")
        assert len(got) == len(want)
        key = lambda r: (str(r[0]), r[1], r[2] or 0)
        for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
            assert g[:2] == w[:2] and g[2:4] == (pytest.approx(w[2:], rel=1e-5) if w[1] else (None, None))
            assert g[4] == (pytest.approx(w[2] - w[3], abs=1e-5) if w[1] else None)
    assert wordscores.score(frame.limit(0), labels).collect() == []


def test_query_tells_word_order(spark):
    """Tokens are words, and held-out labels are told apart."""
    from turnloom.llm.common import table

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = {r.doc_id: r.n_tokens for r in QUERIES["op4_cross_entropy_difference"][0](spark, SF).collect()}
    assert got == {r.doc_id: len(plain.words(r.text)) + bool(plain.words(r.text)) for r in docs.collect()}
    held = "pmod(doc_id, 5) = 0"
    pairs = wordscores.score(docs, labels.where(f"NOT {held}")).join(labels.where(held), "doc_id").where("score IS NOT NULL").select("score", "quality").collect()
    good, bad = [s for s, q in pairs if q == 1], [s for s, q in pairs if q == 0]
    auc = sum((g < b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    print("auc", auc)
    assert auc > 0.8
