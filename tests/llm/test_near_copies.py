"""The pipeline's near-copy stage."""

import random

import corpus_pipeline
from tests.llm import plain

STAGE = dict(corpus_pipeline.STAGES)["ngram_jaccard"]


def shingles(text, size=5):
    w = plain.words(plain.lowered(text))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def kept_ids(docs, percent=80):
    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if (both := len(sets[a] & sets[b])) and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)
    ]
    low = plain.components(ids, links)
    return sorted(d for d in ids if low[d] == d)


def test_stage_links_five_words_and_eighty_percent(spark):
    rng = random.Random(11)
    words = [f"v{i}" for i in range(4000)]
    docs = []
    for g in range(6):
        base = [rng.choice(words) for _ in range(500)]
        for k, changes in enumerate((0, 10, 14, 40)):
            w = list(base)
            for i in range(changes):
                w[(i + 1) * 500 // (changes + 1)] = rng.choice(words)
            docs.append((10 * g + k, " ".join(w)))
    docs += [(1000, None), (1001, ""), (1002, "one"), (1003, "ONE"), (1004, "a b c d"), (1005, "a b c d e")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = kept_ids(docs)
    assert 1 not in want and 3 in want
    assert sorted(r.doc_id for r in STAGE(spark, frame, "").collect()) == want


def test_null_and_shared_ids(spark):
    rng = random.Random(12)
    one, two, three, four = (" ".join(rng.choices([f"v{i}" for i in range(900)], k=80)) for _ in range(4))
    docs = [
        (None, one), (None, one + " end"),  # a group without ids: one of the two
        (None, two), (3, two + " end"),  # the id stands for the null
        (None, "unique among all"), (None, None), (None, ""), (None, " "), (4, None),
        (7, two), (7, three),  # shared id: the near copy of 3 goes, the other stays
        (8, four), (8, four),  # repeats stay
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in STAGE(spark, frame, "").collect()), key=str)
    ends = [(d, t) for d, t in got if t in (one, one + " end")]
    assert len(ends) == 1
    want = [*ends, (3, two + " end"), (None, "unique among all"), (None, None), (None, ""), (None, " "), (4, None), (7, three), (8, four), (8, four)]
    assert got == sorted(want, key=str)
