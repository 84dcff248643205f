"""Blocks of vectors on the shelf."""

import os

import numpy as np

from tests.llm import plain
from turnloom.llm import covertree


def test_blocks_are_not_shuffled_by_pair(spark, monkeypatch):
    """Vectors that nothing prunes: a pair of blocks is two numbers; few blocks held at a time give the same."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist(), i % 2) for i in range(400)]
    rows += [(1000 + i, (np.array(rows[i][1]) * 3 + 0.02 * rng.normal(size=16)).tolist(), i % 2) for i in range(0, 400, 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    for name, value in (("GROUP", 16), ("BLOCK", 8), ("HELD_BYTES", 3000)):
        monkeypatch.setattr(covertree, name, value)
    made, blocks_of = [], covertree._blocks

    def kept(classes):
        made.append(blocks_of(classes))
        return made[-1]

    monkeypatch.setattr(covertree, "_blocks", kept)
    got = sorted(tuple(r) for r in covertree.link(frame).collect())
    assert got == plain.near(rows) and sum(r[1] > 0 for r in got) >= 160
    (blocks, folder), = made
    pairs = covertree._pairs(blocks, covertree.COSINE)
    assert pairs.columns == ["block", "other"] and pairs.count() > blocks.count() > 30
    assert not os.path.exists(folder.removeprefix("file:"))
