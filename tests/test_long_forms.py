"""Long trajectories, dense batches, stored training sets and the tokenizer file, each against plain Python."""

import random
import struct

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from turnloom.functions import bpe
from turnloom.operators import chat, diagnostics, tokens, vocab
from turnloom.plans import stages
from turnloom.plans import tables as t

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("gamma, lam, width", [(1.0, 0.95, 7), (1.0, 1.0, 3), (0.9, 0.0, 5), (0.5, 0.5, 4), (1e-20, 1.0, 4)])
def test_long_advantages(spark, gamma, lam, width):
    rng = random.Random(5)
    steps, want = [], {}
    for key, n in (("a", 1), ("b", 7), ("c", 8), ("d", 120), ("e", 3)):
        value, reward = [rng.uniform(-2, 2) for _ in range(n)], [rng.choice([0.0, 0.0, 1.0]) for _ in range(n)]
        tail = 0.0
        for k in reversed(range(n)):
            tail = reward[k] + gamma * (value[k + 1] if k + 1 < n else 0.0) - value[k] + gamma * lam * tail
            want[key, k] = (tail, tail + value[k])
        steps += [(key, k, value[k], reward[k]) for k in range(n)]
    rng.shuffle(steps)
    frame = spark.createDataFrame(steps, "id string, pos int, value double, reward double")
    got = {(r[0], r[1]): tuple(r)[2:] for r in diagnostics.long_advantages(frame, "id", gamma, lam, width).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert diagnostics.long_advantages(frame.limit(0), "id", gamma, lam, width).collect() == []


def test_dense_batches(spark):
    rows = [(0, 2, [1, 70000]), (0, 0, list(range(9))), (0, 1, []), (1, 5, [5] * 8), (2, 0, None)]
    out = tokens.dense_batches(spark.createDataFrame(rows, "b int, pos int, ids array<int>"), "ids", "b", "pos")
    got = {r.b: r for r in out.collect()}
    assert struct.unpack("<27i", got[0].ids) == (*range(9), *[0] * 9, 1, 70000, *[0] * 7)
    assert list(got[0].mask) == [255, 1, 0, 0, 3, 0] and (got[0].n_rows, got[0].width) == (3, 9)
    assert list(got[1].mask) == [255] and struct.unpack("<8i", got[1].ids) == (5,) * 8
    assert (got[2].n_rows, got[2].width, bytes(got[2].ids), bytes(got[2].mask)) == (1, 0, b"", b"")


def test_training_set_is_what_was_made(spark, tmp_path):
    parts = chat.assemble_parts(t.conversations(spark, SF))
    chats = parts.select("conv_id", F.col("messages").alias("conversations"))
    rows = stages.training_rows(chats, "conv_id", 64, 2, epochs=2, world=2)
    path = str(tmp_path / "set")
    stages.write_training_set(rows, path)
    want = sorted(tuple(r) for r in rows.collect())
    for rank in (0, 1):
        back = stages.read_training_set(spark, path, rank, epoch=0, from_batch=3).select(*rows.columns)
        assert sorted(tuple(r) for r in back.collect()) == [w for w in want if w[1] == rank and (w[0] > 0 or w[2] >= 3)]
    last = stages.read_training_set(spark, path, 0, epoch=1)
    assert {r.epoch for r in last.select("epoch").collect()} == {1}
    plan = last._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(batch_id,0)" in plan
    with pytest.raises(Exception, match="(?i)exists"):
        stages.write_training_set(rows, path)


def test_repeated_lines_keep_their_numbers(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    lines = [("a",)] * 50 + [("b",)] * 3 + [("c",)]
    path = stages.jsonl.stage_path(root, "sft")
    spark.createDataFrame(lines, "value string").write.text(path)
    samples = []
    for repeats in (1 << 16, 7):
        monkeypatch.setattr(stages, "REPEATS", repeats)
        assert stages.rlaif(spark, root, n=20, force=True) == {"accepted": 20}
        samples.append(sorted(r.value for r in spark.read.text(stages.jsonl.stage_path(root, "rlaif")).collect()))
    assert samples[0] == samples[1]


def test_a_library_loads_the_tokenizer_file(spark):
    texts = [r.text for r in t.documents(spark, SF).select("text").limit(30).collect()]
    words = vocab.pretoken_counts(t.documents(spark, SF))
    learned = vocab.learn_vocab(words, 420)
    loaded = Tokenizer.from_str(vocab.export_row(spark, learned).first()[0])
    codec = bpe.Codec(learned.tokens, learned.merges)
    assert loaded.get_vocab_size() == len(learned.tokens)
    for text in [*texts, "<|im_start|>user\nhi<|im_end|> <think>x", "  two  spaces", "naïve 漢字 🎉"]:
        ids = loaded.encode(text, add_special_tokens=False).ids
        assert ids == list(codec.encode(text))
        assert loaded.decode(ids, skip_special_tokens=False) == text


def test_steps_go_as_lists(spark):
    """Neighbouring steps of a chunk are one row before any shuffle; repeated, null and shuffled steps, null numbers and small tables give what rows gave."""
    rng = random.Random(7)
    plain = [("a", k, float(k % 5), 0.5) for k in range(70)] + [(None, k, 1.0, 0.0) for k in range(9)]
    packs = diagnostics._packed_steps(spark.createDataFrame(plain, "id string, pos int, value double, reward double").coalesce(1), "id", 8).collect()
    assert [(r["id"], r["_chunk"], r["at"]) for r in packs[:2]] == [("a", 0, list(range(9))), ("a", 1, list(range(9)))] and len(packs) == 11
    rows = [(i, k, rng.choice([None, 0.5, 2.0, -1.0]), rng.choice([0.0, 1.0, None])) for i in range(6) for k in range(40)]
    tail, want = {}, {}
    for i, k, v, r in reversed(rows):
        ahead = 0.0 if k == 39 else next(x[2] for x in rows if x[:2] == (i, k + 1))
        x = None if None in (ahead, v, r) else r + ahead - v
        tail[i] = x if tail.get(i) is None else 0.95 * tail[i] + (x or 0.0)
        want[i, k] = tail[i], v
    rng.shuffle(rows)
    frame = spark.createDataFrame([*rows, (3, None, 1.0, 1.0)], "id long, pos int, value double, reward double").repartition(3)
    got = diagnostics.long_advantages(frame, "id", width=64).collect()
    assert len(got) == len(rows) and all(type(r["pos"]) is int for r in got)
    for r in got:
        adv, v = want[r["id"], r["pos"]]
        assert r["advantage"] == (None if adv is None else pytest.approx(adv, abs=1e-9))
        assert r["return"] == (None if None in (adv, v) else pytest.approx(adv + v, abs=1e-9))
    twice = diagnostics.long_advantages(spark.createDataFrame(plain[:3] * 2, "id string, pos int, value double, reward double"), "id", width=2)
    # Both first steps of the second chunk come after each of the first chunk's steps.
    got = twice.collect()
    assert sorted(r["pos"] for r in got) == [0] * 4 + [1] * 4 + [2] * 2
    # Values 0, 1, 2 and rewards of 0.5: of the last step's rows the first sees the second's value, and is summed first.
    assert sorted(r["advantage"] for r in got if r["pos"] == 2) == [pytest.approx(-1.0), pytest.approx(0.5)]
