"""Advantages, masks, losses, packing against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnloom.operators import diagnostics, rewards, tokens, trajectories


def test_advantages_like_a_loop(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(n)], [rng.uniform(-1, 1) for _ in range(n)]) for i, n in enumerate([0, 1, 5, 700, 2000])]
    df = spark.createDataFrame(rows, "i int, v array<double>, r array<double>")
    for gamma, lam in ((1.0, 0.95), (0.9, 0.5), (1.0, 1.0), (0.5, 0.0)):
        got = {r["i"]: r["a"] for r in df.select("i", diagnostics.advantage_estimator(gamma, lam)(F.col("v"), F.col("r")).alias("a")).collect()}
        for i, v, r in rows:
            want, last = [0.0] * len(v), 0.0
            for k in reversed(range(len(v))):
                last = r[k] + gamma * (v[k + 1] if k + 1 < len(v) else 0.0) - v[k] + gamma * lam * last
                want[k] = last
            assert np.allclose(got[i], want, rtol=1e-9, atol=1e-9)


def test_masks(spark):
    df = spark.createDataFrame(
        [([5, 2, 6, 2], [1, 1, 1, 1]), ([5, 6], [1, 1]), ([2, 5, 2, 7], [0, 1, 1, 1]), ([2], [0]), ([], [])], "ids array<int>, mask array<int>"
    )
    out = df.select(diagnostics.first_eos_mask(F.col("ids"), F.col("mask")).alias("m"), diagnostics.terminal_rewards(F.col("mask"), F.lit(2.0)).alias("r")).collect()
    assert [r["m"] for r in out] == [[1, 1, 0, 0], [1, 1], [0, 1, 1, 0], [0], []]
    assert [r["r"] for r in out] == [[0, 0, 0, 2.0], [0, 2.0], [0, 0, 0, 2.0], [0.0], []]


def test_group_advantage_hot_and_cold(spark):
    """The broadcast path for hot groups gives what the shuffle path gives."""
    rng = random.Random(2)
    rows = [(0 if i % 3 else i, i, rng.uniform(0, 1)) for i in range(600)]
    df = spark.createDataFrame(rows, "prompt_id bigint, gen bigint, reward double")
    a = {r["gen"]: r["advantage"] for r in diagnostics.group_advantages(df, hot_rows=50).collect()}
    b = {r["gen"]: r["advantage"] for r in diagnostics.group_advantages(df).collect()}
    assert len(a) == len(b) == 600 and all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)
    assert a[3] == 0.0  # alone in its group


def test_hot_group_is_spread(spark):
    """A group with a third of all rows does not end up in one partition."""
    rows = spark.range(0, 60000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("prompt_id"), F.col("id").alias("gen"), (F.col("id") % 7 / 7).alias("reward")
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = diagnostics.group_advantages(rows, hot_rows=5000)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 60000 and max(sizes) < 60000 * 0.2


def test_answer_spans():
    head, tail = np.array([1, 9]), np.array([2, 8])
    ids = np.array([1, 9, 5, 6, 2, 8, 7, 1, 9, 4, 2, 3, 1, 9])
    assert tokens.answer_spans(ids, head, tail) == [(2, 6), (9, 14)]
    assert tokens.answer_spans(np.array([1, 9, 2, 8]), head, tail) == [(2, 4)]
    assert tokens.answer_spans(np.array([7, 1]), head, tail) == []


def scan(ids, head, tail, limit):
    """Labels by looking at every position."""
    out, inside, i = [-100] * len(ids), False, 0
    while i < len(ids):
        if not inside and ids[i : i + len(head)] == head:
            inside, i = True, i + len(head)
        elif inside and ids[i : i + len(tail)] == tail:
            for j in range(i, min(i + len(tail), limit)):
                out[j] = ids[j]
            inside, i = False, i + len(tail)
        else:
            if inside and i < limit:
                out[i] = ids[i]
            i += 1
    return out


def test_labels_like_a_scan(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([1, 2, 3, 4]) for _ in range(rng.randint(0, 40))]) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, ids array<int>")
    got = {r["i"]: r["l"] for r in df.select("i", tokens.answer_labels([1, 3], [2, 4], 30)(F.col("ids")).alias("l")).collect()}
    for i, ids in rows:
        assert got[i] == scan(ids, [1, 3], [2, 4], 30)


def test_arrays(spark):
    df = spark.createDataFrame([([5, 6, 7],)], "ids array<int>")
    r = df.select(
        tokens.pretrain_ids(F.col("ids"), 4).alias("a"), tokens.pretrain_ids(F.col("ids"), 7).alias("b"), tokens.fixed_length(F.col("ids"), 5).alias("c"),
        tokens.left_padded(F.col("ids"), 2, 4).alias("d"), tokens.repair_logps(F.array(F.lit(1.0)), F.col("ids")).alias("e"),
        tokens.repair_logps(F.array(*[F.lit(float(k)) for k in range(5)]), F.col("ids")).alias("f"),
    ).first()
    assert list(r) == [[1, 5, 6, 2], [1, 5, 6, 7, 2, 0, 0], [5, 6, 7, 0, 0], [0, 0, 6, 7], [0.0, 0.0, 1.0], [2.0, 3.0, 4.0]]


def test_trajectory(spark):
    turn = "struct<new_ids:array<int>,new_logps:array<double>,obs_ids:array<int>>"
    df = spark.createDataFrame([([9, 9], [([5, 2], [-1.0, -2.0], [2, 7]), ([6], [-3.0], [])])], f"prompt_ids array<int>, turns array<{turn}>")
    out = trajectories.pack(trajectories.assemble(df, F.col("turns")), 100).first()
    assert out["ids"] == [9, 9, 5, 2, 7, 6] and out["mask"] == [0, 0, 1, 0, 0, 1]
    assert out["old_logps"] == [0.0, -1.0, -2.0, 0.0, -3.0] and out["prompt_len"] == 2
    cut = trajectories.pack(trajectories.assemble(df, F.col("turns")), 3).first()
    assert cut["ids"] == [2, 7, 6] and cut["mask"] == [0, 0, 1] and cut["old_logps"] == [0.0, -3.0] and cut["prompt_len"] == 2


def test_agent_rewards(spark):
    call = '<tool_call>{"name": "get_exchange_rate", "arguments": {"from_currency": "USD", "to_currency": "KRW"}}</tool_call>'
    rows = [
        ("1350 is it", [call, "1350 is it"], ["1350"], False, None, ["get_exchange_rate"]),
        ("1350 is it", [call, "1350 is it"], ["1350"], False, None, ["other"]),
        (call, [call], ["1350"], True, None, None),
        ("hello there friend", ["hello there friend"], [], False, 9.0, None),
        ("<tool_call>[1]</tool_call> hi", ["<tool_call>[1]</tool_call> hi"], [], False, None, None),
        ("x" * 900, ["x" * 900], [], False, -9.0, None),
    ]
    df = spark.createDataFrame(rows, "response string, turn_outputs array<string>, gt array<string>, unfinished boolean, rm_score double, names array<string>")
    got = [r["reward"] for r in rewards.agent_rewards(df.where("names is not null"), F.col("names")).collect()]
    assert got == [3.0, -0.5 * 2 + 2.5]
    got = [r["reward"] for r in rewards.agent_rewards(df.where("names is null")).collect()]
    # The call has 36 3-grams of words and marks, 33 of them different: a penalty of 3/36.
    assert np.allclose(got, [0.5 - 0.5 - 1 / 12, 3.0, 0.5, -3.0]), got


def test_basic_reward(spark):
    rows = [("short", 0.0), ("y" * 30, 1.0), ("z" * 25 + "</think>" + "w" * 30, 0.0), ("a</think>b</think>" + "c" * 20, 9.0)]
    df = spark.createDataFrame(rows, "r string, s double")
    got = [x[0] for x in df.select(rewards.basic_reward(F.col("r"), F.col("s"))).collect()]
    assert got == [-0.5, 1.5, 0.5 + 1.25, 0.5 - 0.75 + 3.0]


def test_losses_and_whitening_by_hand(spark):
    """Two rows of one group: values outside the mask are 0, means are over tokens."""
    rows = [("a", [0.0, 0.0], [0.0, 0.0], [1.0, -1.0], [1, 1]), ("a", [math.log(2.0), 0.0], [0.0, 0.0], [1.0, 9.0], [1, 0])]
    df = spark.createDataFrame(rows, "g string, new array<double>, old array<double>, advantages array<double>, mask array<int>")
    loss = diagnostics.clipped_losses(F.col("new"), F.col("old"), F.col("advantages"))
    out = diagnostics.token_mean(diagnostics.row_losses(df, loss, F.col("mask")), ["g"]).first()
    assert out["n_tokens"] == 3 and out["loss"] == pytest.approx((-1.0 + 1.0 - 1.2) / 3)
    white = [r["whitened"] for r in diagnostics.whiten(df).collect()]
    assert sorted(x for w in white for x in w) == pytest.approx([-math.sqrt(2), 0.0, math.sqrt(0.5), math.sqrt(0.5)], abs=1e-6)
