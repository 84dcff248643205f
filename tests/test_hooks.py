"""Row functions, scorers and batch cutting of a user's own: results, and what is refused."""

import random

import pytest
from pyspark.sql import functions as F

from turnloom.functions import hooks
from turnloom.operators import rewards, toolcalls


def test_row_function_skips_and_fills(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id long, text string")
    got = hooks.map_rows(rows, lambda r: {"id": r["id"]} if r["text"] != "" else None, "id long, note string").collect()
    assert sorted(map(tuple, got)) == [(1, None), (2, None)]
    assert hooks.map_rows(rows.limit(0), lambda r: r, "id long, text string").collect() == []


@pytest.mark.parametrize("made, said", [({"idd": 1}, "idd"), ({"id": "x"}, "'id'")])
def test_row_function_slips_fail(spark, made, said):
    with pytest.raises(Exception, match=said):
        hooks.map_rows(spark.range(3), lambda _row: made, "id long").collect()


def test_scorer(spark):
    rows = spark.createDataFrame([(1, "ab", 9.0), (2, None, 9.0), (3, "", 9.0), (4, "abcdefgh", None)], "id long, response string, rm_score double")

    def score(messages, responses):
        assert all(m == [] for m in messages) and None not in responses
        return [float("nan") if not r else len(r) for r in responses]

    got = {r["id"]: r["rm_score"] for r in rewards.with_model_scores(rows, score).collect()}
    assert got == {1: 2.0, 2: None, 3: None, 4: 3.0}
    assert rewards.with_model_scores(rows) is rows
    with pytest.raises(Exception, match="0 scores for"):
        rewards.with_model_scores(rows, lambda _m, _r: []).collect()
    with pytest.raises(ValueError, match="_response"):
        rewards.with_model_scores(rows.withColumn("_response", F.lit(1)), score)


def _walk(rows, max_rows, max_tokens):
    out, ids, total = [], [], 0
    for row_id, n in rows:
        n = n or 0
        if ids and (len(ids) == max_rows or total + n > max_tokens):
            out.append((len(ids), total, ids))
            ids, total = [], 0
        ids, total = [*ids, row_id], total + n
    return out + ([(len(ids), total, ids)] if ids else [])


def test_batches_equal_a_walk(spark):
    draw = random.Random(3)
    rows = [(k % 5, k, f"r{k}", draw.choice([None, 0, 3, 40, 99, 300])) for k in range(400)]
    df = spark.createDataFrame(rows, "shard long, place long, row_id string, n_tokens long").repartition(7)
    got = {}
    for r in hooks.token_batches(df, 6, 200).collect():
        got.setdefault(r["shard"], {})[r["batch"]] = (r["n_rows"], r["n_tokens"], r["row_ids"])
    for shard in range(5):
        want = _walk([(i, n) for s, _place, i, n in rows if s == shard], 6, 200)
        assert [got[shard][b] for b in range(len(got[shard]))] == want
    assert hooks.token_batches(df.limit(0), 6, 200).collect() == []


def test_batches_refuse(spark):
    df = spark.createDataFrame([(0, 0, "a", 1)], "shard long, place long, row_id string, n_tokens long")
    with pytest.raises(Exception, match="at least 1"):
        hooks.token_batches(df, 0, 5).collect()


def test_case_report_of_malformed_and_unoffered(spark):
    names = "sample_id long, name string, known boolean, valid boolean"
    calls = [(1, "a", True, True), (1, None, False, False), (2, "a", True, True), (2, "b", True, True), (3, "x", False, False), (4, "a", True, False), (5, "a", True, True)]
    offered = spark.createDataFrame([(1, "a"), (2, "a"), (4, "a"), (5, "a"), (5, "a")], "sample_id long, name string")
    got = {r[0]: tuple(r)[1:] for r in toolcalls.case_report(spark.createDataFrame(calls, names), offered).collect()}
    assert got == {
        1: (2, 1, 0, 0, 1, 0, 1, False), 2: (2, 0, 0, 0, 2, 1, 2, False), 3: (1, 0, 1, 0, 0, 1, 0, False),
        4: (1, 0, 0, 1, 0, 0, 0, False), 5: (1, 0, 0, 0, 1, 0, 1, True),
    }
