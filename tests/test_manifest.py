"""Samples, permutations and batches: bijections, counts, layout independence."""

import hashlib

import pytest
from pyspark.sql import functions as F

from turnloom.operators import manifest


def ids(spark, n, parts):
    return spark.range(0, n, 1, parts).withColumnRenamed("id", "row_id")


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_positions_do_not_depend_on_layout(spark, parts):
    got = {r["row_id"]: r["pos"] for r in manifest.shuffled_positions(ids(spark, 500, parts), "row_id", 42, 1).collect()}
    order = sorted(range(500), key=lambda i: hashlib.md5(f"43|1|{i}".encode()).hexdigest())
    assert got == {i: p for p, i in enumerate(order)}


@pytest.mark.parametrize("n", [0, 1, 17, 499, 500, 900])
def test_sample_is_the_smallest_keys(spark, n):
    got = {r["row_id"] for r in manifest.sample_n(ids(spark, 500, 3), "row_id", n, 42).collect()}
    order = sorted(range(500), key=lambda i: hashlib.md5(f"42|0|{i}".encode()).hexdigest())
    assert got == set(order[:n])


def test_sample_with_few_buckets(spark):
    """Many rows in the bucket of the cut."""
    got = {r["row_id"] for r in manifest.sample_n(ids(spark, 500, 3), "row_id", 123, 42, digits=1).collect()}
    order = sorted(range(500), key=lambda i: hashlib.md5(f"42|0|{i}".encode()).hexdigest())
    assert got == set(order[:123])


def loader(order, size, skip):
    """Batches as a loader that skips full batches deals them."""
    full = [order[i : i + size] for i in range(0, len(order), size)]
    kept = full[skip:] if skip <= len(full) else []
    if full and len(full[-1]) < size and skip > len(full) - 1:
        kept = []
    return kept


@pytest.mark.parametrize("n,size,skip", [(10, 4, 0), (10, 4, 2), (10, 4, 3), (8, 4, 2), (8, 4, 1)])
def test_batches(spark, n, size, skip):
    placed = manifest.shuffled_positions(ids(spark, n, 2), "row_id")
    order = [r["row_id"] for r in placed.orderBy("pos").collect()]
    out = manifest.batches(placed, size, skip).orderBy("pos").collect()
    got = {}
    for r in out:
        got.setdefault(r["batch_id"], []).append(r["row_id"])
    assert list(got.values()) == loader(order, size, skip)
    assert manifest.batch_count(n, size, skip) == max(0, -(-n // size) - skip)


def test_first_rows(spark):
    df = ids(spark, 100, 7)
    even = F.col("row_id") % 2 == 0
    assert sorted(r[0] for r in manifest.first_accepted(df, even, F.col("row_id"), 3).collect()) == [0, 2, 4]
    assert sorted(r[0] for r in manifest.first_read(df, even, F.col("row_id"), 3).collect()) == [0, 2]
    assert manifest.first_accepted(df, even, F.col("row_id")).count() == 50


def test_resume_and_rate(spark):
    assert manifest.resume_step(100, 2, 4) == 50
    row = spark.range(1).select(manifest.resume_step(F.lit(101), 2, 4).alias("s"), manifest.learning_rate(F.lit(0), 10, 1.0).alias("r"), manifest.learning_rate(F.lit(10), 10, 1.0).alias("e")).first()
    assert (row["s"], round(row["r"], 9), round(row["e"], 9)) == (50, 1.0, 0.1)
