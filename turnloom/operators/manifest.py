"""Limits, samples, epoch order, batches and ranks.

Row order is data: every order is a unique key made of ids, so results do not
depend on file layout, and a position is computed without one task seeing all
rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.draws import draw_key, hex_prefix


def nth_key(df: DataFrame, order: Column, n: int, block: Column | None = None) -> Column:
    """The n-th smallest value of a unique key, null when there are fewer rows.

    Without ``block`` this is a top-n of keys, for a small n.  ``block`` is a
    prefix of the order that cuts the rows into blocks of bounded size, such as
    file splits: then one count per block tells the block the cut falls into, and
    only that block is ranked.
    """
    if block is None:
        keys = df.select(order.alias("k")).orderBy("k").limit(n)
        return keys.agg(F.when(F.count("*") == n, F.max("k")).alias("cut")).scalar()
    keys = df.select(block.alias("b"), order.alias("k"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = keys.groupBy("b").agg(F.count("*").alias("n")).withColumn("before", before)
    edge = counts.where((F.col("before") < n) & (F.col("before") + F.col("n") >= n)).agg(F.max(F.struct("b", "before")).alias("e"))
    ranked = keys.where(F.col("b") == edge.select("e.b").scalar()).withColumn("rank", F.row_number().over(Window.partitionBy("b").orderBy("k")))
    return ranked.where(F.col("rank") == n - edge.select("e.before").scalar()).agg(F.max("k").alias("cut")).scalar()


def first_n(df: DataFrame, order: Column, n: int, block: Column | None = None) -> DataFrame:
    """The first n rows by a unique key, without moving the rows: the n-th key filters the scan."""
    cut = nth_key(df, order, n, block)
    return df.where(cut.isNull() | (order <= cut))


def first_accepted(df: DataFrame, accepted: Column, order: Column, n: int = 0) -> DataFrame:
    """The first n rows that pass, counting only those that pass; 0 is all."""
    kept = df.where(accepted)
    return first_n(kept, order, n) if n else kept


def first_read(df: DataFrame, accepted: Column, order: Column, n: int = 0) -> DataFrame:
    """Rows that pass among the first n rows read, good or bad; 0 is all."""
    return (first_n(df, order, n) if n else df).where(accepted)


# A random 128-bit key falls evenly into buckets of its first hex digits, so
# positions need one pre-aggregated count per bucket and a sort inside each.
BUCKET_DIGITS = 4


def _bucket_offsets(keyed: DataFrame, digits: int) -> DataFrame:
    """(bucket, rows before it): at most 16**digits rows, whatever the input."""
    counts = keyed.groupBy(hex_prefix(F.col("order_key"), digits).alias("bucket")).agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("bucket", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))


def shuffled_positions(df: DataFrame, row_id: str, seed: int = 42, epoch: int = 0, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Adds ``order_key`` and ``pos``: a permutation of the rows for one epoch.

    The offsets table is bounded by 16**digits (65,536) rows and broadcast; the
    rows are shuffled once, into buckets of even size.
    """
    keyed = df.withColumn("order_key", draw_key(seed + epoch, epoch, F.col(row_id)))
    offsets = _bucket_offsets(keyed.select("order_key"), digits).select("bucket", "offset")
    inside = Window.partitionBy("bucket").orderBy("order_key", row_id)
    return (
        keyed.withColumn("bucket", hex_prefix(F.col("order_key"), digits))
        .withColumn("pos_in", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "bucket")
        .withColumn("pos", (F.col("offset") + F.col("pos_in")).cast("bigint"))
        .drop("bucket", "pos_in", "offset")
    )


def sample_n(df: DataFrame, row_id: str, n: int = 10000, seed: int = 42, digits: int = BUCKET_DIGITS) -> DataFrame:
    """n rows without replacement (all when there are fewer): the n smallest keys.

    Buckets wholly inside the sample are kept as they stream by; only the one
    bucket the cut falls into (1/65,536 of the rows) is ranked.
    """
    if n <= 0:
        return df.where(F.lit(False))
    keyed = df.withColumn("order_key", draw_key(seed, 0, F.col(row_id)))
    slim = keyed.select("order_key", row_id)
    offsets = _bucket_offsets(slim, digits)
    cut = offsets.where((F.col("offset") < n) & (F.col("offset") + F.col("n") >= n)).agg(
        F.struct(F.max("bucket").alias("bucket"), F.max("offset").alias("offset")).alias("c")
    )
    bucket = hex_prefix(F.col("order_key"), digits)
    # No bucket holds the cut when there are fewer than n rows: then all stay.
    edge = slim.where(bucket == cut.select("c.bucket").scalar())
    ranked = edge.withColumn("rank", F.row_number().over(Window.partitionBy(bucket).orderBy("order_key", row_id)))
    last = ranked.where(F.col("rank") <= n - cut.select("c.offset").scalar()).agg(
        F.max(F.struct("order_key", F.col(row_id).alias("id"))).alias("last")
    )
    key = F.struct("order_key", F.col(row_id).alias("id"))
    limit = last.scalar()
    return keyed.where(limit.isNull() | (key <= limit)).drop("order_key")


def batch_count(rows: int, batch_size: int, skip: int = 0) -> int:
    """Number of batches the loader reports."""
    return max(0, math.ceil(rows / batch_size) - skip)


def batches(positions: DataFrame, batch_size: int, skip: int = 0, world: int = 1) -> DataFrame:
    """Adds rank, step and the batch each row belongs to.

    Rows are dealt to ranks in turn.  The first ``skip`` full batches of a rank
    are left out; a last partial batch stays only if that many were there to
    skip, which is what ``batch_id >= skip`` says.
    """
    rank_pos = F.floor(F.col("pos") / F.lit(world))
    return (
        positions.withColumn("rank", F.pmod(F.col("pos"), F.lit(world)).cast("int"))
        .withColumn("batch_id", F.floor(rank_pos / F.lit(batch_size)).cast("bigint"))
        .where(F.col("batch_id") >= skip)
    )


def resume_step(step: Column | int, old_world: int, new_world: int):
    """The step to go on from after the number of ranks changed."""
    if isinstance(step, Column):
        return F.floor(step * F.lit(old_world) / F.lit(new_world)).cast("bigint")
    return step * old_world // new_world


def learning_rate(step: Column, total: Column | int, base: float) -> Column:
    total = total if isinstance(total, Column) else F.lit(total)
    return F.lit(base) * (F.lit(0.1) + F.lit(0.45) * (F.lit(1.0) + F.cos(F.lit(math.pi) * step / total)))


def update_id(step: Column, accumulate: int) -> Column:
    """Optimiser update a step (from 1) goes into; the last one may be short."""
    return F.floor((step - 1) / F.lit(accumulate)).cast("bigint")


def epoch_manifest(df: DataFrame, row_id: str, batch_size: int, epochs: int = 1, seed: int = 42, world: int = 1,
                   skip: int = 0, accumulate: int = 1, base_rate: float = 5e-4) -> DataFrame:
    """One row per (epoch, sample): position, rank, batch, step, rate, update.

    ``skip`` batches are left out of the first epoch only, as on resume.
    """
    ids = df.select(row_id)
    steps = ids.agg(F.ceil(F.ceil(F.count("*") / F.lit(world)) / F.lit(batch_size)).cast("bigint").alias("s"))
    out = None
    for epoch in range(epochs):
        placed = shuffled_positions(ids, row_id, seed, epoch).drop("order_key").withColumn("epoch", F.lit(epoch))
        placed = batches(placed, batch_size, skip if epoch == 0 else 0, world)
        out = placed if out is None else out.unionByName(placed)
    step = F.col("batch_id") + 1
    return (
        out.withColumn("steps", steps.scalar())
        .withColumn("step", step)
        .withColumn("rate", learning_rate(F.col("epoch") * F.col("steps") + step, F.col("steps") * F.lit(epochs), base_rate))
        .withColumn("update_id", update_id(step, accumulate))
    )


def expand_generations(prompts: DataFrame, n: int) -> DataFrame:
    """Each prompt n times, numbered; rollout idx // n leads back to its prompt."""
    return prompts.withColumn("gen", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def prompts_of(rollouts: DataFrame, prompts: DataFrame, n: int, index: str = "idx", prompt_no: str = "prompt_no") -> DataFrame:
    """Each rollout with the prompt it came from, by number (idx // n)."""
    numbered = rollouts.withColumn(prompt_no, F.floor(F.col(index) / F.lit(n)).cast("bigint"))
    return numbered.join(prompts, prompt_no)
