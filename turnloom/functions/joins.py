"""Joining per-key results back to rows when one key may hold much of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 1024
# The bound of the broadcast: keys past it have at most total/HOT_KEYS rows each.
HOT_KEYS = 10_000


def with_key_stats(rows: DataFrame, stats: DataFrame, key: str, n: str, hot_rows: int = 1_000_000) -> DataFrame:
    """Adds the columns of ``stats`` (one row per key, ``n`` its row count) to ``rows``.

    Keys with at least ``hot_rows`` rows are broadcast, the ``HOT_KEYS`` largest
    at most.  Their rows take part in the shuffle of the other keys under a salt
    that nothing matches, so they spread evenly and every row is read and moved
    once.
    """
    fields = [c for c in stats.columns if c != key]
    hot = stats.where(F.col(n) >= hot_rows).orderBy(F.desc(n), key).limit(HOT_KEYS).select(key, F.struct(*fields).alias("_hot"))
    # Not a literal: the optimiser would take a constant out of the join key.
    unsalted = -(F.col(n) >= 0).cast("int")
    # Rows are salted by their place, as equal rows would share a salt made of their values.
    cold = stats.join(F.broadcast(hot.select(key)), key, "left_anti").select(key, unsalted.alias("_salt"), F.struct(*fields).alias("_cold"))
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).otherwise(F.lit(-1))
    joined = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).join(cold, [key, "_salt"], "left")
    both = joined.withColumn("_stats", F.coalesce("_hot", "_cold"))
    return both.select(*rows.columns, *[F.col(f"_stats.{f}").alias(f) for f in fields])
