"""Random decisions as pure functions of (seed, epoch, id).

They do not depend on partitioning, task order or retries, so a lost executor
recomputes exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_key(seed: str | int, epoch: int | Column, row_id: Column) -> Column:
    """128-bit hex key that orders rows at random."""
    epoch = epoch if isinstance(epoch, Column) else F.lit(epoch)
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), row_id.cast("string")))


def hex_prefix(key: Column, digits: int) -> Column:
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")


def uniform(seed: str | int, epoch: int | Column, row_id: Column) -> Column:
    """A number in [0, 1) with 32 bits."""
    return hex_prefix(draw_key(seed, epoch, row_id), 8) / F.lit(4294967296.0)


def pick(seed: str | int, epoch: int | Column, row_id: Column, choices: int) -> Column:
    """A number in 0 .. choices-1."""
    return F.pmod(hex_prefix(draw_key(seed, epoch, row_id), 8), F.lit(choices)).cast("int")
