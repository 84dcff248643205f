"""Numbers over logged rollouts: advantages, KL, clip rates, losses, margins."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom import constants as K
from turnloom.functions.arrays import masked, total, total_int
from turnloom.functions.joins import with_key_stats

DOUBLES = T.ArrayType(T.DoubleType())


# --- per group ------------------------------------------------------------------


def group_stats(rewards: DataFrame, group: str = "prompt_id") -> DataFrame:
    """Mean and population deviation per prompt, combined before the shuffle."""
    return rewards.groupBy(group).agg(
        F.count("*").alias("group_n"), F.avg("reward").alias("group_mean"), F.stddev_pop("reward").alias("group_std")
    )


def group_advantages(rewards: DataFrame, group: str = "prompt_id", hot_rows: int = 1_000_000) -> DataFrame:
    """Adds (reward - group mean) / (group std + 1e-4).

    A window over the prompt would put a hot prompt into one task; here its
    statistics are aggregated and joined back.
    """
    stats = group_stats(rewards, group)
    return with_key_stats(rewards, stats, group, "group_n", hot_rows).withColumn(
        "advantage", (F.col("reward") - F.col("group_mean")) / (F.col("group_std") + F.lit(1e-4))
    )


# --- per token ------------------------------------------------------------------


def first_eos_mask(ids: Column, mask: Column, eos: int = K.EOS_ID) -> Column:
    """The mask up to and including the first EOS inside it; all of it without one."""
    hits = F.zip_with(ids, mask, lambda t, m: F.when((t == eos) & (m > 0), 1).otherwise(0))
    pairs = F.transform(
        F.array(F.struct(F.array_position(hits, 1).alias("at"), mask.alias("mask"))),
        lambda z: F.transform(z["mask"], lambda m, i: F.when((z["at"] > 0) & (i + 1 > z["at"]), 0).otherwise(m)),
    )
    return pairs.getItem(0)


def response_length(ids: Column, mask: Column, eos: int = K.EOS_ID) -> Column:
    return total_int(F.transform(first_eos_mask(ids, mask, eos), lambda m: m.cast("bigint")))


def last_valid(mask: Column) -> Column:
    """Index of the last 1 of the mask, -1 without one."""
    return F.size(mask) - F.array_position(F.reverse(mask), 1).cast("int")


def terminal_rewards(mask: Column, reward: Column) -> Column:
    """The reward at the last valid token, 0 elsewhere."""
    zero, at = F.lit(0.0), last_valid(mask)
    placed = F.concat(F.array_repeat(zero, at), F.array(reward), F.array_repeat(zero, F.size(mask) - at - 1))
    return F.when(F.array_contains(mask, 1), placed).otherwise(F.array_repeat(zero, F.size(mask)))


def _discounted_tail(delta: np.ndarray, c: float) -> np.ndarray:
    """out[t] = sum over k >= t of c**(k-t) * delta[k], block by block.

    Inside a block the powers of c stay above 1e-12, so one scaled cumulative
    sum is exact to rounding; a carry links the blocks.
    """
    if c <= 0.0:
        return delta.copy()
    block = len(delta) if c >= 1.0 else max(1, int(math.log(1e-12) / math.log(c)))
    out, carry = np.empty_like(delta), 0.0
    for stop in range(len(delta), 0, -max(block, 1)):
        start = max(0, stop - block)
        scale = c ** np.arange(stop - start)
        tail = np.cumsum((delta[start:stop] * scale)[::-1])[::-1]
        out[start:stop] = (tail + carry * c ** (stop - start)) / scale
        carry = out[start]
    return out


def advantage_estimator(gamma: float = 1.0, lam: float = 0.95):
    """A Column function (values, rewards) -> generalised advantages.

    A recurrence from the end of each row; linear time per row in numpy, where
    an array fold would copy its output at every step.
    """

    @F.pandas_udf(DOUBLES)
    def estimate(values: pd.Series, rewards: pd.Series) -> pd.Series:
        def one(v, r):
            v, r = np.asarray(v, dtype="float64"), np.asarray(r, dtype="float64")
            if len(v) == 0:
                return v
            return _discounted_tail(r + gamma * np.append(v[1:], 0.0) - v, gamma * lam)

        return pd.Series([one(v, r) for v, r in zip(values, rewards)])

    return estimate


def _chunk_width(c: float, width: int) -> int:
    """Steps of a chunk, so few that powers of c stay far above the smallest double."""
    return max(2, min(width, int(-575 / math.log(c)))) if 0.0 < c < 1.0 else width


def _chunked(rows: DataFrame, width: int) -> DataFrame:
    return rows.withColumns({"_chunk": F.floor(F.col("pos") / F.lit(width)).cast("bigint"), "_at": F.pmod("pos", F.lit(width))})


def discounted_tails(rows: DataFrame, key: str, c: float, longest: int, width: int = 1024) -> DataFrame:
    """Adds ``tail`` to (key, pos, x, ...): the sum over k >= pos of c**(k - pos) * x[k].

    A step is an affine map of what comes after it, and maps compose in any
    grouping: chunks of ``width`` steps are summed by themselves, their heads are
    the same problem with c**width and a ``width``-th of the rows, and what lies
    after a chunk is joined back by (key, chunk).  So no task holds a whole
    trajectory.  ``pos`` counts from 0 without gaps and ``longest`` is its highest
    value.  Below 1e-30 a factor is taken as 0.
    """
    if c < 1e-30:
        return rows.withColumn("tail", F.col("x"))
    width = _chunk_width(c, width)
    if "_chunk" not in rows.columns:
        rows = _chunked(rows, width)
    onward = Window.partitionBy(key, "_chunk").orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scale = F.pow(F.lit(c), F.col("_at"))
    local = rows.withColumn("tail", F.sum(F.col("x") * scale).over(onward) / scale)
    if longest < width:
        return local.drop("_chunk", "_at")
    heads = local.where(F.col("_at") == 0).select(key, F.col("_chunk").alias("pos"), F.col("tail").alias("x"))
    after = discounted_tails(heads, key, c**width, longest // width, width)
    after = after.select(key, (F.col("pos") - 1).alias("_chunk"), F.col("tail").alias("_after"))
    carried = F.pow(F.lit(c), F.lit(width) - F.col("_at")) * F.coalesce("_after", F.lit(0.0))
    joined = local.join(after, [key, "_chunk"], "left").withColumn("tail", F.col("tail") + carried)
    return joined.drop("_chunk", "_at", "_after")


# Cells of the matrix of chunks and their steps that is summed at once.
_CELLS = 1 << 22


def _lists(starts: np.ndarray, n: int, *columns: pa.Array) -> list[pa.ListArray]:
    offsets = pa.array(np.append(starts, n).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, c) for c in columns]


def _floats(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers, 0 where there is none, and where there is one."""
    return column.fill_null(0.0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def _packed_steps(steps: DataFrame, key: str, width: int) -> DataFrame:
    """(key, _chunk, at, value, reward): neighbouring steps of a chunk as one row of lists.

    A step that begins a chunk also comes as the place ``width`` of the chunk
    before, for its value; where rows are in order that chunk's list ends on it.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos = batch.column(1).to_numpy()
            chunk, at = np.floor_divide(pos, width), np.mod(pos, width)
            border = np.flatnonzero((at == 0) & (pos > 0))
            rows = np.insert(np.arange(len(pos)), border, border)
            copied = np.insert(np.zeros(len(pos), bool), border, True)
            chunk, at = chunk[rows] - copied, np.where(copied, width, at[rows])
            keys = batch.column(0).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)[rows]
            starts = np.flatnonzero(np.append(True, (np.diff(keys) != 0) | (np.diff(chunk) != 0))[: len(rows)])
            taken = pa.array(rows)
            lists = _lists(starts, len(rows), pa.array(at.astype(np.int32)), batch.column(2).take(taken), batch.column(3).take(taken))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(taken.take(pa.array(starts))), pa.array(chunk[starts]), *lists], names=[key, "_chunk", "at", "value", "reward"])

    given = steps.where("pos IS NOT NULL").select(key, F.col("pos").cast("bigint").alias("pos"), F.col("value").cast("double"), F.col("reward").cast("double"))
    fields = [given.schema[key], T.StructField("_chunk", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("value", DOUBLES), T.StructField("reward", DOUBLES)]
    return given.mapInArrow(pack, T.StructType(fields))


def _whole_chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by key and chunk, in tables of bounded size cut so that no chunk lies in two, and the number of each row's chunk."""
    rest, rows = None, max(1, _CELLS // (4 * width))
    for batch in (b.slice(a, rows) for b in batches for a in range(0, b.num_rows, rows)):
        table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
        keys = table.column(0).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        number = np.cumsum(np.append(0, (np.diff(keys) != 0) | (np.diff(table.column(1).to_numpy()) != 0)))
        end = int(np.searchsorted(number, number[-1]))
        if end:
            yield table.slice(0, end), number[:end]
        rest = table.slice(end)
    if rest is not None:
        yield rest, np.zeros(rest.num_rows, np.int64)


def _chunk_tails(table: pa.Table, number: np.ndarray, gamma: float, c: float, width: int) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Each step's row, place, value, tail inside its chunk, and whether it has one."""
    lists = [table.column(x).combine_chunks() for x in ("at", "value", "reward")]
    row = np.repeat(np.arange(table.num_rows), lists[0].value_lengths().to_numpy())
    at, value, reward = (x.flatten() for x in lists)
    group, at = number[row], at.to_numpy()
    order = np.lexsort((at, group))
    group, at, row, value = group[order], at[order], row[order], value.take(pa.array(order))
    (v, has_v), (r, has_r) = _floats(value), _floats(reward.take(pa.array(order)))
    follows = np.append(group[1:] == group[:-1], False)[: len(group)]
    after, has_after = np.where(follows, np.append(v[1:], 0.0)[: len(v)], 0.0), ~follows | np.append(has_v[1:], True)[: len(v)]
    step = at < width
    group, at, row, value = group[step], at[step], row[step], value.filter(pa.array(step))
    x, has = (r + gamma * after - v)[step], (has_r & has_after & has_v)[step]
    if c < 1e-30:
        return row, at, value, x, has
    # From the last step on; repeated steps in the order they have.
    back = np.lexsort((-at, group))
    group, at, row, value, x, has = group[back], at[back], row[back], value.take(pa.array(back)), np.where(has, x, 0.0)[back], has[back]
    tail, some = np.empty_like(x), np.empty_like(has)
    starts = np.flatnonzero(np.append(True, np.diff(group) != 0)[: len(group)])
    sizes = np.diff(np.append(starts, len(group)))
    scale = c ** at.astype(float)
    first = 0
    while first < len(starts):
        # As many chunks as fit a matrix of their longest; one at least.
        last = first + max(1, int(np.searchsorted(np.arange(1, len(starts) - first + 1) * np.maximum.accumulate(sizes[first:]), _CELLS, "right")))
        a, z, most = starts[first], starts[last - 1] + sizes[last - 1], int(sizes[first:last].max())
        which = np.repeat(np.arange(last - first), sizes[first:last])
        place = np.arange(a, z) - starts[first:last][which]
        summed, seen = np.zeros((last - first, most)), np.zeros((last - first, most), bool)
        summed[which, place], seen[which, place] = x[a:z] * scale[a:z], has[a:z]
        tail[a:z] = np.cumsum(summed, axis=1)[which, place] / scale[a:z]
        some[a:z] = np.logical_or.accumulate(seen, axis=1)[which, place]
        first = last
    return row, at, value, tail, some


def long_advantages(steps: DataFrame, key: str, gamma: float = 1.0, lam: float = 0.95, width: int = 1024) -> DataFrame:
    """(key, pos, advantage, return) of steps (key, pos, value, reward), one row each.

    For trajectories that no row should hold whole.  Neighbouring steps of a chunk
    leave the map tasks as lists, which are shuffled once, by (key, chunk); the
    value after a chunk's last step comes from a copy of the next chunk's first
    step.  Chunks are summed by themselves, their heads go on as rows to
    ``discounted_tails``, and what lies after a chunk is joined to its lists.
    Keys are not null; an empty table gives an empty result.  Starts a job for
    the longest trajectory.
    """
    longest = steps.agg(F.max("pos")).first()[0] or 0
    c = gamma * lam
    width = _chunk_width(c, width)
    # Dealt by name, not by need: the planner then never splits a chunk's rows.
    dealt = _packed_steps(steps, key, width).repartition(key, "_chunk")
    kind, pos_kind = dealt.schema[key], steps.schema["pos"].dataType

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in _whole_chunks(batches, width):
            row, at, _value, tail, some = _chunk_tails(table, number, gamma, c, width)
            first = at == 0
            own = table.take(pa.array(row[first]))
            yield pa.RecordBatch.from_arrays([own.column(0).combine_chunks(), own.column(1).combine_chunks(), pa.array(tail[first], mask=~some[first])], names=[key, "pos", "x"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, number in _whole_chunks(batches, width):
            row, at, value, tail, some = _chunk_tails(table, number, gamma, c, width)
            lists = table.column("after").combine_chunks()
            n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            begin, held = np.cumsum(n) - n, np.append(lists.flatten().to_numpy(zero_copy_only=False), 0.0)
            # A head that came more than once gives each of the steps before it as often.
            again = np.repeat(np.arange(len(row)), np.maximum(n[row], 1))
            nth = np.arange(len(again)) - np.repeat(np.cumsum(np.maximum(n[row], 1)) - np.maximum(n[row], 1), np.maximum(n[row], 1))
            row, at, value, tail, some = row[again], at[again], value.take(pa.array(again)), tail[again], some[again]
            carry = held[np.where(n[row] > 0, begin[row] + nth, len(held) - 1)]
            if c >= 1e-30:
                tail = tail + c ** (width - at).astype(float) * carry
            advantage = pa.array(tail, mask=~some)
            v, has_v = _floats(value)
            at_row = pa.array(row)
            pos = table.column(1).to_numpy()[row] * width + at
            yield pa.RecordBatch.from_arrays([table.column(0).combine_chunks().take(at_row), pa.array(pos.astype(np.int64)), advantage, pa.array(tail + v, mask=~(some & has_v))], names=[key, "pos", "advantage", "return"])

    if c < 1e-30 or longest < width:
        joined = dealt.withColumn("after", F.lit(None).cast(DOUBLES))
    else:
        numbers = T.StructType([kind, T.StructField("pos", T.LongType()), T.StructField("x", T.DoubleType())])
        first = dealt.sortWithinPartitions(key, "_chunk").mapInArrow(heads, numbers)
        after = discounted_tails(first, key, c**width, longest // width, width)
        after = after.groupBy(key, (F.col("pos") - 1).alias("_chunk")).agg(F.collect_list(F.coalesce("tail", F.lit(0.0))).alias("after"))
        joined = dealt.join(after.hint("merge"), [key, "_chunk"], "left")
    numbers = T.StructType([kind, T.StructField("pos", T.LongType()), T.StructField("advantage", T.DoubleType()), T.StructField("return", T.DoubleType())])
    done = joined.select(key, "_chunk", "at", "value", "reward", "after").sortWithinPartitions(key, "_chunk").mapInArrow(finish, numbers)
    return done.withColumn("pos", F.col("pos").cast(pos_kind))


def returns(advantages: Column, values: Column) -> Column:
    return F.zip_with(advantages, values, lambda a, v: a + v)


def whiten(df: DataFrame, advantages: str = "advantages", mask: str = "mask") -> DataFrame:
    """Adds ``whitened``: mean 0 and variance 1 over all masked tokens of the table.

    Mean and variance are one pre-aggregated row, read as a scalar subquery.
    """
    a, m = F.col(advantages), F.col(mask)
    # The outer form: the filter that goes with the plain one would hold the Python expression.
    tokens = df.select(F.explode_outer(F.zip_with(a, m, lambda x, w: F.when(w > 0, x))).alias("x"))
    scale = F.pow(F.coalesce(F.var_pop("x"), F.lit(0.0)) + 1e-8, F.lit(-0.5))
    stats = tokens.agg(F.struct(F.coalesce(F.avg("x"), F.lit(0.0)).alias("mean"), scale.alias("scale")).alias("s"))
    placed = df.withColumn("_s", stats.scalar())
    return placed.withColumn("whitened", F.zip_with(a, m, lambda x, w: (x - F.col("_s.mean")) * F.col("_s.scale") * w)).drop("_s")


def token_mean(df: DataFrame, by: list[str], loss_sum: str = "loss_sum", n_tokens: str = "n_tokens") -> DataFrame:
    """Mean over the tokens of all rows of a group: sums by row, divided once."""
    n = F.sum(n_tokens)
    return df.groupBy(*by).agg(n.alias("n_tokens"), (F.sum(loss_sum) / F.greatest(n, F.lit(1))).alias("loss"))


def clipped_losses(new: Column, old: Column, advantages: Column, epsilon: float = 0.2) -> Column:
    """Per-token policy loss with an advantage for every token: the larger of plain and clipped."""

    def loss(ratio: Column, adv: Column) -> Column:
        return F.greatest(-adv * ratio, -adv * F.least(F.greatest(ratio, F.lit(1 - epsilon)), F.lit(1 + epsilon)))

    return F.zip_with(ratios(new, old), advantages, loss)


def k3(ref: Column, new: Column) -> Column:
    """Per-token KL estimate exp(d) - d - 1, d = ref - new."""
    return F.zip_with(ref, new, lambda r, p: F.exp(r - p) - (r - p) - F.lit(1.0))


def ratios(new: Column, old: Column) -> Column:
    return F.zip_with(new, old, lambda p, o: F.exp(p - o))


def policy_losses(
    new: Column, old: Column, ref: Column, advantage: Column, kind: str = "grpo",
    epsilon: float = 0.2, upper: float = 5.0, beta: float = 0.1,
) -> Column:
    """Per-token loss, clipped on both sides (grpo) or clamped from above (cispo)."""
    zipped = F.zip_with(
        F.zip_with(new, old, lambda p, o: F.struct(p.alias("p"), o.alias("o"))), ref, lambda z, r: z.withField("r", r)
    )

    def loss(z: Column, adv: Column) -> Column:
        ratio, diff = F.exp(z["p"] - z["o"]), z["r"] - z["p"]
        kl = F.exp(diff) - diff - F.lit(1.0)
        if kind == "cispo":
            gain = F.least(ratio, F.lit(upper)) * adv * z["p"]
        else:
            clipped = F.least(F.greatest(ratio, F.lit(1 - epsilon)), F.lit(1 + epsilon))
            gain = F.least(ratio * adv, clipped * adv)
        return -(gain - F.lit(beta) * kl)

    pair = F.struct(zipped.alias("z"), advantage.alias("a"))
    return F.transform(F.array(pair), lambda c: F.transform(c["z"], lambda z: loss(z, c["a"]))).getItem(0)


def row_losses(df: DataFrame, losses: Column, mask: Column) -> DataFrame:
    """Adds the masked loss sum and token count of each row."""
    return df.withColumns(
        {"loss_sum": total(masked(losses, mask)), "n_tokens": total_int(F.transform(mask, lambda m: m.cast("bigint")))}
    )


def mean_loss(df: DataFrame, by: list[str]) -> DataFrame:
    """Mean of row means: over rows with tokens, and over all rows (empty ones count 0)."""
    per_row = F.col("loss_sum") / F.greatest("n_tokens", F.lit(1))
    return df.groupBy(*by).agg(
        F.avg(F.when(F.col("n_tokens") > 0, per_row)).alias("valid_mean"), F.avg(per_row).alias("all_mean")
    )


def kl_sums(df: DataFrame, by: list[str], clip: float = 0.2) -> DataFrame:
    """Approximate KL, clip rate and reference KL over masked tokens."""
    new, old, ref, mask = (F.col(c) for c in ("new_logps", "old_logps", "ref_logps", "mask"))
    half = F.zip_with(new, old, lambda p, o: F.lit(0.5) * (p - o) * (p - o))
    clipped = F.transform(ratios(new, old), lambda r: F.when(F.abs(r - 1.0) > clip, 1.0).otherwise(0.0))
    rows = df.select(
        *by, total(masked(half, mask)).alias("h"), total(masked(clipped, mask)).alias("c"),
        total(masked(k3(ref, new), mask)).alias("k"), total_int(F.transform(mask, lambda m: m.cast("bigint"))).alias("n"),
    )
    n = F.greatest(F.sum("n"), F.lit(1))
    return rows.groupBy(*by).agg(
        F.sum("n").alias("n_tokens"), (F.sum("h") / n).alias("approx_kl"),
        (F.sum("c") / n).alias("clip_fraction"), (F.sum("k") / n).alias("ref_kl"),
    )


def value_loss(new_values: Column, old_values: Column, targets: Column, mask: Column, clip: float = 0.2) -> Column:
    """Half the larger of the plain and the clipped squared error, summed over the mask."""
    zipped = F.zip_with(
        F.zip_with(new_values, old_values, lambda v, o: F.struct(v.alias("v"), o.alias("o"))),
        F.zip_with(targets, mask, lambda t, m: F.struct(t.alias("t"), m.alias("m"))),
        lambda a, b: F.struct(a["v"].alias("v"), a["o"].alias("o"), b["t"].alias("t"), b["m"].alias("m")),
    )

    def one(z: Column) -> Column:
        near = F.least(F.greatest(z["v"], z["o"] - clip), z["o"] + clip)
        return F.lit(0.5) * F.greatest((z["v"] - z["t"]) * (z["v"] - z["t"]), (near - z["t"]) * (near - z["t"])) * z["m"]

    return total(F.transform(zipped, one))


def rollout_metrics(df: DataFrame, group: str = "prompt_id") -> DataFrame:
    """One row: mean reward and length, KL per token, group deviation, advantages.

    Columns read: reward, new_logps, ref_logps, mask and the group.
    """
    mask = F.col("mask")
    diff = F.zip_with("ref_logps", "new_logps", lambda r, p: r - p)
    slim = df.select(
        group, "reward", total(masked(diff, mask)).alias("kl"),
        total_int(F.transform(mask, lambda m: m.cast("bigint"))).alias("n"),
    )
    scored = group_advantages(slim, group)
    rows = scored.agg(
        F.avg("reward").alias("mean_reward"), F.avg("n").alias("mean_length"),
        (F.sum("kl") / F.greatest(F.sum("n"), F.lit(1))).alias("kl_ref"),
        F.avg("advantage").alias("advantage_mean"), F.stddev_samp("advantage").alias("advantage_std"),
    )
    spread = group_stats(slim, group).agg(F.avg("group_std").alias("s")).scalar()
    return rows.withColumn("group_std", spread)


# --- preference pairs -----------------------------------------------------------


def stack_sides(pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    """chosen and rejected as rows of one table, told apart by ``side``."""
    return pairs.select(key, F.lit("chosen").alias("side"), F.col("chosen").alias("item")).unionByName(
        pairs.select(key, F.lit("rejected").alias("side"), F.col("rejected").alias("item"))
    )


def preference_margins(sides: DataFrame, beta: float = 0.15, key: str = "pair_id") -> DataFrame:
    """Per pair: the log-ratio margin and its loss.

    ``sides`` has two rows per pair (side chosen/rejected) with policy_logps,
    ref_logps and mask; both halves meet in one aggregation of two rows.
    """
    lp = sides.select(
        key, "side", total(masked(F.col("policy_logps"), F.col("mask"))).alias("p"),
        total(masked(F.col("ref_logps"), F.col("mask"))).alias("r"),
    )
    sign = F.when(F.col("side") == "chosen", 1.0).otherwise(-1.0)
    x = F.lit(beta) * F.col("margin")
    loss = F.when(x > 0, F.log1p(F.exp(-x))).otherwise(F.log1p(F.exp(x)) - x)
    return lp.groupBy(key).agg(F.sum(sign * (F.col("p") - F.col("r"))).alias("margin")).withColumn("loss", loss)
