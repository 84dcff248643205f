"""Samples, epoch order, batches, ranks, rollouts per prompt."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from turnloom.operators import chat, manifest
from turnloom.plans import stages
from turnloom.plans import tables as t
from turnloom.plans.sqltext import order_key
from turnloom.session import scratch_path


def rlaif_sample(spark, sf_dir):
    """A pool of 300 prompts out of all documents."""
    return manifest.sample_n(t.documents(spark, sf_dir), "doc_id", 300, seed=42).select("doc_id", "text")


RLAIF_SAMPLE = f"select doc_id, text from documents order by {order_key(42, 0, 'doc_id')}, doc_id limit 300"


def _placed(epochs):
    return " union all ".join(
        f"select {e} as epoch, doc_id, row_number() over (order by {order_key(42 + e, e, 'doc_id')}, doc_id) - 1 as pos from documents" for e in range(epochs)
    )


def _manifest_sql(epochs, size, world, accumulate, skip=0):
    steps = f"(select cast(ceil(ceil(count(*) / {float(world)}) / {float(size)}) as bigint) from documents)"
    return f"""with placed as ({_placed(epochs)}),
b as (select *, cast(pos % {world} as integer) as rank, cast(floor(floor(pos / {float(world)}) / {float(size)}) as bigint) as batch_id from placed),
s as (select *, {steps} as steps, batch_id + 1 as step from b where batch_id >= case when epoch = 0 then {skip} else 0 end)
select epoch, doc_id, pos, rank, batch_id, step, cast(floor((step - 1) / {float(accumulate)}) as bigint) as update_id,
  round(1000.0::double * (0.1::double + 0.45::double * (1.0::double + cos({math.pi!r}::double * (epoch * steps + step) / (steps * {epochs})))), 6) as rate_milli from s"""


def _select(df):
    return df.select("epoch", "doc_id", "pos", "rank", "batch_id", "step", "update_id", F.round("rate", 6).alias("rate_milli"))


def epoch_manifest(spark, sf_dir):
    """Two epochs, batches of 32, 8 steps per update."""
    return _select(manifest.epoch_manifest(t.documents(spark, sf_dir), "doc_id", 32, epochs=2, accumulate=8, base_rate=1000.0))


EPOCH_MANIFEST = _manifest_sql(2, 32, 1, 8)


def resume_manifest(spark, sf_dir):
    """Two ranks after one: step 10 of the old run is step 5 of the new one."""
    skip = manifest.resume_step(10, 1, 2)
    return _select(manifest.epoch_manifest(t.documents(spark, sf_dir), "doc_id", 16, epochs=2, world=2, skip=skip, accumulate=4, base_rate=1000.0))


RESUME_MANIFEST = _manifest_sql(2, 16, 2, 4, skip=5)


def rank_shards(spark, sf_dir):
    """Rows, characters and batches that each of 4 ranks gets in one epoch."""
    placed = manifest.shuffled_positions(t.documents(spark, sf_dir).select("doc_id", "n_chars"), "doc_id", 42, 0)
    dealt = manifest.batches(placed, 16, world=4)
    return dealt.groupBy("rank").agg(
        F.count("*").alias("n_rows"), F.sum("n_chars").alias("n_chars"), F.max(F.col("batch_id") + 1).alias("n_batches")
    )


RANK_SHARDS = f"""with placed as (select doc_id, n_chars, row_number() over (order by {order_key(42, 0, 'doc_id')}, doc_id) - 1 as pos from documents)
select cast(pos % 4 as integer) as rank, count(*) as n_rows, cast(sum(n_chars) as bigint) as n_chars,
  max(cast(floor(floor(pos / 4.0) / 16.0) as bigint)) + 1 as n_batches from placed group by 1"""


def prompt_expand(spark, sf_dir):
    """Six generations per user turn, and each joined back to its prompt by number."""
    asked = t.conversations(spark, sf_dir).where(F.col("role") == "user").select("conv_id", "turn", F.length("text").alias("n_chars"))
    gens = manifest.expand_generations(asked, 6)
    return gens.select("conv_id", "turn", "gen", F.col("n_chars").cast("bigint").alias("n_chars"))


PROMPT_EXPAND = """select conv_id, turn, cast(g as integer) as gen, length(text) as n_chars
from (select *, unnest(range(0, 6)) as g from conversations where role = 'user')"""

def rollout_prompts(spark, sf_dir):
    """Three rollouts per user turn, numbered, then joined to their prompts."""
    prompts = t.conversations(spark, sf_dir).where(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("prompt_no"), F.col("text").alias("prompt")
    )
    rollouts = manifest.expand_generations(prompts.select("prompt_no"), 3).select((F.col("prompt_no") * 3 + F.col("gen")).alias("idx"))
    return manifest.prompts_of(rollouts, prompts, 3).select("idx", "prompt_no", "prompt")


ROLLOUT_PROMPTS = """select (conv_id * 1000 + turn) * 3 + g as idx, conv_id * 1000 + turn as prompt_no, text as prompt
from (select *, unnest(range(0, 3)) as g from conversations where role = 'user')"""


def training_set(spark, sf_dir):
    """Two epochs of encoded conversations stored for two ranks; rank 1 goes on at batch 2."""
    parts = chat.assemble_parts(t.conversations(spark, sf_dir))
    chats = parts.select(F.concat_ws("-", "conv_id", "part").alias("row_id"), F.col("messages").alias("conversations"))
    path = scratch_path(spark, "training")
    stages.write_training_set(stages.training_rows(chats, "row_id", 256, 8, epochs=2, world=2), path)
    rows = stages.read_training_set(spark, path, rank=1, from_batch=2)
    sizes = [F.size(c).cast("bigint").alias(n) for c, n in (("ids", "n_ids"), ("labels", "n_labels"))]
    return rows.select("epoch", "rank", "batch_id", "pos", "row_id", *sizes)


TRAINING_SET = "with parts as (select distinct conv_id || '-' || (turn // 1024) as row_id from conversations), placed as (" + " union all ".join(
    f"select {e} as epoch, row_id, row_number() over (order by {order_key(42 + e, e, 'row_id')}, row_id) - 1 as pos from parts" for e in range(2)
) + """), dealt as (select *, cast(pos % 2 as integer) as rank, pos // 2 // 8 as batch_id from placed)
select epoch, rank, batch_id, pos, row_id, cast(256 as bigint) as n_ids, cast(256 as bigint) as n_labels from dealt where rank = 1 and (epoch > 0 or batch_id >= 2)"""

QUERIES = {
    "rollout_prompts": (rollout_prompts, ROLLOUT_PROMPTS),
    "rlaif_sample": (rlaif_sample, RLAIF_SAMPLE),
    "epoch_manifest": (epoch_manifest, EPOCH_MANIFEST),
    "resume_manifest": (resume_manifest, RESUME_MANIFEST),
    "rank_shards": (rank_shards, RANK_SHARDS),
    "training_set": (training_set, TRAINING_SET),
    "prompt_expand": (prompt_expand, PROMPT_EXPAND),
}
