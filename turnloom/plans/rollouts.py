"""Numbers over logged rollouts: advantages, KL, losses, margins, packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.functions import arrays
from turnloom.functions.text import once
from turnloom.operators import diagnostics, tokens, trajectories
from turnloom.plans import tables as t
from turnloom.session import spread


def _six(*names):
    return [F.round(n, 6).alias(n) for n in names]


def eos_cut(spark, sf_dir):
    """Mask up to and including the first EOS inside it."""
    rows = t.logged_tokens(spark, sf_dir)
    mask = diagnostics.first_eos_mask(F.col("ids"), F.col("mask"))
    return rows.select("sample_id", F.array_join(mask, "").alias("mask"), diagnostics.response_length(F.col("ids"), F.col("mask")).alias("n_tokens"))


EOS_CUT = f"""with {t.TOKENS_SQL}, e as (select sample_id, min(i) filter (where id = 2 and m = 1) as at from toks group by sample_id),
c as (select t.sample_id, t.i, case when e.at is not null and t.i > e.at then 0 else m end as m from toks t join e on e.sample_id = t.sample_id)
select sample_id, string_agg(cast(m as varchar), '' order by i) as mask, cast(sum(m) as bigint) as n_tokens from c group by sample_id"""


def _advantages(spark, sf_dir):
    """Advantages over the tokens up to the first EOS; values elsewhere count as 0."""
    rows = spread(t.logged_tokens(spark, sf_dir))
    rows = rows.withColumn("mask", diagnostics.first_eos_mask(F.col("ids"), F.col("mask")))
    rows = rows.withColumn("values", arrays.masked(F.col("values"), F.col("mask")))
    rewards = diagnostics.terminal_rewards(F.col("mask"), F.col("reward"))
    return once(rows, "advantages", diagnostics.advantage_estimator()(F.col("values"), rewards))


def gae(spark, sf_dir):
    """Generalised advantages and returns per token, from the end of each row."""
    rows = _advantages(spark, sf_dir).withColumn("returns", diagnostics.returns(F.col("advantages"), F.col("values")))
    flat = rows.select("sample_id", F.posexplode(F.arrays_zip("advantages", "returns")).alias("pos", "z"))
    return flat.select("sample_id", "pos", F.round("z.advantages", 6).alias("advantage"), F.round("z.returns", 6).alias("return"))


# The sum form of the recurrence: discounted errors of all later tokens.
GAE_BODY = f"""{t.TOKENS_SQL}, ends as (select sample_id, min(i) filter (where id = 2 and m = 1) as at from toks group by sample_id),
cut as (select t.* exclude (m, v), cm as m, v * cm as v, max(case when cm = 1 then t.i end) over (partition by t.sample_id) as last_i
  from (select toks.*, case when ends.at is not null and toks.i > ends.at then 0 else m end as cm from toks join ends on toks.sample_id = ends.sample_id) t),
d as (select *, case when i = last_i then reward else 0.0::double end + coalesce(lead(v) over (partition by sample_id order by i), 0.0::double) - v as delta from cut),
adv as (select a.sample_id, a.i, a.m, a.v, a.reward, a.prompt_id, a.new_lp, a.old_lp, sum(b.delta * pow(0.95::double, b.i - a.i)) as adv from d a join d b on a.sample_id = b.sample_id and b.i >= a.i group by all)"""
GAE = f"with {GAE_BODY} select sample_id, cast(i as integer) as pos, round(adv, 6) as advantage, round(adv + v, 6) as return from adv"


def gae_long(spark, sf_dir):
    """Advantages of documents as trajectories of their words, in long form, 64 steps a chunk."""
    words = t.documents(spark, sf_dir).select("doc_id", F.split("text", " ").alias("w"))
    steps = words.select("doc_id", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word"))
    last = F.when(F.col("pos") == F.col("n") - 1, F.pmod("doc_id", F.lit(10)) / F.lit(10.0)).otherwise(0.0)
    steps = steps.select("doc_id", "pos", F.log(F.length("word") + F.lit(2.0)).alias("value"), last.alias("reward"))
    out = diagnostics.long_advantages(steps, "doc_id", width=64)
    return out.select("doc_id", "pos", *[F.round(c, 6).alias(c) for c in ("advantage", "return")])


GAE_LONG = """with w as (select doc_id, string_split(text, ' ') as w from documents),
s as (select doc_id, len(w) as n, unnest(w) as word, unnest(range(0, len(w))) as i from w),
d as (select doc_id, i, ln(length(word) + 2.0::double) as v, case when i = n - 1 then (doc_id % 10) / 10.0::double else 0.0::double end
  + coalesce(lead(ln(length(word) + 2.0::double)) over (partition by doc_id order by i), 0.0::double) - ln(length(word) + 2.0::double) as delta from s),
a as (select doc_id, i, v, sum(delta * pow(0.95::double, i)) over (partition by doc_id order by i desc rows between unbounded preceding and current row) / pow(0.95::double, i) as adv from d)
select doc_id, cast(i as integer) as pos, round(adv, 6) as advantage, round(adv + v, 6) as return from a"""


def whitened(spark, sf_dir):
    """Advantages with mean 0 and variance 1 over all masked tokens."""
    rows = diagnostics.whiten(_advantages(spark, sf_dir))
    return rows.select("sample_id", F.posexplode("whitened").alias("pos", "x")).select("sample_id", "pos", F.round(F.col("x") + 0.0, 5).alias("whitened"))


WHITENED = f"""with {GAE_BODY}, s as (select sum(adv * m) / sum(m) as mu from adv), q as (select sum((adv - mu) * (adv - mu) * m) / sum(m) as var from adv, s)
select sample_id, cast(i as integer) as pos, round((adv - mu) / sqrt(var + 1e-8::double) * m + 0.0::double, 5) as whitened from adv, s, q"""


def masked_kl(spark, sf_dir):
    """Approximate KL, clip rate and reference KL over masked tokens, per prompt."""
    out = diagnostics.kl_sums(t.logged_tokens(spark, sf_dir), ["prompt_id"], clip=0.05)
    return out.select("prompt_id", "n_tokens", *_six("approx_kl", "clip_fraction", "ref_kl"))


MASKED_KL = f"""with {t.TOKENS_SQL} select prompt_id, cast(sum(m) as bigint) as n_tokens, round(sum(0.5::double * (new_lp - old_lp) * (new_lp - old_lp) * m) / sum(m), 6) as approx_kl,
  round(sum(case when abs(exp(new_lp - old_lp) - 1.0::double) > 0.05::double then m else 0 end)::double / sum(m), 6) as clip_fraction,
  round(sum((exp(ref_lp - new_lp) - (ref_lp - new_lp) - 1.0::double) * m) / sum(m), 6) as ref_kl from toks group by prompt_id"""


def policy_loss(spark, sf_dir):
    """Masked mean losses per prompt: clipped and clamped, over filled rows and over all."""
    rows = t.logged_tokens(spark, sf_dir)
    cut = diagnostics.first_eos_mask(F.col("ids"), F.col("mask"))
    rows = rows.withColumn("cut", F.when(F.col("sample_id") % 17 == 0, F.transform("mask", lambda _m: F.lit(0))).otherwise(cut))
    rows = diagnostics.group_advantages(rows.select("prompt_id", "reward", "new_logps", "old_logps", "ref_logps", "cut"))
    logps = [F.col(c) for c in ("new_logps", "old_logps", "ref_logps", "advantage")]
    sums = [
        F.struct(F.lit(kind).alias("kind"), arrays.total(arrays.masked(diagnostics.policy_losses(*logps, kind), F.col("cut"))).alias("loss_sum"))
        for kind in ("grpo", "cispo")
    ]
    per_row = rows.select("prompt_id", tokens.label_coverage(F.col("cut")).alias("n_tokens"), F.inline(F.array(*sums)))
    return diagnostics.mean_loss(per_row, ["prompt_id", "kind"]).select("prompt_id", "kind", *_six("valid_mean", "all_mean"))


_CUT_SQL = f"""{t.TOKENS_SQL}, e as (select sample_id, min(i) filter (where id = 2 and m = 1) as at from toks group by sample_id),
g as (select prompt_id, avg(reward) as mu, stddev_pop(reward) as sd from (select distinct sample_id, prompt_id, reward from toks) group by prompt_id),
c as (select t.*, (reward - mu) / (sd + 0.0001::double) as adv, case when t.sample_id % 17 = 0 or (e.at is not null and t.i > e.at) then 0 else m end as cm
  from toks t join e on e.sample_id = t.sample_id join g on g.prompt_id = t.prompt_id)"""


def _loss_sql(kind: str, gain: str) -> str:
    return f"""select prompt_id, '{kind}' as kind, round(avg(case when n > 0 then s / n end), 6) as valid_mean, round(avg(s / greatest(n, 1)), 6) as all_mean
from (select prompt_id, sample_id, sum(cm) as n, sum(-({gain} - 0.1::double * (exp(ref_lp - new_lp) - (ref_lp - new_lp) - 1.0::double)) * cm) as s from c group by prompt_id, sample_id) group by prompt_id"""


POLICY_LOSS = (
    f"with {_CUT_SQL} "
    + _loss_sql("grpo", "least(exp(new_lp - old_lp) * adv, least(greatest(exp(new_lp - old_lp), 0.8::double), 1.2::double) * adv)")
    + " union all "
    + _loss_sql("cispo", "least(exp(new_lp - old_lp), 5.0::double) * adv * new_lp")
)


def value_loss(spark, sf_dir):
    """Clipped value loss per prompt, a mean over tokens, with returns as targets."""
    rows = _advantages(spark, sf_dir).withColumn("targets", diagnostics.returns(F.col("advantages"), F.col("values")))
    new = F.transform("values", lambda v: v * 0.5)
    loss = diagnostics.value_loss(new, F.col("values"), F.col("targets"), F.col("mask"), clip=0.05)
    per_row = rows.select("prompt_id", loss.alias("loss_sum"), tokens.label_coverage(F.col("mask")).alias("n_tokens"))
    return diagnostics.token_mean(per_row, ["prompt_id"]).select("prompt_id", "n_tokens", *_six("loss"))


VALUE_LOSS = f"""with {GAE_BODY}, z as (select prompt_id, m, v * 0.5::double as nv, v, adv + v as tgt from adv),
n as (select *, least(greatest(nv, v - 0.05::double), v + 0.05::double) as near from z)
select prompt_id, cast(sum(m) as bigint) as n_tokens, round(sum(0.5::double * greatest((nv - tgt) * (nv - tgt), (near - tgt) * (near - tgt)) * m) / greatest(sum(m), 1), 6) as loss from n group by prompt_id"""


def ppo_loss(spark, sf_dir):
    """Clipped policy loss per prompt, a mean over tokens, with an advantage for every token."""
    rows = _advantages(spark, sf_dir)
    loss = diagnostics.clipped_losses(F.col("new_logps"), F.col("old_logps"), F.col("advantages"))
    per_row = diagnostics.row_losses(rows, loss, F.col("mask"))
    return diagnostics.token_mean(per_row, ["prompt_id"]).select("prompt_id", "n_tokens", *_six("loss"))


PPO_LOSS = f"""with {GAE_BODY}, z as (select prompt_id, m, adv, exp(new_lp - old_lp) as ratio from adv)
select prompt_id, cast(sum(m) as bigint) as n_tokens, round(sum(greatest(-adv * ratio, -adv * least(greatest(ratio, 0.8::double), 1.2::double)) * m) / greatest(sum(m), 1), 6) as loss from z group by prompt_id"""


def rollout_metrics(spark, sf_dir):
    out = diagnostics.rollout_metrics(t.logged_tokens(spark, sf_dir))
    return out.select(*_six("mean_reward", "mean_length", "kl_ref", "advantage_std", "group_std"), F.round(F.abs("advantage_mean"), 6).alias("advantage_mean"))


ROLLOUT_METRICS = f"""with {t.TOKENS_SQL}, s as (select sample_id, prompt_id, reward, sum(m) as n, sum((ref_lp - new_lp) * m) as kl from toks group by all),
g as (select prompt_id, avg(reward) as mu, stddev_pop(reward) as sd from s group by prompt_id), a as (select s.*, (reward - mu) / (sd + 0.0001::double) as adv from s join g on g.prompt_id = s.prompt_id)
select round(avg(reward), 6) as mean_reward, round(avg(n), 6) as mean_length, round(sum(kl) / sum(n), 6) as kl_ref, round(abs(avg(adv)), 6) as advantage_mean,
  round(stddev_samp(adv), 6) as advantage_std, (select round(avg(sd), 6) from g) as group_std from a"""


def label_coverage(spark, sf_dir):
    """Tokens with loss per prompt; rows without any are counted apart."""
    rows = t.logged_tokens(spark, sf_dir).select("prompt_id", tokens.label_coverage(F.col("mask")).alias("n"))
    return rows.groupBy("prompt_id").agg(F.sum("n").alias("n_loss"), F.count_if(F.col("n") > 0).alias("rows_with_loss"))


LABEL_COVERAGE = f"""with {t.TOKENS_SQL}, s as (select sample_id, prompt_id, sum(m) as n from toks group by all)
select prompt_id, cast(sum(n) as bigint) as n_loss, count(*) filter (where n > 0) as rows_with_loss from s group by prompt_id"""


def dpo_margin(spark, sf_dir):
    """Log-ratio margin and loss of pairs of logged sequences."""
    rows = t.logged_tokens(spark, sf_dir)
    side = F.when(F.col("sample_id") % 2 == 0, "chosen").otherwise("rejected")
    sides = rows.select(
        F.floor(F.col("sample_id") / 2).cast("bigint").alias("pair_id"), side.alias("side"),
        F.col("new_logps").alias("policy_logps"), "ref_logps", "mask",
    )
    return diagnostics.preference_margins(sides).select("pair_id", *_six("margin", "loss"))


DPO_MARGIN = f"""with {t.TOKENS_SQL}, x as (select sample_id // 2 as pair_id, sum(case when sample_id % 2 = 0 then 1 else -1 end * (new_lp - ref_lp) * m) as margin from toks group by 1)
select pair_id, round(margin, 6) as margin, round(-ln(1.0::double / (1.0::double + exp(-0.15::double * margin))), 6) as loss from x"""


def dpo_mean_loss(spark, sf_dir):
    out = dpo_margin(spark, sf_dir)
    return out.agg(F.count("*").alias("n_pairs"), F.round(F.avg("loss"), 5).alias("mean_loss"))


DPO_MEAN_LOSS = f"with p as ({DPO_MARGIN}) select count(*) as n_pairs, round(avg(loss), 5) as mean_loss from p"


def _turns(spark, sf_dir):
    """Documents as logged trajectories: a prompt, two generated turns and an observation.

    A token id is a word's length plus 3; even rows end their first turn on EOS
    and repeat it at the start of the observation.
    """
    rows = spread(t.documents(spark, sf_dir)).select("doc_id", F.transform(F.split("text", " "), lambda w: F.length(w) + 3).alias("ids"))
    rows = rows.withColumn("q", F.floor(F.size("ids") / 4).cast("int"))
    eos = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(2))).otherwise(F.array().cast("array<int>"))
    cut = lambda a, n: F.slice("ids", a + 1, n)
    rows = rows.withColumns(
        {
            "prompt_ids": cut(F.lit(0), F.col("q")), "one": F.concat(cut(F.col("q"), F.col("q")), eos),
            "obs": F.concat(eos, cut(F.col("q") * 2, F.col("q"))), "two": cut(F.col("q") * 3, F.size("ids")),
        }
    )
    logps = lambda c: F.transform(c, lambda x: x * -0.125)
    turn = lambda new, obs: F.struct(F.col(new).alias("new_ids"), logps(new).alias("new_logps"), obs.alias("obs_ids"))
    return rows.select("doc_id", "prompt_ids", F.array(turn("one", F.col("obs")), turn("two", F.array().cast("array<int>"))).alias("turns"))


def pack_trajectories(spark, sf_dir):
    """Prompt, generated and observed tokens as one sequence of at most 2500."""
    rows = trajectories.pack(trajectories.assemble(_turns(spark, sf_dir), F.col("turns")))
    return rows.select(
        "doc_id", F.array_join("ids", ",").alias("ids"), F.array_join("mask", "").alias("mask"), F.col("prompt_len").cast("bigint").alias("prompt_len"),
        F.size("old_logps").cast("bigint").alias("n_logps"), F.round(arrays.total(F.col("old_logps")), 4).alias("logp_sum"),
    )


PACK_TRAJECTORIES = """with w as (select doc_id, list_transform(string_split(text, ' '), lambda x: length(x) + 3) as l from documents),
q as (select *, len(l) // 4 as q, doc_id % 2 = 0 as even from w),
p as (select doc_id, q, even, l[1:q] as pr, l[q+1:2*q] as one, l[2*q+1:3*q] as obs, l[3*q+1:len(l)] as two from q),
s as (select doc_id, list_concat(pr, one, case when even then [2] else [] end, obs, two) as ids,
  list_concat(list_transform(pr, lambda x: 0), list_transform(one, lambda x: 1), case when even then [0] else [] end, list_transform(obs, lambda x: 0), list_transform(two, lambda x: 1)) as mask,
  list_concat(list_transform(range(0, greatest(len(pr) - 1, 0)), lambda x: 0.0::double), list_transform(list_concat(one, case when even then [2] else [] end), lambda x: x * -0.125::double),
    list_transform(obs, lambda x: 0.0::double), list_transform(two, lambda x: x * -0.125::double)) as lp from p),
c as (select doc_id, ids[greatest(len(ids) - 2500, 0) + 1 : len(ids)] as ids, mask[greatest(len(mask) - 2500, 0) + 1 : len(mask)] as mask,
  case when len(ids) > 2500 then lp[greatest(len(lp) - 2499, 0) + 1 : len(lp)] else lp end as lp from s)
select doc_id, array_to_string(ids, ',') as ids, array_to_string(mask, '') as mask, coalesce(nullif(list_position(mask, 1), 0) - 1, len(mask)) as prompt_len,
  len(lp) as n_logps, round(coalesce(list_sum(lp), 0.0::double), 4) as logp_sum from c"""


def logp_repair(spark, sf_dir):
    """As many log-probs as ids: zeros in front of short lists, the tail of long ones."""
    rows = t.logged_tokens(spark, sf_dir)
    ids = F.slice("ids", 1, F.pmod("sample_id", F.lit(64)).cast("int") + 1)
    logps = F.slice("new_logps", 1, F.pmod(F.col("sample_id") * 5, F.lit(64)).cast("int") + 1)
    fixed = tokens.repair_logps(logps, ids)
    return rows.select("sample_id", F.size(fixed).cast("bigint").alias("n"), F.round(F.element_at(fixed, 1), 6).alias("first"), F.round(arrays.total(fixed), 6).alias("total"))


LOGP_REPAIR = f"""with {t.TOKENS_SQL}, s as (select sample_id, vec_id % 64 + 1 as k, (vec_id * 5) % 64 + 1 as have, list(new_lp order by i) as l from toks group by all),
f as (select sample_id, k, case when have >= k then l[have - k + 1 : have] else list_concat(list_transform(range(0, k - have), lambda x: 0.0::double), l[1 : have]) end as l from s)
select sample_id, k as n, round(l[1], 6) as first, round(list_sum(l), 6) as total from f"""

QUERIES = {
    "eos_cut": (eos_cut, EOS_CUT),
    "gae": (gae, GAE),
    "gae_long": (gae_long, GAE_LONG),
    "whitened": (whitened, WHITENED),
    "masked_kl": (masked_kl, MASKED_KL),
    "policy_loss": (policy_loss, POLICY_LOSS),
    "value_loss": (value_loss, VALUE_LOSS),
    "ppo_loss": (ppo_loss, PPO_LOSS),
    "rollout_metrics": (rollout_metrics, ROLLOUT_METRICS),
    "label_coverage": (label_coverage, LABEL_COVERAGE),
    "dpo_margin": (dpo_margin, DPO_MARGIN),
    "dpo_mean_loss": (dpo_mean_loss, DPO_MEAN_LOSS),
    "pack_trajectories": (pack_trajectories, PACK_TRAJECTORIES),
    "logp_repair": (logp_repair, LOGP_REPAIR),
}
