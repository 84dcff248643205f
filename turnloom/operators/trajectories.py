"""Assembling and packing logged multi-turn trajectories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom import constants as K
from turnloom.functions.arrays import keep_last


def _observed(turn: Column, eos: int) -> Column:
    """Observation ids without an EOS that the generated ids already end on."""
    repeated = (F.try_element_at(turn["new_ids"], F.lit(-1)) == eos) & (F.get(turn["obs_ids"], F.lit(0)) == eos)
    rest = F.slice(turn["obs_ids"], F.lit(2), F.greatest(F.size(turn["obs_ids"]), F.lit(1)))
    return F.when(F.coalesce(repeated, F.lit(False)), rest).otherwise(turn["obs_ids"])


def response_arrays(turns: Column, eos: int = K.EOS_ID) -> dict[str, Column]:
    """Turns (new_ids, new_logps, obs_ids) -> ids, mask and log-probs of the response.

    Generated tokens have mask 1 (0 at EOS) and their log-prob; observed ones 0.
    """
    return {
        "response_ids": F.flatten(F.transform(turns, lambda t: F.concat(t["new_ids"], _observed(t, eos)))),
        "response_mask": F.flatten(
            F.transform(
                turns,
                lambda t: F.concat(
                    F.transform(t["new_ids"], lambda x: F.when(x == eos, 0).otherwise(1)),
                    F.transform(_observed(t, eos), lambda _x: F.lit(0)),
                ),
            )
        ),
        "response_logps": F.flatten(
            F.transform(turns, lambda t: F.concat(t["new_logps"], F.transform(_observed(t, eos), lambda _x: F.lit(0.0))))
        ),
    }


def assemble(df: DataFrame, turns: Column, eos: int = K.EOS_ID) -> DataFrame:
    return df.withColumns(response_arrays(turns, eos))


def pack(df: DataFrame, max_total_len: int = 2500) -> DataFrame:
    """Prompt and response as one sequence, its last ``max_total_len`` tokens.

    Adds ids, mask, old_logps (one fewer: no log-prob for the first token) and
    prompt_len, the index of the first generated token.
    """
    zeros = F.transform("prompt_ids", lambda _x: F.lit(0))
    lead = F.array_repeat(F.lit(0.0), F.greatest(F.size("prompt_ids") - 1, F.lit(0)))
    whole = df.withColumns(
        {
            "ids": F.concat("prompt_ids", "response_ids"),
            "mask": F.concat(zeros, "response_mask"),
            "old_logps": F.concat(lead, "response_logps"),
        }
    )
    cut = F.size("ids") > max_total_len
    out = whole.withColumns(
        {
            "old_logps": F.when(cut, keep_last(F.col("old_logps"), max_total_len - 1)).otherwise(F.col("old_logps")),
            "ids": keep_last(F.col("ids"), max_total_len),
            "mask": keep_last(F.col("mask"), max_total_len),
        }
    )
    at = F.array_position("mask", 1)
    return out.withColumn("prompt_len", F.when(at > 0, at - 1).otherwise(F.size("mask")).cast("int"))


def is_unfinished(turn_outputs: Column, n_calls_last: Column, max_turns: int = 3) -> Column:
    """The last allowed turn still asked for a tool."""
    return (F.size(turn_outputs) == max_turns) & (n_calls_last > 0)
