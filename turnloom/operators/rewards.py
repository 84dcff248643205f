"""Rule-based scores of logged responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom import constants as K
from turnloom.functions.arrays import repeat_penalty, total_int
from turnloom.functions.hooks import score_rows
from turnloom.functions.jsontext import read_calls
from turnloom.functions.text import after_first, after_last, before_first, count_of, let, lone_numbers, py_strip
from turnloom.operators.chat import call_bodies
from turnloom.operators.toolcalls import kept_calls


def clamp(score: Column, bound: float = 3.0) -> Column:
    """Within [-bound, bound]; a missing score stays missing."""
    return F.when(score.isNotNull(), F.greatest(F.lit(-bound), F.least(F.lit(bound), score)))


def has_close(text: Column) -> Column:
    return F.contains(text, F.lit(K.THINK_CLOSE))


def answer_part(text: Column) -> Column:
    """What follows the first think close tag, stripped; all of it without one."""
    return F.when(has_close(text), py_strip(after_first(text, K.THINK_CLOSE))).otherwise(text)


def turn_answer(turn: Column) -> Column:
    return py_strip(F.when(has_close(turn), after_first(turn, K.THINK_CLOSE)).otherwise(turn))


def format_score(text: Column, low: int) -> Column:
    """Length band, think length and number of close tags, on the whole response."""

    def score(t: Column) -> Column:
        size = F.length(py_strip(t))
        think = F.length(py_strip(before_first(t, K.THINK_CLOSE)))
        thought = F.when(think.between(20, 300), 1.0).otherwise(-0.5) + F.when(count_of(t, K.THINK_CLOSE) == 1, 0.25).otherwise(-0.25)
        return F.when(size.between(low, 800), 0.5).otherwise(-0.5) + F.when(has_close(t), thought).otherwise(0.0)

    return let(text, score)


def basic_reward(response: Column, model_score: Column) -> Column:
    """Format score, minus repetition in the answer, plus the model's score."""
    return format_score(response, 20) - repeat_penalty(answer_part(response)) + clamp(model_score)


def tag_imbalance(turns: Column) -> Column:
    """Sum over turns of |open - close| tool-call tags, after think is cut off."""
    gaps = F.transform(
        turns,
        lambda t: let(turn_answer(t), lambda a: F.abs(count_of(a, K.CALL_OPEN) - count_of(a, K.CALL_CLOSE)).cast("bigint")),
    )
    return total_int(gaps)


def matched_gt(text: Column, gt: Column) -> Column:
    """Expected answers found in the text, as text or as a stand-alone number."""

    def search(ctx: Column) -> Column:
        def hit(g: Column) -> Column:
            wanted = py_strip(g)
            bare = F.replace(wanted, F.lit(","), F.lit(""))
            number = F.when(bare.rlike(r"^[-+]?\p{Nd}+(?:\.\p{Nd}+)?\z"), bare.try_cast("double"))
            as_text = (wanted != "") & F.contains(ctx["low"], F.lower(wanted))
            as_number = F.exists(ctx["nums"], lambda n: F.abs(number - n) < 1e-6)
            return F.coalesce(as_text, F.lit(False)) | F.coalesce(as_number, F.lit(False))

        return F.array_distinct(F.filter(ctx["gt"], hit))

    context = F.struct(F.lower(text).alias("low"), lone_numbers(text).alias("nums"), gt.alias("gt"))
    return let(context, search)


def gt_coverage(text: Column, gt: Column) -> Column:
    """Distinct answers found over answers expected (duplicates count)."""
    return F.when(F.size(gt) > 0, F.size(matched_gt(text, gt)) / F.size(gt)).otherwise(F.lit(0.0))


def final_text(answer: Column, unfinished: Column) -> Column:
    """What is left after the last tool call; nothing if the run broke off."""
    return F.when(unfinished, F.lit("")).otherwise(after_last(answer, K.CALL_CLOSE))


def agent_rewards(trajectories: DataFrame, allowed: Column | None = None, rules: dict = K.REQUIRED_ARGS) -> DataFrame:
    """Adds n_calls, n_valid and ``reward`` to logged trajectories.

    Columns read: response, turn_outputs ARRAY<STRING>, gt ARRAY<STRING>,
    unfinished, rm_score.  ``allowed`` holds the names the sample may call (null:
    none); without it every registry tool may be called.  The registry's few rules are part of the expression, so
    the whole score is one pass without a join or a shuffle.
    """
    answers = F.transform("turn_outputs", turn_answer)
    bodies = F.flatten(F.transform("_answers", lambda a: call_bodies(a)))
    df = trajectories.withColumn("_answers", answers).withColumn("_calls", kept_calls(read_calls(bodies)))
    if allowed is not None:
        df = df.withColumn("_allowed", F.coalesce(allowed, F.array().cast("array<string>")))

    def valid(c: Column) -> Column:
        ok = F.lit(False)
        for name, rule in rules.items():
            needs = F.lit(True)
            for arg in rule["present"]:
                needs = needs & F.array_contains(c["present"], arg)
            for arg in rule["truthy"]:
                needs = needs & F.array_contains(c["truthy"], arg)
            ok = F.when(c["name"] == name, needs).otherwise(ok)
        named = F.lit(True) if allowed is None else F.array_contains("_allowed", c["name"])
        return (c["status"] == "object") & ok & named

    n_valid = F.size(F.filter("_calls", valid))
    df = df.withColumns({"n_calls": F.size("_calls"), "n_valid": n_valid})

    answer = F.coalesce(F.try_element_at("_answers", F.lit(-1)), py_strip(F.col("response")))
    tags = F.lit(0.5) * tag_imbalance(F.col("turn_outputs"))
    plain = (
        format_score(F.col("response"), 5) + F.coalesce(clamp(F.col("rm_score")), F.lit(0.0))
        - repeat_penalty(F.when(has_close(F.col("response")), py_strip(after_first(F.col("response"), K.THINK_CLOSE))).otherwise(answer))
    )
    gap = F.abs(F.col("n_valid") - F.size("gt")) + F.greatest(F.lit(0), F.col("n_calls") - F.col("n_valid"))

    def with_calls(ctx: Column) -> Column:
        last = final_text(ctx["answer"], ctx["unfinished"])
        return let(
            last,
            lambda t: F.lit(2.5) * gt_coverage(t, ctx["gt"]) - repeat_penalty(F.when(t != "", t).otherwise(ctx["answer"])),
        )

    called = (
        F.when(gap == 0, F.lit(0.5)).otherwise(F.lit(-0.5) * gap)
        + let(F.struct(answer.alias("answer"), F.col("unfinished"), F.col("gt")), with_calls)
        - F.when(F.col("unfinished"), 0.5).otherwise(0.0)
    )
    reward = clamp(F.when(F.col("n_calls") == 0, plain).otherwise(called) - tags)
    return df.withColumn("reward", reward).drop("_answers", "_calls", "_allowed")


def with_model_scores(df: DataFrame, scorer=None, messages: Column | None = None, response: Column | None = None) -> DataFrame:
    """``rm_score`` of a user's scorer (see ``hooks.score_rows``); by default the logged column stays."""
    if scorer is None:
        return df
    none = F.array().cast("array<struct<role: string, content: string>>")
    return score_rows(df, scorer, none if messages is None else messages, F.col("response") if response is None else response)
