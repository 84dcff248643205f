"""Row clean-up and schema unification (projections, filters, rejects)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.constants import CHAT_ROLES, TOOL_DIALOG_ROLES
from turnloom.functions.text import last_number, once, py_strip, truthy
from turnloom.schemas import MSG_DDL, MSG_FIELDS


def clean_text(df: DataFrame, col: str = "text") -> DataFrame:
    """Strip the text and drop rows that are then empty."""
    return once(df, "_clean", py_strip(F.coalesce(F.col(col), F.lit("")))).where(F.col("_clean") != "").withColumn(col, F.col("_clean")).drop("_clean")


def concat_sources(*named: tuple[str, DataFrame]) -> DataFrame:
    """UNION ALL of several sources, each row tagged with where it came from."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in named]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def message(role: Column, content: Column, **extra: Column) -> Column:
    """One message struct of text columns; fields not given are null."""
    given = {"role": role, "content": content, **extra}
    return F.struct(*[given[f].alias(f) if f in given else F.expr(f"cast(null as string) as {f}") for f in MSG_FIELDS])


def empty_messages() -> Column:
    return F.array().cast(f"array<{MSG_DDL}>")


def map_role(tag: Column, roles: dict[str, str]) -> Column:
    """Known tags by table, everything else (also null) speaks as the user."""
    out = F.lit("user")
    for name, role in roles.items():
        if role != "user":
            out = F.when(tag == name, role).otherwise(out)
    return out


def _plain(m: Column) -> Column:
    return message(
        m["role"], m["content"],
        reasoning_content=m["reasoning_content"], tools=m["tools"], tool_calls=m["tool_calls"],
    )


def _tagged(roles: dict[str, str]):
    return lambda m: message(map_role(m["from"], roles), F.coalesce(m["value"], F.lit("")))


Shape = tuple[Column, Callable[[], Column]]


def chat_shapes() -> list[Shape]:
    """(test, message list) per row shape, in the order tried.  A user may extend it."""
    conv, msgs = F.col("conversations"), F.col("messages")
    first = F.get(conv, F.lit(0))
    instruction, output = truthy(F.col("instruction")), truthy(F.col("output"))

    def said(m: Column) -> Column:
        return message(F.coalesce(m["role"], F.lit("user")), F.coalesce(m["content"], F.lit("")))

    def asked_and_answered() -> Column:
        extra = truthy(F.col("input"))
        asked = F.when(extra.isNull(), instruction).otherwise(F.concat(instruction, F.lit("\n\n"), extra))
        return F.array(message(F.lit("user"), asked), message(F.lit("assistant"), output))

    return [
        (first["role"].isNotNull() & first["content"].isNotNull(), lambda: F.transform(conv, _plain)),
        (first["from"].isNotNull(), lambda: F.transform(conv, _tagged(CHAT_ROLES))),
        (F.coalesce(F.size(msgs) > 0, F.lit(False)), lambda: F.transform(msgs, said)),
        (instruction.isNotNull() & output.isNotNull(), asked_and_answered),
    ]


def no_shape(shapes: Sequence[Shape] | None = None) -> Column:
    """Reject reason of rows that fit no shape; reads no message texts."""
    fits = [F.coalesce(test, F.lit(False)) for test, _build in shapes or chat_shapes()]
    return F.when(~reduce(or_, fits), "no_shape")


def unify_chat(df: DataFrame, shapes: Sequence[Shape] | None = None, out: str = "conversation") -> DataFrame:
    """Adds the message list; null where no shape fits (the caller splits rejects)."""
    return once(df, out, F.coalesce(*[F.when(test, build()) for test, build in shapes or chat_shapes()]))


def unify_tool_dialog(df: DataFrame) -> DataFrame:
    """Adds ``conversation`` and ``dialog_tools``.

    Either list column may carry either message shape; the first that does wins.
    Only the role/content shape reads ``functions``.
    """
    listed = F.coalesce(truthy(F.col("tools")), truthy(F.col("functions")))
    shapes, tools = [], []
    for name in ("conversations", "messages"):
        first = F.get(F.col(name), F.lit(0))
        plain, tagged = first["role"].isNotNull(), first["from"].isNotNull()
        shapes += [F.when(plain, F.transform(name, _plain)), F.when(tagged, F.transform(name, _tagged(TOOL_DIALOG_ROLES)))]
        tools += [(plain, listed), (tagged, truthy(F.col("tools")))]
    chosen = F.lit(None).cast("string")
    for fits, value in reversed(tools):
        chosen = F.when(fits, value).otherwise(chosen)
    return once(df.withColumn("dialog_tools", chosen), "conversation", F.coalesce(*shapes))


def attach_tools(conversation: Column, tools: Column) -> Column:
    """Tools go on the first system message; without one, a blank one is put first."""

    def place(conv: Column) -> Column:
        at = F.array_position(F.transform(conv, lambda m: F.coalesce(m["role"], F.lit(""))), "system")
        marked = F.transform(
            F.zip_with(conv, F.transform(conv, lambda _m, i: i + 1 == at), lambda m, hit: F.struct(m.alias("m"), hit.alias("hit"))),
            lambda p: F.when(p["hit"], p["m"].withField("tools", tools)).otherwise(p["m"]),
        )
        fresh = F.array(message(F.lit("system"), F.lit(""), tools=tools))
        return F.when(at > 0, marked).otherwise(F.concat(fresh, conv))

    placed = F.transform(F.array(conversation), place).getItem(0)
    return F.when(truthy(tools).isNull(), conversation).otherwise(placed)


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rejected rows carry the reason, accepted ones do not."""
    marked = df.withColumn("reject_reason", reason)
    return (
        marked.where(F.col("reject_reason").isNull()).drop("reject_reason"),
        marked.where(F.col("reject_reason").isNotNull()),
    )


def accept_report(df: DataFrame, reason: Column, by: str = "source") -> DataFrame:
    """Rows kept and skipped per source; pre-aggregated before the shuffle."""
    flagged = df.select(by, reason.alias("why"))
    return flagged.groupBy(by).agg(
        F.count_if(F.col("why").isNull()).alias("accepted"),
        F.count_if(F.col("why").isNotNull()).alias("skipped"),
        (F.count_if(F.col("why").isNull()) == 0).alias("all_skipped"),
    )


def pair_reason(chosen: Column, rejected: Column) -> Column:
    """A preference row needs a message list on both sides."""
    return F.when(chosen.isNull() | rejected.isNull(), "side_missing")


def first_filled(*cols: Column) -> Column:
    """The first text that is neither null nor empty, else ''."""
    return F.coalesce(*[truthy(c) for c in cols], F.lit(""))


def last_assistant(conversation: Column) -> Column:
    said = F.filter(conversation, lambda m: m["role"] == "assistant")
    return F.coalesce(F.try_element_at(said, F.lit(-1))["content"], F.lit(""))


def math_reason(question: Column, solution: Column, answer: Column) -> Column:
    return (
        F.when(question == "", "no_question").when(solution == "", "no_solution").when(answer == "", "no_number")
    )


def math_rows(df: DataFrame, question: Column, solution: Column) -> DataFrame:
    """Adds question, solution and the number the solution ends on."""
    return once(df.withColumns({"question": question, "solution": solution}), "gt", last_number(F.col("solution")))


def listed_gt(gt: Column) -> Column:
    """The written answer as a list: '' is no answer, anything else is one."""
    return F.when(truthy(gt).isNull(), F.array().cast("array<string>")).otherwise(F.array(gt))
