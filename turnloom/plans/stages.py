"""The stages that prepare data files, each from a local snapshot to one output.

A stage refuses to replace its output unless forced; ``limit`` counts accepted
rows in source order, 0 is all.  Every stage returns its accept/skip counts,
which Spark collects while it writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from turnloom.functions.bpe import encoder
from turnloom.functions.draws import draw_key
from turnloom.functions.text import truthy
from turnloom.operators import chat, manifest, normalize, tokens
from turnloom.schemas import MSG_DDL, RAW_CHAT_ROW
from turnloom.sources import jsonl

REPEATS = 1 << 16
_LOOSE_LIST = RAW_CHAT_ROW["messages"].dataType
_TYPES = {"conversations": _LOOSE_LIST, "messages": _LOOSE_LIST, "chosen": f"array<{MSG_DDL}>", "rejected": f"array<{MSG_DDL}>"}


def read_source(spark: SparkSession, path: str, columns: list[str], fmt: str = "json", split: str | None = None, as_text: tuple[str, ...] = ()) -> DataFrame:
    """A snapshot with the columns a stage looks at (missing ones null) and the source order.

    ``broken`` holds a JSON line that does not parse or does not fit, else null.

    Columns in ``as_text`` may hold text or anything else, which then comes as JSON.
    """
    if fmt == "json":
        fields = ", ".join(f"{c} {t if isinstance(t, str) else t.simpleString()}" for c in columns for t in ["string" if c in as_text else _TYPES.get(c, "string")])
        # Field names of the loose messages include a keyword, hence back quotes.
        fields = fields.replace("from:", "`from`:") + ", broken string"
        df = spark.read.schema(fields).option("columnNameOfCorruptRecord", "broken").json(path)
    else:
        df = jsonl.read_snapshot(spark, path, split)
        df = df.withColumns({c: F.to_json(c) for c in as_text if c in df.columns and dict(df.dtypes)[c] != "string"})
    missing = {c: F.lit(None).cast("string" if c in as_text else _TYPES.get(c, "string")) for c in [*columns, "broken"] if c not in df.columns}
    return df.withColumns(missing).select(*columns, "broken", jsonl.line_order().alias("ord"))


def _write(df: DataFrame, reason: Column, build, columns: list[str], path: str, limit: int, force: bool) -> dict:
    """Accepted rows, built and written; counts are observed on the way.

    ``skipped`` counts rows that fit no rule, ``broken`` lines that do not parse.
    With a limit, both count what lies before the last accepted row.
    """
    seen = Observation()
    marked = df.withColumn("why", F.when(reason.isNotNull() & F.col("broken").isNotNull(), "broken").otherwise(reason))
    if limit:
        cut = manifest.nth_key(df.where(reason.isNull()), F.col("ord"), limit, jsonl.line_block())
        marked = marked.where(cut.isNull() | (F.col("ord") <= cut))
    marked = marked.observe(
        seen, F.count_if(F.col("why").isNull()).alias("accepted"), F.count_if(F.col("why") != "broken").alias("skipped"),
        F.count_if(F.col("why") == "broken").alias("broken"),
    )
    jsonl.write_jsonl(build(marked.where(F.col("why").isNull())).select(*columns), path, force)
    return dict(seen.get)


def pretrain(spark, root: str, encyclopedia: str, web: str | None = None, limit: int = 0, web_limit: int = 1_000_000,
             fmt: str = "json", force: bool = False) -> dict:
    """Encyclopedia texts, and web texts after them when given."""
    path = jsonl.stage_output(spark, root, "pretrain_full" if web else "pretrain_mini", force)

    def texts(source: str, n: int) -> DataFrame:
        rows = normalize.clean_text(read_source(spark, source, ["text"], fmt))
        return manifest.first_n(rows, F.col("ord"), n, jsonl.line_block()) if n else rows

    rows = texts(encyclopedia, limit)
    if web:
        rows = rows.unionByName(texts(web, web_limit))
    seen = Observation()
    jsonl.write_jsonl(rows.observe(seen, F.count(F.lit(1)).alias("accepted")).select("text"), path, force)
    return dict(seen.get)


def sft(spark, root: str, source: str, limit: int = 0, fmt: str = "json", force: bool = False) -> dict:
    path = jsonl.stage_output(spark, root, "sft", force)
    rows = read_source(spark, source, ["conversations", "messages", "instruction", "input", "output"], fmt)
    build = lambda df: normalize.unify_chat(df).withColumn("conversations", F.col("conversation"))
    return _write(rows, normalize.no_shape(), build, ["conversations"], path, limit, force)


def dpo(spark, root: str, source: str, limit: int = 0, fmt: str = "json", force: bool = False) -> dict:
    path = jsonl.stage_output(spark, root, "dpo", force)
    rows = read_source(spark, source, ["chosen", "rejected"], fmt)
    return _write(rows, normalize.pair_reason(F.col("chosen"), F.col("rejected")), lambda df: df, ["chosen", "rejected"], path, limit, force)


def rlaif(spark, root: str, n: int = 10000, seed: int = 42, force: bool = False) -> dict:
    """A sample of the SFT output, lines kept as they are."""
    path = jsonl.stage_output(spark, root, "rlaif", force)
    lines = jsonl.read_raw_lines(spark, jsonl.stage_path(root, "sft"))
    # Equal lines stay separate rows: the key is the line's text and which of its equals it is, whatever the layout.
    counted = lines.groupBy("value").agg(F.count("*").alias("n"))
    # A line that is repeated more often than a block of numbers holds is dealt to many tasks.
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / F.lit(REPEATS)).cast("bigint"))).alias("b")
    few, many = counted.where(F.col("n") <= REPEATS), counted.where(F.col("n") > REPEATS)
    dealt = few.select("value", "n", F.lit(0).cast("bigint").alias("b")).unionByName(many.select("value", "n", blocks).repartition("b"))
    numbers = F.sequence(F.col("b") * REPEATS + 1, F.least("n", (F.col("b") + 1) * REPEATS))
    each = dealt.select("value", F.explode(numbers).alias("k"))
    keyed = each.select("value", F.concat_ws(":", F.md5("value"), "k").alias("row_id"))
    picked = manifest.sample_n(keyed, "row_id", n, seed)
    picked.select("value").write.mode("overwrite" if force else "errorifexists").text(path)
    return {"accepted": spark.read.text(path).count()}


def agent_rl(spark, root: str, source: str, limit: int = 0, fmt: str = "json", force: bool = False) -> dict:
    """Tool dialogs with their tools on the system message; no expected answer."""
    path = jsonl.stage_output(spark, root, "agent_rl", force)
    rows = normalize.unify_tool_dialog(read_source(spark, source, ["conversations", "messages", "tools", "functions"], fmt))
    placed = normalize.attach_tools(F.col("conversation"), F.col("dialog_tools"))
    build = lambda df: df.withColumn("conversations", placed).withColumn("gt", normalize.listed_gt(F.lit("")))
    return _write(rows, F.when(F.col("conversation").isNull(), "no_shape"), build, ["conversations", "gt"], path, limit, force)


def agent_rl_math(spark, root: str, source: str, limit: int = 0, fmt: str = "json", force: bool = False) -> dict:
    """Questions with the number their solution ends on."""
    path = jsonl.stage_output(spark, root, "agent_rl_math", force)
    cols = ["question", "prompt", "instruction", "chosen_text", "chosen", "output", "answer"]
    rows = read_source(spark, source, cols, fmt, as_text=("chosen",))
    turns = F.from_json("chosen", f"array<{MSG_DDL}>")
    said = F.when(F.size(turns) > 0, normalize.last_assistant(turns)).when(~F.ltrim("chosen").startswith("["), truthy(F.col("chosen")))
    solution = F.coalesce(said, normalize.first_filled(F.col("chosen_text"), F.col("output"), F.col("answer")))
    rows = normalize.math_rows(rows, normalize.first_filled(F.col("question"), F.col("prompt"), F.col("instruction")), solution)
    reason = normalize.math_reason(F.col("question"), F.col("solution"), F.col("gt"))
    one = F.array(normalize.message(F.lit("user"), F.col("question")))
    build = lambda df: df.withColumn("conversations", one).withColumn("gt", normalize.listed_gt(F.col("gt")))
    return _write(rows, reason, build, ["conversations", "gt"], path, limit, force)


def training_rows(chats: DataFrame, row_id: str, max_length: int = 768, batch_size: int = 16, epochs: int = 1, world: int = 1,
                  skip: int = 0, seed: int = 42, vocab: list[str] | None = None, merges: list[tuple[str, str]] | None = None) -> DataFrame:
    """(epoch, rank, batch_id, pos) with token ids and labels of every sample.

    Rendering and its random decisions are functions of (seed, epoch, id), so the
    rows do not depend on layout, and a failed task redoes the same rows.  Write
    them partitioned by epoch and rank for any trainer to read.
    """
    placed = manifest.epoch_manifest(chats, row_id, batch_size, epochs, seed, world, skip)
    joined = placed.join(chats.select(row_id, "conversations"), row_id)
    key = draw_key(seed, F.col("epoch"), F.col(row_id))
    messages = chat.inject_system(F.col("conversations"), key, seed=str(seed))
    prompts = joined.withColumn("prompt", chat.render_chat(messages))
    prompts = prompts.withColumn("prompt", chat.drop_empty_think(F.col("prompt"), key, seed=str(seed)))
    encode = encoder(vocab, merges, max_length)
    rows = prompts.withColumn("ids", tokens.fixed_length(encode(F.col("prompt")), max_length))
    opening, closing = tokens.answer_marks(vocab, merges)
    rows = rows.withColumn("labels", tokens.answer_labels(opening, closing, max_length)(F.col("ids")))
    return rows.select("epoch", "rank", "batch_id", "pos", row_id, "ids", "labels")


def write_training_set(rows: DataFrame, path: str, force: bool = False) -> None:
    """Stores ``training_rows``: a folder per epoch and rank, batches in order.

    Rows are dealt to tasks by ranges of (epoch, rank, batch), so a file holds
    neighbouring batches, and its statistics tell which.
    """
    order = ["epoch", "rank", "batch_id", "pos"]
    ranged = rows.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    ranged.write.mode("overwrite" if force else "errorifexists").partitionBy("epoch", "rank").parquet(path)


def read_training_set(spark: SparkSession, path: str, rank: int, epoch: int = 0, from_batch: int = 0) -> DataFrame:
    """What a rank reads that goes on at a batch of an epoch.

    Other ranks' and earlier epochs' folders are not listed for reading; files and
    row groups that end before the batch are skipped by their statistics.
    """
    stored = spark.read.parquet(path).where(F.col("rank") == rank)
    first = stored.where((F.col("epoch") == epoch) & (F.col("batch_id") >= from_batch))
    return first.unionByName(stored.where(F.col("epoch") > epoch))
