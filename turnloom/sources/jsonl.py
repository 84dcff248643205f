"""Readers and writers of the JSON-lines files the stages exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom import constants as K
from turnloom.functions.jsontext import strict_object
from turnloom.functions.text import once, py_strip
from turnloom.operators.manifest import first_n
from turnloom.operators.normalize import listed_gt
from turnloom.operators.vocab import corpus_text
from turnloom.schemas import CHAT_ROW, CORPUS_ROW, PAIR_ROW, RL_ROW, TEXT_ROW


def _json(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Strict: a line that is not JSON or does not fit fails the job, naming the file."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_text(spark: SparkSession, path) -> DataFrame:
    return _json(spark, path, TEXT_ROW)


def read_chat(spark: SparkSession, path) -> DataFrame:
    return _json(spark, path, CHAT_ROW)


def read_pairs(spark: SparkSession, path) -> DataFrame:
    return _json(spark, path, PAIR_ROW)


def read_rl(spark: SparkSession, path) -> DataFrame:
    """Expected answers may be written as a list or as one string; they are read as a list."""
    loose = T.StructType([f if f.name != "gt" else T.StructField("gt", T.StringType()) for f in RL_ROW.fields])
    gt = F.when(F.startswith("gt", F.lit("[")), F.from_json("gt", "array<string>")).when(F.col("gt").isNotNull(), listed_gt(F.col("gt")))
    return _json(spark, path, loose).withColumn("gt", gt)


def read_with_rejects(spark: SparkSession, path, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines as text): nothing is lost and nothing fails."""
    rows = once(read_raw_lines(spark, path), "row", strict_object(F.col("value"), schema.simpleString()))
    return rows.where(F.col("row").isNotNull()).select("row.*"), rows.where(F.col("row").isNull()).select("value")


def read_snapshot(spark: SparkSession, path: str, split: str | None = None, subset: str | None = None) -> DataFrame:
    """A local copy of a published set; split and subset are partition columns."""
    df = spark.read.parquet(path)
    for name, value in (("split", split), ("subset", subset)):
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def line_order() -> Column:
    """A unique key in source order: file, block in the file, row in the block.

    A block is read by one task from start to end, so ids inside it increase.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def line_block(ord_name: str = "ord") -> Column:
    """The part of a source order that names one file block."""
    return F.struct(F.col(f"{ord_name}.file"), F.col(f"{ord_name}.block"))


def read_lines(spark: SparkSession, path, limit: int = 0) -> DataFrame:
    """Lines in source order (``ord``); ``limit`` counts lines read, good or bad."""
    lines = spark.read.text(path).select("value", line_order().alias("ord"))
    return first_n(lines, F.col("ord"), limit, line_block()) if limit else lines


def read_raw_lines(spark: SparkSession, path) -> DataFrame:
    """Lines as they are, blank ones dropped."""
    return spark.read.text(path).where(F.length(py_strip(F.col("value"))) > 0)


def read_corpus(spark: SparkSession, path, sample_limit: int = 0) -> DataFrame:
    """Texts of either corpus shape; lines that are not JSON are skipped.

    Malformed UTF-8 bytes are dropped, as a reader that ignores errors does.
    """
    fixed = F.replace(F.make_valid_utf8("value"), F.lit("\ufffd"), F.lit(""))
    value = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(fixed)
    lines = read_lines(spark, path, sample_limit).select("ord", strict_object(value, CORPUS_ROW.simpleString()).alias("r"))
    texts = once(lines, "text", corpus_text(F.col("r.conversations"), F.col("r.text")))
    return texts.where(F.col("text").isNotNull()).select("ord", "text")


def write_jsonl(df: DataFrame, path: str, force: bool = False) -> None:
    """JSON lines, characters kept as they are; refuses to replace unless forced."""
    df.write.mode("overwrite" if force else "errorifexists").json(path)


def write_parquet(df: DataFrame, path: str, force: bool = False, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite" if force else "errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stage_path(root: str, stage: str) -> str:
    return f"{root}/{next(out for name, _needs, out in K.STAGES if name == stage)}"


def stage_output(spark: SparkSession, root: str, stage: str, force: bool = False) -> str:
    """Where a stage writes.  Needs the stage before it, and a free place unless forced."""
    needs = next(needs for name, needs, _out in K.STAGES if name == stage)
    if needs and not path_exists(spark, stage_path(root, needs)):
        raise FileNotFoundError(f"{stage} needs the output of {needs}")
    path = stage_path(root, stage)
    if path_exists(spark, path) and not force:
        raise FileExistsError(f"{path} exists; pass force to replace it")
    return path


def source_catalogue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(K.SOURCES, "source string, stage string, licence string")


def catalogue_report(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Sources with the output of each stage they feed and the stage's rows; ``counts`` is (stage, n_rows).

    A stage of the catalogue names all outputs that are it or begin with it and
    an underscore, where no output has just its name.
    """
    outputs = spark.createDataFrame([(name, out) for name, _needs, out in K.STAGES], "name string, output string")
    exact = {name for name, _needs, _out in K.STAGES}
    fits = F.col("name") == F.col("stage")
    wider = ~F.col("stage").isin(*exact) & F.col("name").startswith(F.concat("stage", F.lit("_")))
    fed = source_catalogue(spark).join(outputs, fits | wider).join(counts, "stage", "left")
    return fed.select("source", "stage", "licence", "output", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def peek(df: DataFrame, chars: int = 300) -> tuple[str, str | None]:
    """Schema and the start of one row as JSON.  Starts a one-row job."""
    row = df.select(F.substring(F.to_json(F.struct("*")), 1, chars).alias("sample")).first()
    return df.schema.simpleString(), row["sample"] if row else None


def column_report(df: DataFrame) -> DataFrame:
    """Per column: type, filled rows and longest printed value over the whole table."""
    aggs = []
    for f in df.schema.fields:
        col = F.col(f.name)
        aggs += [F.count(col).alias(f"{f.name}__n"), F.max(F.length(col.cast("string"))).alias(f"{f.name}__w")]
    one = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"{f.name}__n").alias("filled"), F.col(f"{f.name}__w").cast("bigint").alias("longest"),
            )
            for f in df.schema.fields
        ]
    )
    return one.select(F.inline(rows))
