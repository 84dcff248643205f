"""Incremental corpus pull: new files in, cleaned rows out, exactly once, with or without a limit of rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.operators.manifest import first_n
from turnloom.operators.normalize import clean_text
from turnloom.sources.jsonl import line_block, path_exists

# Bounds one micro-batch, and with it what a failed batch has to redo.
BATCH_BYTES = 64 * 1024**3


def ingest(spark: SparkSession, source: str, schema: T.StructType, out: str, checkpoint: str,
           fmt: str = "json", bytes_per_batch: int = BATCH_BYTES) -> DataFrame:
    """Cleans everything not yet pulled from ``source`` and appends it to ``out``.

    Starts a query and waits for it.  Run again later, it takes only new files;
    the checkpoint makes a restart after a failure neither lose nor repeat rows.
    """
    stream = spark.readStream.schema(schema).format(fmt).option("maxBytesPerTrigger", bytes_per_batch).load(source)
    query = (
        clean_text(stream)
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(out)


_COUNTS = "n bigint, batch_id bigint"


def _file_block() -> Column:
    """Where a streamed row is from; its place there is numbered in the micro-batch."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _taken_before(spark: SparkSession, counts: str, batch_id: int) -> int:
    if not path_exists(spark, counts):
        return 0
    before = spark.read.schema(_COUNTS).parquet(counts).where(F.col("batch_id") < batch_id)
    return before.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _capped_batch(out: str, counts: str, limit: int) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch up to the limit.

    Its rows and its count have places of their own, named by the batch and
    written anew each time, so a batch that runs again changes nothing; the count
    comes last.  Past the limit a batch is not read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        room = limit - _taken_before(spark, counts, batch_id)
        taken = 0
        if room > 0:
            placed = batch.withColumn("ord", F.struct("_at.file", "_at.block", F.monotonically_increasing_id().alias("row"))).drop("_at")
            place = f"{out}/batch_id={batch_id}"
            first_n(placed, F.col("ord"), room, line_block()).drop("ord").write.mode("overwrite").parquet(place)
            taken = spark.read.parquet(place).count()
        spark.createDataFrame([(taken,)], "n bigint").write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")

    return write


def ingest_capped(spark: SparkSession, source: str, schema: T.StructType, out: str, checkpoint: str, limit: int,
                  fmt: str = "json", **options: str | int) -> DataFrame:
    """Like ``ingest``, but at most ``limit`` cleaned rows in all, over every run with this checkpoint.

    Rows count in the order in which files are found, within a file in line
    order, and only rows that are kept count.  What a micro-batch may still take
    is the limit less what earlier ones took; only its last file block is ranked.
    """
    stream = spark.readStream.schema(schema).format(fmt).options(**options).load(source)
    counts = f"{checkpoint}/counts"
    query = (
        clean_text(stream.select("*", _file_block().alias("_at")))
        .writeStream.foreachBatch(_capped_batch(out, counts, limit)).option("checkpointLocation", f"{checkpoint}/query")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if not path_exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{out}/batch_id=*")
