"""Streaming queries, run over all that is there, and their batch twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.operators import normalize
from turnloom.plans import tables as t
from turnloom.plans.corpus import CORPUS_CLEAN
from turnloom.session import scratch_path
from turnloom.streaming import assemble, ingest


def stream_ingest(spark, sf_dir):
    schema = t.documents(spark, sf_dir).schema
    # A pattern, because a file source wants a folder or a pattern and the table may be one file.
    rows = ingest.ingest(
        spark, f"{sf_dir}/documents*.parquet", schema, scratch_path(spark, "ingest-out"), scratch_path(spark, "ingest-checkpoint"), fmt="parquet"
    )
    return rows.select("doc_id", "source", "text")


CAPPED_ROWS = 600


def stream_capped(spark, sf_dir):
    """The first 600 cleaned documents over several micro-batches and a second run that finds more files.

    Which rows come first depends on when files are found, so the result says how
    many there are, how often one came twice, and how many are no cleaned document.
    """
    docs = t.documents(spark, sf_dir)
    feed, out, check = (scratch_path(spark, name) for name in ("feed", "capped-out", "capped-checkpoint"))
    for arrival in (0, 1):
        docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == arrival).repartition(4).write.mode("append").parquet(feed)
        rows = ingest.ingest_capped(spark, feed, docs.schema, out, check, CAPPED_ROWS, fmt="parquet", maxFilesPerTrigger=2)
    known = normalize.clean_text(docs).select("doc_id", F.col("text").alias("clean"), F.lit(1).alias("found"))
    held = rows.select("doc_id", "text").join(known, "doc_id", "left")
    return held.agg(
        F.count("*").alias("n_rows"), (F.count("*") - F.count_distinct("doc_id")).alias("n_again"),
        F.count_if(~F.col("text").eqNullSafe(F.col("clean"))).alias("n_foreign"),
    )


STREAM_CAPPED = f"select least({CAPPED_ROWS}, count(*)) as n_rows, cast(0 as bigint) as n_again, cast(0 as bigint) as n_foreign from ({CORPUS_CLEAN})"


def _assembled(spark, feed, **options):
    chunks = spark.readStream.schema(spark.read.parquet(feed).schema).options(**options).parquet(feed)
    deltas = assemble.run_assembly(chunks, scratch_path(spark, "deltas"), scratch_path(spark, "deltas-checkpoint"))
    return assemble.delta_parts(deltas).select("response_id", "part", "reasoning", "content", "n_calls", "finish_reason")


def stream_assemble(spark, sf_dir):
    """Documents as streamed pieces, put together by the stateful stream."""
    feed = scratch_path(spark, "chunks")
    t.chunks(spark, sf_dir).write.parquet(feed)
    return _assembled(spark, feed, maxBytesPerTrigger=ingest.BATCH_BYTES)


def stream_assemble_batches(spark, sf_dir):
    """The same over six micro-batches that each hold pieces of every response, out of order."""
    feed, batches = scratch_path(spark, "chunks"), 6
    chunks = t.chunks(spark, sf_dir)
    files = max(2 * batches, chunks.rdd.getNumPartitions())
    chunks.repartition(files, "seq").write.parquet(feed)
    return _assembled(spark, feed, maxFilesPerTrigger=-(-files // batches))


def chunk_assemble(spark, sf_dir):
    """The batch twin of the stream."""
    return assemble.response_parts(t.chunks(spark, sf_dir))


# A part is 1024 pieces of 64 characters; the tag, where there is one, lies in the first.
_PART = 1024 * 64
_TEXTS = f"""{t.MARKED_SQL}, m as (select doc_id as response_id, text, instr(text, '</think>') as tag_at, (length(text) - 1) // {_PART} as last_part from marked where text <> ''),
x as (select *, unnest(range(0, last_part + 1)) as part from m)"""
_SPLIT = f"""response_id, part,
  case when response_id % 4 >= 2 then '' when tag_at = 0 then substr(text, part * {_PART} + 1, {_PART}) when part = 0 then substr(text, 1, tag_at - 1) else '' end as reasoning,
  case when response_id % 4 >= 2 then substr(text, part * {_PART} + 1, {_PART}) when tag_at = 0 then ''
    when part = 0 then ltrim(substr(text, tag_at + 8, {_PART} - tag_at - 7), chr(10)) else substr(text, part * {_PART} + 1, {_PART}) end as content"""
CHUNK_ASSEMBLE = f"with {_TEXTS} select {_SPLIT} from x"
STREAM_ASSEMBLE = f"""with {_TEXTS} select {_SPLIT}, cast(case when response_id % 3 = 0 and part = last_part then 1 else 0 end as bigint) as n_calls,
  case when part < last_part then null when response_id % 3 = 0 then 'tool_calls' else 'stop' end as finish_reason from x"""

QUERIES = {
    "stream_ingest": (stream_ingest, CORPUS_CLEAN),
    "stream_capped": (stream_capped, STREAM_CAPPED),
    "stream_assemble": (stream_assemble, STREAM_ASSEMBLE),
    "stream_assemble_batches": (stream_assemble_batches, STREAM_ASSEMBLE),
    "chunk_assemble": (chunk_assemble, CHUNK_ASSEMBLE),
}
