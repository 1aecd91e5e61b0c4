"""Continuous file ingest with Structured Streaming.

New files under a stage prefix are picked up in bounded micro-batches
(``maxFilesPerTrigger``), oldest or newest first (``latestFirst``). Each
micro-batch is parsed with the template and landed like a batch load: every
line to ``target/_load_id=<run>-s<batch id>/_kind=...`` (dynamic overwrite),
one history row per file. The source's checkpoint records which files each batch took, and
a replayed batch overwrites its own partitions, so every file is loaded
exactly once even if the query restarts. This replaces claiming files with a
status and a run id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.loader import (LoadTemplate, file_columns, load_parsed, parse_lines, parse_records,
                              reads_lines, record_reader, schema_of, write_history)


def stream_lines(spark: SparkSession, stage_path: str, *, max_files_per_trigger: int = 1000,
                 latest_first: bool = False, tpl: LoadTemplate | None = None) -> DataFrame:
    """Streaming rows of new files under ``stage_path`` with their file and split:
    text lines, or records of the template's own reader when it is not read by line."""
    reader = (spark.readStream.option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", int(max_files_per_trigger))
              .option("latestFirst", str(bool(latest_first)).lower()))
    if tpl is not None and not reads_lines(tpl):
        records = record_reader(reader, tpl, schema_of(spark, tpl.schema_ddl)).load(stage_path)
        return records.select("*", *file_columns())
    if tpl is not None and "lineSep" in tpl.options:
        reader = reader.option("lineSep", tpl.options["lineSep"])
    return reader.format("text").load(stage_path).select("value", *file_columns())


def ingest_batch(tpl: LoadTemplate, target_path: str, history_path: str, run_id: str):
    """``foreachBatch`` function: load one micro-batch, idempotently per batch id."""
    by_line = reads_lines(tpl)

    def run(batch: DataFrame, batch_id: int) -> None:
        load_id = f"{run_id}-s{batch_id:08d}"
        rows = batch.withColumn("_mid", F.monotonically_increasing_id())
        parsed = parse_lines(rows, tpl) if by_line else parse_records(rows, tpl)
        # Files of the batch are those that had rows (a stream cannot see empty files).
        hist = load_parsed(parsed, None, tpl, target_path, load_id)
        write_history(hist, history_path)

    return run


def start_stream_ingest(spark: SparkSession, stage_path: str, tpl: LoadTemplate, *, target_path: str,
                        history_path: str, checkpoint_path: str, run_id: str = "stream",
                        max_files_per_trigger: int = 1000, latest_first: bool = False,
                        available_now: bool = True, processing_time: str = "1 minute"):
    """Start the continuous ingest; ``available_now`` drains what is there and stops."""
    lines = stream_lines(spark, stage_path, max_files_per_trigger=max_files_per_trigger,
                         latest_first=latest_first, tpl=tpl)
    writer = (lines.writeStream.foreachBatch(ingest_batch(tpl, target_path, history_path, run_id))
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
