"""One stream over a whole stage: every new file, routed to its template.

The source (``sources.listing``) hands on files, not lines: each step holds at
most ``max_files_per_trigger`` new files, empty and hidden-named ones too, oldest
or newest first. A step's files are routed by the rules and loaded by template
side by side, as in a batch run; each file gets one history row. Files without
a route, without a template in force, or of a template whose load fails as a
whole are LOAD_FAILED with the reason, and the stream goes on.

The source's log says which files a step has, and the load ids follow the step,
so a step that is run again replaces what it landed: every file counts once.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.timing import ntz_literal
from ..operators.manifest import route_files
from ..plans.ingest import load_groups, templates_at
from ..sources.listing import StageFiles
from ..sources.loader import failed_history, write_history
from ..sources.stage import listed_as

NO_ROUTE = "No rule routes this file"


def stream_files(spark: SparkSession, stage_path: str | Sequence[str], log_path: str, *,
                 max_files_per_trigger: int = 1000, newest_first: bool = False) -> DataFrame:
    """Streaming rows ``path, modificationTime, length`` of the files that come to a stage."""
    paths = [stage_path] if isinstance(stage_path, str) else list(stage_path)
    spark.dataSource.register(StageFiles)
    return (spark.readStream.format("stage_files").option("paths", json.dumps([listed_as(spark, p) for p in paths]))
            .option("log", listed_as(spark, log_path, new=True)).option("limit", int(max_files_per_trigger))
            .option("newestfirst", str(bool(newest_first)).lower()).load())


def load_step(rules: Sequence[tuple[str, str]], templates: DataFrame, target_root: str, history_path: str, run_id: str):
    """``foreachBatch`` function: route and load the files of one step."""

    def run(files: DataFrame, step: int) -> None:
        spark, groups, unrouted = files.sparkSession, {}, {}
        # A step's file list is what the readers need; the source bounds it.
        for r in route_files(files, rules, "path").select("path", "copy_into_name").collect():
            if r["copy_into_name"] is None:
                unrouted[r["path"]] = NO_ROUTE
            else:
                groups.setdefault(r["copy_into_name"], []).append(r["path"])
        now = ntz_literal(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        parts = []
        if groups:
            parts.append(load_groups(spark, groups, templates_at(templates, now), target_root,
                                     lambda name: f"{run_id}-s{step:08d}-{name}", "continue"))
        if unrouted:
            parts.append(failed_history(spark, unrouted, None, f"{run_id}-s{step:08d}"))
        for part in parts[:1]:
            write_history(part if len(parts) == 1 else part.unionByName(parts[1]), history_path)

    return run


def start_stage_stream(spark: SparkSession, stage_path: str | Sequence[str], rules: Sequence[tuple[str, str]], templates: DataFrame, *,
                       target_root: str, history_path: str, checkpoint_path: str, run_id: str = "stage-stream",
                       max_files_per_trigger: int = 1000, newest_first: bool = False, processing_time: str = "1 minute"):
    """Start the stream; it looks for new files every ``processing_time``."""
    files = stream_files(spark, stage_path, f"{checkpoint_path.rstrip('/')}/stage-files",
                         max_files_per_trigger=max_files_per_trigger, newest_first=newest_first)
    return (files.writeStream.foreachBatch(load_step(rules, templates, target_root, history_path, run_id))
            .option("checkpointLocation", f"{checkpoint_path.rstrip('/')}/query").trigger(processingTime=processing_time).start())


def drain_stage(spark: SparkSession, *args, **options) -> None:
    """Load what is in the stage now, step by step, and stop; the next call goes on from there."""
    query = start_stage_stream(spark, *args, processing_time="0 seconds", **options)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


__all__ = ["drain_stage", "start_stage_stream", "stream_files"]
