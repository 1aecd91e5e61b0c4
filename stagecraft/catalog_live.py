"""Registered queries of the live figures: the same results as the scans, from streams of change records.

The manifest of the fixtures is written as a run would leave it: all files
WAITING, then claimed, then with their results. The streams read that in steps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from . import fixtures as fx
from .schemas import LOADING, LOAD_HISTORY_SCHEMA, WAITING
from .session import work_dir
from .sources.loader import write_history
from .sources.tables import ManifestStore
from .streaming.live import live_load_stats, live_progress_eta, live_stuck_files, start_live_stats, start_stuck_alerts

#: As in the scan that this stands beside.
STUCK_MINUTES = 60
#: Files of one step: a few, so that records of one file come in different steps.
STEP_FILES = 4


def recorded(spark, sf):
    """(root, store) of the fixture manifest with its change records, and its load history."""
    root, control = work_dir(spark, "live"), fx.fixture(spark, sf, "control")
    none = {"start_time": "timestamp_ntz", "end_time": "timestamp_ntz", "exec_uuid": "string", "error_msg": "string"}
    waiting = control.withColumns({"ingestion_status": F.lit(WAITING), "try_count": F.lit(0), **{c: F.lit(None).cast(t) for c, t in none.items()}})
    store = ManifestStore.create(spark, f"{root}/manifest", waiting)
    moved = control.where(F.col("ingestion_status") != WAITING)
    store.append_changes(moved.withColumn("ingestion_status", F.lit(LOADING)))
    store.append_changes(control)
    history, types = fx.fixture(spark, sf, "history"), {f.name: f.dataType for f in LOAD_HISTORY_SCHEMA.fields}
    known = {c: F.col(c) for c in history.columns} | {"load_id": F.lit("fixture")}
    write_history(history.select([known.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()]), f"{root}/history")
    return root, store


def _finished(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _stats(spark, sf):
    root, store = recorded(spark, sf)
    _finished(start_live_stats(spark, store, f"{root}/history", f"{root}/stats", checkpoint_path=f"{root}/checkpoint",
                               max_files_per_trigger=STEP_FILES, available_now=True))
    return f"{root}/stats"


def q_live_load_stats(spark, sf):
    return live_load_stats(spark, _stats(spark, sf))


def q_live_progress_eta(spark, sf):
    return live_progress_eta(spark, _stats(spark, sf), F.expr(fx.now_sql("spark")), 12)


def q_live_stuck_files(spark, sf):
    """Alerts of a watch whose clock has come to the fixtures' time in two ticks."""
    root, store = recorded(spark, sf)
    now = dt.datetime.fromisoformat(fx.NOW)
    for name, at in (("0", now - dt.timedelta(days=1)), ("1", now)):
        spark.range(1).select(F.lit(at.isoformat(" ")).cast("timestamp_ntz").alias("at")).write.parquet(f"{root}/ticks/part={name}")
    ticks = spark.readStream.schema("at timestamp_ntz, part string").parquet(f"{root}/ticks")
    query = start_stuck_alerts(spark, store, ticks, f"{root}/alerts", checkpoint_path=f"{root}/checkpoint", minutes=STUCK_MINUTES,
                               max_files_per_trigger=STEP_FILES, processing_time="0 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return live_stuck_files(spark, f"{root}/alerts", F.expr(fx.now_sql("spark")))


QUERIES = {"live_load_stats": q_live_load_stats, "live_progress_eta": q_live_progress_eta, "live_stuck_files": q_live_stuck_files}
