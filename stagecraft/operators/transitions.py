"""State changes of the manifest as DataFrame transforms: old snapshot -> new snapshot.

Each function only rewrites the columns the change touches; rows it does not
select pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timing import minutes_between
from ..schemas import CONTROL_COLUMNS, LOAD_FAILED, LOADING, SUSPENDED, WAITING


def _update(control: DataFrame, cond: Column, changes: dict[str, Column]) -> DataFrame:
    cols = []
    for c in CONTROL_COLUMNS:
        if c in changes:
            cols.append(F.when(cond, changes[c]).otherwise(F.col(c)).cast(control.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return control.select(*cols)


def mark_complete(control: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Record load results (file, status, first_error) on the matching files:
    status, error (empty text when none), end time; the run id is cleared.
    Results for unknown files and files without results are left alone.
    As in a merge, ``results`` holds at most one row per file (the loader
    reports each file once per load)."""
    res = results.select(F.col("file").alias("_file"), F.col("status").alias("_status"),
                         F.col("first_error").alias("_error"))
    joined = control.join(res, control["file_path"] == res["_file"], "left")
    matched = F.col("_file").isNotNull()
    out = _update(joined, matched, {
        "ingestion_status": F.col("_status"),
        "error_msg": F.coalesce(F.col("_error"), F.lit("")),
        "end_time": now.cast("timestamp_ntz"),
        "exec_uuid": F.lit(None).cast("string"),
    })
    return out


def reset_stuck(control: DataFrame, now: Column, minutes: int = 60) -> DataFrame:
    """LOADING for at least ``minutes`` (minute boundaries) -> WAITING. Tries stay spent."""
    cond = (F.col("ingestion_status") == LOADING) & (minutes_between("start_time", now) >= F.lit(minutes))
    return _update(control, cond, {"ingestion_status": F.lit(WAITING)})


def suspend(control: DataFrame) -> DataFrame:
    """Kill switch: every WAITING file -> SUSPENDED. Recorded with ``ManifestStore.update``,
    running jobs see it before their next wave and load nothing more."""
    return _update(control, F.col("ingestion_status") == WAITING, {"ingestion_status": F.lit(SUSPENDED)})


def resume(control: DataFrame) -> DataFrame:
    """Undo the kill switch: SUSPENDED -> WAITING."""
    return _update(control, F.col("ingestion_status") == SUSPENDED, {"ingestion_status": F.lit(WAITING)})


def requeue_failed(control: DataFrame, tries: int, statuses: Sequence[str] = (LOAD_FAILED,)) -> DataFrame:
    """Failed files with tries left -> WAITING, so the next run retries them."""
    cond = F.col("ingestion_status").isin(list(statuses)) & (F.col("try_count") < F.lit(tries))
    return _update(control, cond, {"ingestion_status": F.lit(WAITING)})


def recover_results(control: DataFrame, history: DataFrame, now: Column) -> DataFrame:
    """Finish files of a run that ended between its load and its record.

    A file still carries the run id of its claim, and the history has its row
    in a load of that run: the rows are in the target, so the result is
    recorded instead of loading the file again.
    """
    open_files = control.where(F.col("exec_uuid").isNotNull()).select(F.col("file_path").alias("_f"), F.col("exec_uuid").alias("_run"))
    done = (history.join(open_files, (F.col("file_name") == F.col("_f")) & F.col("load_id").startswith(F.concat("_run", F.lit("-"))))
            .groupBy("file_name").agg(F.max_by(F.struct("status", "first_error_message"), "load_id").alias("_h"))
            .select(F.col("file_name").alias("file"), F.col("_h.status").alias("status"),
                    F.col("_h.first_error_message").alias("first_error")))
    return mark_complete(control, done, now)


def claim_rows(files: DataFrame, *, run_id: str, owner_session: int, now: Column) -> DataFrame:
    """The LOADING version of the given manifest rows (used for change records)."""
    return files.select(
        "file_path", "copy_into_name", "ingestion_order",
        F.lit(LOADING).alias("ingestion_status"),
        F.lit(owner_session).cast("long").alias("owner_session"),
        F.lit(run_id).alias("exec_uuid"),
        (F.col("try_count") + 1).cast("int").alias("try_count"),
        now.cast("timestamp_ntz").alias("start_time"),
        F.col("end_time"), F.col("file_size"), F.col("error_msg"))
