"""Monitoring queries over the manifest and the load history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.paths import stage_path_shorten
from ..functions.text import progress_bar, thousands_text
from ..functions.timing import minutes_between, seconds_between
from ..schemas import LOAD_HISTORY_SCHEMA, LOADED, LOADING, WAITING

GB = 1_000_000_000
MB = 1_000_000


def loading_files(control: DataFrame) -> DataFrame:
    return control.where(F.col("ingestion_status") == LOADING)


def attempted_files(control: DataFrame) -> DataFrame:
    """Files no longer waiting, newest ingestion order first."""
    return (control.where(F.col("ingestion_status") != WAITING)
            .orderBy(F.col("ingestion_order").desc_nulls_last(), F.col("file_path")))


def error_files(control: DataFrame) -> DataFrame:
    """Files whose last attempt left an error text (null and empty text excluded)."""
    return control.where(F.col("error_msg") != "")


def stuck_files(control: DataFrame, now: Column, minutes: int = 60) -> DataFrame:
    """LOADING for more than ``minutes`` minutes, with the age in minutes."""
    return (control.where(F.col("ingestion_status") == LOADING)
            .select("file_path", minutes_between("start_time", now).alias("loading_minutes"))
            .where(F.col("loading_minutes") > F.lit(minutes)))


def active_by_owner(control: DataFrame) -> DataFrame:
    """Per session currently loading: file count and gigabytes."""
    return (control.where(F.col("ingestion_status") == LOADING)
            .groupBy("owner_session")
            .agg(F.count("file_path").alias("files_being_loaded"),
                 (F.sum("file_size") / F.lit(GB)).alias("gb_loading")))


def _keyed(control: DataFrame, history: DataFrame) -> DataFrame:
    """Manifest joined with history on the location-independent path key.

    Every key has a "/" before it in its path, so paths without one cannot
    match: that plain test filters in the scan, and the key's patterns run once.
    """
    c = control.where(F.col("file_path").contains("/")).withColumn("_key", stage_path_shorten("file_path"))
    h = history.where(F.col("file_name").contains("/")).withColumn("_key", stage_path_shorten("file_name"))
    return c.alias("C").join(h.alias("L"), "_key", "inner")


def load_stats(control: DataFrame, history: DataFrame) -> DataFrame:
    """Per status (LOADING excluded): files, GB, size figures, rows and errors."""
    j = _keyed(control, history)
    return (j.groupBy(F.col("C.ingestion_status").alias("ingestion_status"))
            .agg(F.count(F.col("C.file_path")).alias("files"),
                 (F.sum("C.file_size") / F.lit(GB)).alias("gb_loaded"),
                 (F.avg("C.file_size") / F.lit(MB)).alias("average_file_size_mb"),
                 (F.max("C.file_size") / F.lit(MB)).alias("max_file_size_mb"),
                 (F.min("C.file_size") / F.lit(MB)).alias("min_file_size_mb"),
                 F.sum("L.row_count").cast("long").alias("row_count"),
                 F.avg("L.row_count").alias("average_row_count"),
                 F.sum("L.row_parsed").cast("long").alias("row_parsed"),
                 F.sum("L.error_count").cast("long").alias("error_count"))
            .where(F.col("ingestion_status") != LOADING))


LOG_HISTORY_COLUMNS = ["file_name", "row_count", "row_parsed", "first_error_message",
                       "first_error_line_number", "first_error_character_position",
                       "first_error_col_name", "error_count"]
LOG_CONTROL_COLUMNS = ["ingestion_order", "ingestion_status", "owner_session", "exec_uuid",
                       "try_count", "start_time", "end_time", "file_size", "error_msg"]


def load_log(control: DataFrame, history: DataFrame) -> DataFrame:
    """Manifest rows beside their load history rows."""
    return log_columns(_keyed(control, history), history.columns)


def log_columns(joined: DataFrame, known: list[str]) -> DataFrame:
    """The load log's columns of manifest rows "C" joined with history rows "L"; those not ``known`` are null."""
    types = {f.name: f.dataType for f in LOAD_HISTORY_SCHEMA.fields}
    hist_cols = [F.col(f"L.{c}") if c in known else F.lit(None).cast(types[c]).alias(c)
                 for c in LOG_HISTORY_COLUMNS]
    return joined.select(F.col("C.file_path"), *hist_cols, *[F.col(f"C.{c}") for c in LOG_CONTROL_COLUMNS])


def target_counts(targets: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of target tables side by side, one column per target."""
    spark = next(iter(targets.values())).sparkSession
    cols = [t.select(F.count(F.lit(1))).scalar().alias(f"{name.lower()}_count")
            for name, t in targets.items()]
    return spark.range(1).select(*cols)


def target_counts_text(targets: Mapping[str, DataFrame]) -> DataFrame:
    counts = target_counts(targets)
    return counts.select([thousands_text(c).alias(c) for c in counts.columns])


def _percent_complete_parts(control: DataFrame) -> DataFrame:
    loaded = F.sum(F.when(F.col("ingestion_status") == LOADED, F.col("file_size")))
    return control.agg(loaded.alias("_loaded"), F.sum("file_size").alias("_all"),
                       F.min("start_time").alias("_first_start"))


def percent_complete(control: DataFrame) -> DataFrame:
    """Loaded bytes over all bytes x 100 (null when nothing is loaded)."""
    return _percent_complete_parts(control).select(
        (F.try_divide(F.col("_loaded"), F.col("_all")) * F.lit(100.0)).alias("percent_complete"))


def progress(control: DataFrame, segments: int = 100, decimals: int = 2) -> DataFrame:
    return percent_complete(control).select(progress_bar("percent_complete", decimals, segments).alias("progress"))


def progress_eta(control: DataFrame, now: Column, segments: int = 12) -> DataFrame:
    """Progress bar, GB loaded, minutes run and the linear estimate of the rest.

    One pass over the manifest (conditional aggregates) instead of one
    scalar subquery per figure.
    """
    return eta_columns(_percent_complete_parts(control), now, segments)


def eta_columns(parts: DataFrame, now: Column, segments: int) -> DataFrame:
    """The figures of ``progress_eta`` from loaded bytes, all bytes and the first start."""
    pct = F.try_divide(F.col("_loaded"), F.col("_all")) * F.lit(100.0)
    secs = seconds_between(F.col("_first_start"), now).cast("double")
    running = F.round(secs / F.lit(60.0))
    total = F.round(secs * F.try_divide(F.lit(100.0), pct) / F.lit(60.0))
    return parts.select(
        progress_bar(pct, 2, segments).alias("progress"),
        (F.col("_loaded") / F.lit(GB)).alias("gigabytes_loaded"),
        running.alias("running_minutes"),
        total.alias("estimated_total_runtime_minutes"),
        (total - running).alias("estimated_minutes_remaining"))
