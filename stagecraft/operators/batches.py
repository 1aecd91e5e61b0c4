"""Batch planning: eligible files, valid templates, claiming one batch, and the
plan of every batch a run would claim, computed as one set-based query."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.paths import stage_path_shorten
from ..schemas import LOADING, WAITING
from ..session import materialize
from .ranking import number_within

MAX_FILES_AT_ONCE = 1000


def order_columns(sort_order: str = "ASC", order_col: str = "ingestion_order",
                  path_col: str = "file_path") -> list[Column]:
    """Ingestion order in the requested direction, nulls last, path as tie-break."""
    direction = sort_order.strip().upper()
    if direction not in ("ASC", "DESC"):
        raise ValueError("sort order must be ASC or DESC")
    primary = (F.col(order_col).asc_nulls_last() if direction == "ASC"
               else F.col(order_col).desc_nulls_last())
    return [primary, F.col(path_col).asc()]


def eligible_files(control: DataFrame, tries: int) -> DataFrame:
    """Files waiting to be loaded with retries left."""
    return control.where((F.col("ingestion_status") == WAITING) & (F.col("try_count") < F.lit(tries)))


def valid_templates(templates: DataFrame, now: Column) -> DataFrame:
    """Templates in force at ``now`` (effective inclusive, superseded exclusive);
    if validity ranges overlap, the latest ``effective`` wins. One row per name."""
    live = templates.where((F.col("effective") <= now)
                           & (F.col("superseded").isNull() | (F.col("superseded") > now)))
    w = Window.partitionBy("statement_name").orderBy(F.col("effective").desc())
    return live.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def routable_files(control: DataFrame, tries: int, templates: DataFrame | None = None,
                   now: Column | None = None) -> DataFrame:
    """Eligible files with a route and, if templates are given, a template in force.

    Whether the template names are broadcast is left to the planner, which
    goes by their bytes.
    """
    files = eligible_files(control, tries).where(F.col("copy_into_name").isNotNull())
    if templates is not None:
        names = valid_templates(templates, now).select(F.col("statement_name").alias("copy_into_name"))
        files = files.join(names, "copy_into_name", "left_semi")
    return files


def unplannable_files(control: DataFrame, tries: int, templates: DataFrame, now: Column) -> DataFrame:
    """Eligible files that planning leaves out: no route, or no template in force."""
    elig = eligible_files(control, tries)
    names = valid_templates(templates, now).select(F.col("statement_name").alias("copy_into_name"))
    return (elig.join(names, "copy_into_name", "left_anti")
            .withColumn("reason", F.when(F.col("copy_into_name").isNull(), F.lit("NO_ROUTE"))
                        .otherwise(F.lit("NO_TEMPLATE"))))


def check_files_at_once(files_at_once: int) -> int:
    n = int(files_at_once)
    if n < 1 or n > MAX_FILES_AT_ONCE:
        raise ValueError(f"files_at_once must be between 1 and {MAX_FILES_AT_ONCE}")
    return n


def claim_next(control: DataFrame, *, tries: int, files_at_once: int, sort_order: str,
               run_id: str, owner_session: int, now: Column,
               templates: DataFrame | None = None) -> DataFrame:
    """Claim one batch: the first eligible file picks the template, then up to
    ``files_at_once`` eligible files of that template in order are set LOADING.

    Both picks are distributed top-k; the claimed set has at most
    ``files_at_once`` (<= 1000) rows, which bounds the broadcast.
    """
    n = check_files_at_once(files_at_once)
    order = order_columns(sort_order)
    files = routable_files(control, tries, templates, now)
    head = files.orderBy(*order).limit(1).select("copy_into_name")
    batch = (files.join(F.broadcast(head), "copy_into_name", "left_semi")
             .orderBy(*order).limit(n)
             .select("file_path", F.lit(True).alias("_claimed")))
    marked = control.join(F.broadcast(batch), "file_path", "left")
    claimed = F.col("_claimed").isNotNull()
    return marked.select(
        "file_path", "copy_into_name", "ingestion_order",
        F.when(claimed, F.lit(LOADING)).otherwise(F.col("ingestion_status")).alias("ingestion_status"),
        F.when(claimed, F.lit(owner_session).cast("long")).otherwise(F.col("owner_session")).alias("owner_session"),
        F.when(claimed, F.lit(run_id)).otherwise(F.col("exec_uuid")).alias("exec_uuid"),
        F.when(claimed, F.col("try_count") + 1).otherwise(F.col("try_count")).cast("int").alias("try_count"),
        F.when(claimed, now.cast("timestamp_ntz")).otherwise(F.col("start_time")).alias("start_time"),
        "end_time", "file_size", "error_msg")


def plan_batches(control: DataFrame, *, tries: int, files_at_once: int, sort_order: str,
                 templates: DataFrame | None = None, now: Column | None = None,
                 files_to_process: int | None = None,
                 extra_columns: tuple[str, ...] = ()) -> DataFrame:
    """Every batch that repeated ``claim_next`` would produce, as one query.

    Files are numbered per template in order (``file_rank``); each run of
    ``files_at_once`` files is a chunk; chunks are numbered by their first
    file in the global order (``batch_no``). With ``files_to_process`` only
    the first ceil(files_to_process / files_at_once) batches are kept, as
    the run's pass count. Numbering is skew-safe (see ``number_within``) and
    done once: heads and plan read the numbered rows. ``extra_columns`` are carried through from
    the manifest (the ingest job keeps every column, so it needs no join back).
    """
    n = check_files_at_once(files_at_once)
    order = order_columns(sort_order)
    base_cols = ["file_path", "copy_into_name", "ingestion_order", "try_count", "file_size"]
    carried = [c for c in extra_columns if c not in base_cols]
    files = routable_files(control, tries, templates, now).select(*base_cols, *carried)
    ranked = number_within(files, ["copy_into_name"], order, "file_rank", name="plan-rank")
    chunked = materialize(ranked.withColumn("chunk_no", F.floor((F.col("file_rank") - 1) / F.lit(n)).cast("long")),
                          "plan-chunks")
    heads = (chunked.where((F.col("file_rank") - 1) % F.lit(n) == 0)
             .select("copy_into_name", "chunk_no", "ingestion_order", "file_path"))
    batch_nos = number_within(heads, [], order, "batch_no", name="plan-heads").select(
        "copy_into_name", "chunk_no", "batch_no")
    plan = chunked.join(batch_nos, ["copy_into_name", "chunk_no"], "inner")
    if files_to_process is not None:
        passes = math.ceil(float(files_to_process) / n)
        plan = plan.where(F.col("batch_no") <= F.lit(passes))
    return plan.select("batch_no", "copy_into_name", "file_path", "ingestion_order", "file_rank",
                       "try_count", "file_size", *carried)


def quoted_short_path(path: Column | str) -> Column:
    """One entry of a batch file list: newline, quote, shortened path, quote."""
    return F.concat(F.lit("\n'"), stage_path_shorten(path), F.lit("'"))


def batch_file_lists(plan: DataFrame, templates: DataFrame | None = None,
                     now: Column | None = None) -> DataFrame:
    """Per batch: its template, file count and the ordered, comma-separated list
    of quoted shortened paths (plus the template text when templates are given).

    A batch holds at most ``files_at_once`` (<= 1000) files, so the ordered
    list is built from a bounded ``collect_list``.
    """
    entries = F.sort_array(F.collect_list(F.struct(F.col("file_rank"),
                                                   quoted_short_path("file_path").alias("entry"))))
    lists = (plan.groupBy("batch_no")
             .agg(F.min("copy_into_name").alias("copy_into_name"),
                  F.count(F.lit(1)).alias("file_count"),
                  F.array_join(F.transform(entries, lambda e: e["entry"]), ",").alias("file_list")))
    if templates is not None:
        live = valid_templates(templates, now).withColumnRenamed("statement_name", "copy_into_name")
        lists = lists.join(live.select("copy_into_name", "statement_text"), "copy_into_name", "left")
    return lists


def manifest_preview(control: DataFrame, n: int = 10, sort_order: str = "ASC") -> DataFrame:
    """First ``n`` manifest rows in ingestion order (a top-n report)."""
    return control.orderBy(*order_columns(sort_order)).limit(n)
