"""The ingest job: check arguments and duplicates, plan every batch once, then
load the batches in order until the files, the pass count or the time runs
out, recording each file's outcome in the manifest.

The claim loop of a one-batch-at-a-time loader becomes one planning query
(``plan_batches``) plus a driver loop over *waves*: consecutive batches
loaded together, one Spark job per template in the wave. A wave of one batch
reproduces the batch-by-batch behaviour exactly; larger waves amortise job
start-up and give each job thousands of files to spread over the cluster.
Per wave, only the touched manifest rows are written (claim, then result),
the target gets one partition per (wave, template), and the history one
row per file.
"""

from __future__ import annotations

import datetime as dt
import math
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.timing import ntz_literal
from ..operators.batches import plan_batches, routable_files, valid_templates
from ..operators.manifest import count_duplicates
from ..operators.transitions import claim_rows, recover_results
from ..schemas import CONTROL_COLUMNS, RUN_SUMMARY_SCHEMA, WAITING
from ..session import literal_rows, materialize
from ..sources.loader import LoadTemplate, failed_history, load_files, load_results, read_history, write_history
from ..sources.tables import ManifestStore

# Argument rules and their messages (the first failing rule wins).
MSG_FILES_TO_PROCESS = "FILES_TO_PROCESS parameter must be greater than 0,"
MSG_FILES_AT_ONCE = "FILES_AT_ONCE parameter must be between 1 and 1000."
MSG_SORT_ORDER = "SORT_ORDER must be 'ASC' or 'DESC' only."
MSG_MAX_RUN_MINUTES = "MAX_RUN_MINUTES must be greater than 0."
MSG_TRIES = "TRIES must be one or greater."
NO_ERRORS = "No_Errors"
MSG_DUPLICATES = "There are duplicate files in the control table. De-duplicate before running."

ALL_DONE = "Processed_All_Waiting_Files"
TIME_LIMIT = "Time_Limit"
FILE_LIMIT = "File_Limit"
PASS_LIMIT = "Pass_Limit"

# Loads of different templates in one wave that may run at the same time.
MAX_PARALLEL_TEMPLATES = 8


def check_parameters(files_to_process, files_at_once, sort_order, max_run_minutes, tries) -> str:
    if files_to_process <= 0:
        return MSG_FILES_TO_PROCESS
    if files_at_once < 1 or files_at_once > 1000:
        return MSG_FILES_AT_ONCE
    if str(sort_order).strip().upper() not in ("ASC", "DESC"):
        return MSG_SORT_ORDER
    if max_run_minutes <= 0:
        return MSG_MAX_RUN_MINUTES
    if tries < 1:
        return MSG_TRIES
    return NO_ERRORS


def _cores(spark: SparkSession) -> int:
    """Task slots of the cluster (the configured default without a SparkContext)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - e.g. a Connect session
        return int(spark.conf.get("spark.default.parallelism", "8") or 8)


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _stamp(t: dt.datetime) -> str:
    return t.strftime("%Y-%m-%d %H:%M:%S")


@dataclass
class RunSummary:
    parameter_error: str | None = None
    duplicate_files_error: str | None = None
    session_id: int | None = None
    start_time: str | None = None
    termination_reason: str | None = None
    files_processed: int | None = None
    end_time: str | None = None
    uuid: str | None = None

    def to_df(self, spark: SparkSession) -> DataFrame:
        return literal_rows(spark, [(self.parameter_error, self.duplicate_files_error, self.session_id,
                                     self.start_time, self.termination_reason, self.files_processed,
                                     self.end_time, self.uuid)], RUN_SUMMARY_SCHEMA)


@dataclass
class IngestRun:
    summary: RunSummary
    history_path: str
    target_root: str
    waves: int = 0
    batches: int = 0


def templates_at(templates: DataFrame, now: Column) -> dict[str, LoadTemplate]:
    """Templates in force, one per name. The template table is configuration
    (a row per load statement), so it is read on the driver."""
    return {r["statement_name"]: LoadTemplate.from_row(r) for r in valid_templates(templates, now).collect()}


def file_ingest(spark: SparkSession, store: ManifestStore, templates: DataFrame, *,
                target_root: str, history_path: str, sort_order: str = "ASC",
                files_to_process: int = 1000, files_at_once: int = 100, max_run_minutes: float = 60,
                tries: int = 3, run_id: str | None = None, owner_session: int | None = None,
                wave_files: int | None = None, clock=None, on_template_error: str = "stop") -> IngestRun:
    """Run one ingest job over the manifest in ``store``; see the module text.

    ``wave_files`` bounds the files of one wave (default: one batch, or about
    four files per core when that is more). Before each wave the run looks at
    what others have recorded since it planned and leaves out files that are
    no longer WAITING (the kill switch). Change records are folded into a new
    base by ``ManifestStore.compact`` while no run is active. ``clock`` returns the current time (tests pass a fixed one).
    ``on_template_error``: "stop" ends the run at the first template whose load
    fails as a whole; "continue" marks that template's files of the wave
    LOAD_FAILED with the error and goes on, so one bad template holds up no other.
    """
    if on_template_error not in ("stop", "continue"):
        raise ValueError("on_template_error must be 'stop' or 'continue'")
    clock = clock or _utc_now
    summary = RunSummary()
    run = IngestRun(summary, history_path, target_root)
    err = check_parameters(files_to_process, files_at_once, sort_order, max_run_minutes, tries)
    if err != NO_ERRORS:
        summary.parameter_error = err
        return run
    control = store.refresh().read()
    if count_duplicates(control) > 0:
        summary.duplicate_files_error = MSG_DUPLICATES
        return run

    files_at_once = int(files_at_once)
    run_id = run_id or str(uuid.uuid4())
    summary.uuid = run_id
    summary.session_id = owner_session
    started = clock()
    summary.start_time = _stamp(started)
    deadline = time.monotonic() + float(max_run_minutes) * 60.0
    now = ntz_literal(started)
    passes = math.ceil(float(files_to_process) / files_at_once)

    # Results that an earlier run loaded but did not record.
    history = read_history(spark, history_path)
    if not control.where("exec_uuid IS NOT NULL").isEmpty() and not history.isEmpty():
        store.update(lambda c: recover_results(c, history, now))
        control = store.read()
    live = templates_at(templates, now)
    if wave_files is None:
        wave_files = max(files_at_once, 4 * _cores(spark))
    per_wave = max(1, int(wave_files) // files_at_once)

    processed, reason, batch = 0, None, 0
    while reason is None and batch < passes:
        # Every manifest column is kept: claim records are built from the plan rows.
        plan = plan_batches(control, tries=tries, files_at_once=files_at_once, sort_order=sort_order,
                            templates=templates, now=now, files_to_process=(passes - batch) * files_at_once,
                            extra_columns=tuple(CONTROL_COLUMNS))
        # One folder per wave: each wave reads its own rows, not the whole plan.
        plan = plan.withColumn("_wave", F.floor((F.col("batch_no") - 1) / F.lit(per_wave)).cast("long"))
        plan = materialize(plan, "ingest-plan", partition_by="_wave")
        planned_at, n_batches = store.seq, int(plan.agg(F.max("batch_no")).first()[0] or 0)
        if not n_batches:
            break
        done = 0
        while done < n_batches:
            lo, hi = done + 1, min(done + per_wave, n_batches)
            wave = _still_waiting(store, plan.where(F.col("_wave") == F.lit((lo - 1) // per_wave)), planned_at)
            try:
                claimed = _run_wave(spark, store, wave, live, run, run_id, owner_session, clock, batch + lo, on_template_error, planned_at)
            except Exception as e:  # noqa: BLE001 - the run reports the error and stops
                reason = "ERROR: " + str(e).split("\n")[0]
                break
            processed += claimed
            done = hi
            run.waves += 1
            if time.monotonic() >= deadline:
                reason = TIME_LIMIT
                break
        batch += done
        if reason is None:
            # Files that became WAITING meanwhile are the next plan.
            control = store.refresh().read()
            if routable_files(control, tries, templates, now).isEmpty():
                break
    run.batches = batch
    if reason is None:
        reason = PASS_LIMIT if batch >= passes else ALL_DONE
    if processed >= files_to_process and not reason.startswith("ERROR"):
        reason = FILE_LIMIT
    summary.termination_reason = reason
    summary.files_processed = processed
    summary.end_time = _stamp(clock())
    return run


def _still_waiting(store: ManifestStore, wave: DataFrame, planned_at: int) -> DataFrame:
    """The wave without the files that a record later than the plan has taken out of WAITING."""
    newer = store.refresh().latest(planned_at)
    if newer is None:
        return wave
    taken = newer.where(F.col("_c.ingestion_status") != WAITING).select(F.col("_f").alias("file_path"))
    return wave.join(taken, "file_path", "left_anti")


def _lost(store: ManifestStore, claimed: DataFrame, planned_at: int) -> set[str]:
    """Files that another run has taken out of WAITING between the last look and this run's claim, just recorded.

    The earlier record stands: it is recorded again, over this run's claim.
    Runs whose claims are written at the very same time may both miss the
    other's; then both load the file, and ``read_target`` counts one load.
    """
    mine = store.seq
    before = (store.refresh().changes(planned_at).where(F.col("seq") < mine)
              .join(claimed.select("file_path"), "file_path", "left_semi")
              .groupBy("file_path").agg(F.max_by(F.struct(*[c for c in CONTROL_COLUMNS if c != "file_path"]), "seq").alias("_c"))
              .where(F.col("_c.ingestion_status") != WAITING))
    taken = materialize(before.select("file_path", "_c.*"), "ingest-lost")
    lost = {r["file_path"] for r in taken.select("file_path").collect()}  # of one wave
    if lost:
        store.append_changes(taken)
    return lost


def load_groups(spark: SparkSession, groups: dict[str, list[str]], live: dict[str, LoadTemplate], target_root: str,
                load_id: Callable[[str], str], on_template_error: str = "stop") -> DataFrame:
    """History rows of the files of several templates, whose loads run side by side.

    Templates load into different targets, so a small one does not leave the
    cluster idle. With "continue" the files of a template that is not in force,
    or whose load fails as a whole, are LOAD_FAILED with the error.
    """
    def load(item):
        name, paths = item
        tpl = live.get(name) if on_template_error == "continue" else live[name]
        if tpl is None:
            return failed_history(spark, dict.fromkeys(paths, f"No template '{name}' is in force"), None, load_id(name))
        try:
            return load_files(spark, paths, tpl, f"{target_root}/{tpl.target}", load_id(name))
        except Exception as e:
            if on_template_error == "stop":
                raise
            lines = [x.strip() for x in str(e).splitlines() if x.strip()]
            return failed_history(spark, dict.fromkeys(paths, lines[0] if lines else type(e).__name__), tpl.target, load_id(name))

    items = list(groups.items())
    if len(items) == 1:
        histories = [load(items[0])]
    else:
        with ThreadPoolExecutor(max_workers=min(len(items), MAX_PARALLEL_TEMPLATES)) as pool:
            histories = list(pool.map(load, items))
    hist = histories[0]
    for h in histories[1:]:
        hist = hist.unionByName(h)
    return hist


def _run_wave(spark: SparkSession, store: ManifestStore, wave: DataFrame, live: dict[str, LoadTemplate],
              run: IngestRun, run_id: str, owner_session, clock, first_batch: int, on_template_error: str, planned_at: int) -> int:
    """Claim, load and record one wave; returns the number of files claimed."""
    claim_at = ntz_literal(clock())
    claimed = materialize(claim_rows(wave.select(*CONTROL_COLUMNS), run_id=run_id,
                                     owner_session=owner_session if owner_session is not None else 0, now=claim_at),
                          "ingest-claim")
    # The wave's file list goes to the readers: at most wave_files paths.
    by_template: dict[str, list[str]] = {}
    for r in claimed.select("copy_into_name", "file_path").orderBy("file_path").collect():
        by_template.setdefault(r["copy_into_name"], []).append(r["file_path"])
    if not by_template:
        return 0
    store.append_changes(claimed)
    lost = _lost(store, claimed, planned_at)
    by_template = {name: left for name, paths in by_template.items() if (left := [p for p in paths if p not in lost])}
    if not by_template:
        return 0

    hist = load_groups(spark, by_template, live, run.target_root, lambda name: f"{run_id}-b{first_batch:08d}-{name}", on_template_error)
    # The history rows are final (per-file figures were written by the loads).
    # Writing them commits the wave's loads.
    write_history(hist, run.history_path)

    done_at = ntz_literal(clock())
    res = load_results(hist)
    done = (claimed.join(res, claimed["file_path"] == res["file"], "inner")
            .select("file_path", "copy_into_name", "ingestion_order",
                    F.col("status").alias("ingestion_status"), "owner_session",
                    F.lit(None).cast("string").alias("exec_uuid"), "try_count", "start_time",
                    done_at.alias("end_time"), "file_size",
                    F.coalesce(F.col("first_error"), F.lit("")).alias("error_msg")))
    store.append_changes(done)
    return sum(len(p) for p in by_template.values())
