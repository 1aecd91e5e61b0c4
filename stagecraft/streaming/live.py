"""Live figures of a manifest: statistics and stuck files from its change records, never from a scan.

``start_live_stats`` reads a store's base and change records, and the load
history, as streams. A stateful operator keeps, by path key, the files of that
key with their latest record, and the history rows that join them. What
a new record changes goes out as differences: the old contribution is taken
back, the new one added. A step's differences are added up by status and size
(and by start time) and written under the step's number, so a step that is run
again replaces itself; every ``FOLD`` steps the sums so far are written as one
table. ``live_load_stats`` and ``live_progress_eta`` read those sums: they equal
``load_stats`` and ``progress_eta`` over the manifest at the last step.

``start_stuck_alerts`` keeps each file's start and the moment from which it
counts as stuck. A timer fires when the stream's time, which clock ticks carry
on, has passed that; a later record of the file clears it.

Keys are dealt into ``BUCKETS`` buckets. A bucket is one state (packed columns)
and one call a step, which handles all its new records at once: a call for each
key costs more than the work on it.

A record with a lower number than the one known for its file changes nothing,
so the order in which records arrive does not matter.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.paths import stage_path_shorten
from ..functions.timing import minutes_between
from ..operators.monitor import GB, MB, eta_columns
from ..schemas import LOAD_HISTORY_SCHEMA, LOADED, LOADING, control_schema
from ..session import hadoop_path, path_exists
from ..sources.tables import ManifestStore

#: Steps after which the sums are written as one table.
FOLD = 50
#: States that the keys are dealt into. A checkpoint belongs to one number of them.
BUCKETS = 512
_SUMS = ("files", "pairs", "row_count", "row_count_n", "row_parsed", "row_parsed_n", "error_count", "error_count_n")
_DELTA = "ingestion_status string, file_size long, start_time timestamp_ntz, " + ", ".join(f"{c} long" for c in _SUMS)
_KEYS = ("ingestion_status", "file_size", "start_time")
_HISTORY = ("row_count", "row_parsed", "error_count")


def _folder(spark: SparkSession, path: str) -> str:
    """The folder, made if need be: a stream can begin before its first file."""
    jpath, fs = hadoop_path(spark, path)
    fs.mkdirs(jpath)
    return path


def change_stream(spark: SparkSession, store: ManifestStore, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming manifest records with their numbers: the base as number 0, then every change record."""
    order = store.base().schema["ingestion_order"].dataType
    schema, reader = control_schema(order), spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    base = reader.schema(schema).parquet(store._base(store.epoch)).withColumn("seq", F.lit(0).cast("long"))
    numbered = T.StructType([*schema.fields, T.StructField("seq", T.LongType())])
    changes = reader.schema(numbered).parquet(_folder(spark, store._changes(store.epoch)))
    return base.select("file_path", "ingestion_status", "file_size", "start_time", "seq").unionByName(
        changes.select("file_path", "ingestion_status", "file_size", "start_time", "seq"))


def history_stream(spark: SparkSession, history_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows of the load history."""
    reader = spark.readStream.schema(LOAD_HISTORY_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(_folder(spark, history_path)).select("file_name", "load_id", *_HISTORY)


_FILES = pa.schema([("_key", pa.string()), ("file_path", pa.string()), ("ingestion_status", pa.string()), ("file_size", pa.int64()),
                    ("start_time", pa.timestamp("us")), ("seq", pa.int64()), ("joins", pa.bool_())])
_LOADS = pa.schema([("_key", pa.string()), ("file_path", pa.string()), ("load_id", pa.string()), *[(c, pa.int64()) for c in _HISTORY]])
_WATCHED = pa.schema([("file_path", pa.string()), ("seq", pa.int64()), ("start_time", pa.timestamp("us")), ("told", pa.bool_())])


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _arrived(frames: list[pd.DataFrame], schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([schema.empty_table(), *[pa.Table.from_pandas(f[schema.names], schema, preserve_index=False) for f in frames]])


def _first_of(table: pa.Table, keys: list[str]) -> pa.Table:
    """The first row of each key (null is a key)."""
    numbered = table.append_column("_at", pa.array(np.arange(table.num_rows)))
    return table.take(numbered.group_by(keys, use_threads=False).aggregate([("_at", "min")])["_at_min"])


def _newest(table: pa.Table) -> pa.Table:
    """Each file's row with the highest number; of equal ones the first."""
    return _first_of(table.take(pc.sort_indices(table, [("seq", "descending")])), ["file_path"])


def _split(table: pa.Table, column: str, values) -> tuple[pa.Table, pa.Table]:
    """Rows with and without one of the values."""
    hit = pc.is_in(table[column], value_set=pc.unique(values))
    return table.filter(hit), table.filter(pc.invert(hit))


def contributions(files: pa.Table, loads: pa.Table) -> pa.Table:
    """Sums by (status, size, start) of files and of their pairs with the history rows of their key."""
    per_key = loads.group_by("_key", use_threads=False).aggregate(
        [([], "count_all"), *[(c, how) for c in _HISTORY for how in ("sum", "count")]])
    rows = files.join(per_key, "_key", join_type="left outer", use_threads=False)

    def paired(name: str) -> pa.ChunkedArray:
        return pc.if_else(rows["joins"], pc.fill_null(rows[name], 0), 0).cast(pa.int64())

    sums = {"files": pa.array(np.ones(rows.num_rows, dtype="int64")), "pairs": paired("count_all")}
    for c in _HISTORY:
        sums[c], sums[f"{c}_n"] = paired(f"{c}_sum"), paired(f"{c}_count")
    return pa.table({**{k: rows[k] for k in _KEYS}, **sums})


def follow_bucket(bucket, frames, state):
    """New records of one bucket of path keys: the differences that they make."""
    files, loads = (_unpacked(s) for s in state.get) if state.exists else (_FILES.empty_table(), _LOADS.empty_table())
    frames = list(frames)
    new_files = _arrived([f[f["is_file"].astype(bool)] for f in frames], _FILES)
    new_loads = _arrived([f[~f["is_file"].astype(bool)] for f in frames], _LOADS)
    touched = pa.chunked_array([*new_files["_key"].chunks, *new_loads["_key"].chunks], pa.string())
    old_files, other_files = _split(files, "_key", touched)
    old_loads, other_loads = _split(loads, "_key", touched)
    new_files = _newest(pa.concat_tables([old_files, new_files]))
    # A load's row that comes again stands for the earlier one.
    new_loads = pa.concat_tables([old_loads, new_loads])
    new_loads = _first_of(new_loads.take(pa.array(np.arange(new_loads.num_rows)[::-1])), ["file_path", "load_id"])
    state.update((_packed(pa.concat_tables([other_files, new_files])), _packed(pa.concat_tables([other_loads, new_loads]))))

    back = contributions(old_files, old_loads)
    for c in _SUMS:
        back = back.set_column(back.column_names.index(c), c, pc.negate(back[c]))
    change = (pa.concat_tables([contributions(new_files, new_loads), back]).group_by(list(_KEYS), use_threads=False)
              .aggregate([(c, "sum") for c in _SUMS]))
    change = change.select([*_KEYS, *[f"{c}_sum" for c in _SUMS]]).rename_columns([*_KEYS, *_SUMS])
    frame = change.to_pandas(integer_object_nulls=True)
    frame = frame[(frame[list(_SUMS)] != 0).any(axis=1)]
    yield frame.assign(file_size=frame["file_size"].astype("Int64"), start_time=pd.to_datetime(frame["start_time"]))


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def stat_changes(changes: DataFrame, history: DataFrame) -> DataFrame:
    """Streaming differences of the statistics: ``changes`` and ``history`` as the streams above give them."""
    def key(path: str) -> Column:
        return F.when(F.col(path).contains("/"), stage_path_shorten(path))

    none = {"ingestion_status": "string", "file_size": "long", "start_time": "timestamp_ntz", "seq": "long"}
    mine = changes.select(F.coalesce(key("file_path"), F.concat(F.lit("\\0"), F.coalesce("file_path", F.lit("")))).alias("_key"),
                          F.lit(True).alias("is_file"), key("file_path").isNotNull().alias("joins"), "file_path", *none,
                          F.lit(None).cast("string").alias("load_id"), *[F.lit(None).cast("long").alias(c) for c in _HISTORY])
    theirs = history.where(key("file_name").isNotNull()).select(
        key("file_name").alias("_key"), F.lit(False).alias("is_file"), F.lit(False).alias("joins"), F.col("file_name").alias("file_path"),
        *[F.lit(None).cast(t).alias(c) for c, t in none.items()], "load_id", *_HISTORY)
    return mine.unionByName(theirs).withColumn("_bucket", _bucket("_key")).groupBy("_bucket").applyInPandasWithState(
        follow_bucket, _DELTA, "files binary, loads binary", "Update", GroupStateTimeout.NoTimeout)


def _summed(rows: DataFrame) -> DataFrame:
    """Sums by status, size and start; what is taken back whole leaves no row."""
    out = rows.groupBy(*_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return out.where(" OR ".join(f"{c} <> 0" for c in _SUMS))


def _read_sums(spark: SparkSession, path: str, until: int | None = None) -> DataFrame:
    """The sums of all steps (up to ``until``): the last folded table and the steps after it."""
    schema = T.StructType([*spark.createDataFrame([], _DELTA).schema.fields, T.StructField("step", T.LongType())])

    def table(kind: str) -> DataFrame:
        if not path_exists(spark, f"{path}/{kind}"):
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).parquet(f"{path}/{kind}")
        return rows if until is None else rows.where(F.col("step") <= until)

    folded, done = table("folded"), -1
    if path_exists(spark, f"{path}/folds"):
        ends = spark.read.parquet(f"{path}/folds")
        done = (ends if until is None else ends.where(F.col("step") <= until)).agg(F.max("step")).first()[0]
        done = -1 if done is None else int(done)
    return _summed(folded.where(F.col("step") == done).unionByName(table("steps").where(F.col("step") > done)).drop("step"))


def _record_step(path: str):
    """``foreachBatch`` function: one folder a step, folded now and then."""

    def run(deltas: DataFrame, step: int) -> None:
        def put(rows: DataFrame, kind: str) -> None:
            (rows.withColumn("step", F.lit(step).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("step").parquet(f"{path}/{kind}"))
        put(_summed(deltas), "steps")
        if (step + 1) % FOLD == 0:
            spark = deltas.sparkSession
            put(_read_sums(spark, path, step), "folded")
            # Named only when the folded table is whole: until then the steps are read.
            spark.range(1).select(F.lit(step).cast("long").alias("step")).write.mode("append").parquet(f"{path}/folds")

    return run


def start_live_stats(spark: SparkSession, store: ManifestStore, history_path: str, stats_path: str, *, checkpoint_path: str,
                     max_files_per_trigger: int | None = None, available_now: bool = False, processing_time: str = "10 seconds"):
    """Start the statistics; the sums go to ``stats_path``, one folder a step."""
    deltas = stat_changes(change_stream(spark, store, max_files_per_trigger), history_stream(spark, history_path, max_files_per_trigger))
    writer = deltas.writeStream.outputMode("update").foreachBatch(_record_step(stats_path)).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()


def live_load_stats(spark: SparkSession, stats_path: str) -> DataFrame:
    """``load_stats`` from the sums."""
    rows = _read_sums(spark, stats_path).where((F.col("pairs") > 0) & (F.col("ingestion_status") != LOADING))
    sized = F.when(F.col("file_size").isNotNull(), F.col("pairs"))

    def total(name: str) -> Column:
        return F.when(F.sum(f"{name}_n") > 0, F.sum(name)).cast("long")

    return rows.groupBy("ingestion_status").agg(
        F.sum("pairs").alias("files"), (F.sum(F.col("file_size") * F.col("pairs")) / F.lit(GB)).alias("gb_loaded"),
        (F.sum(F.col("file_size") * F.col("pairs")) / F.sum(sized) / F.lit(MB)).alias("average_file_size_mb"),
        (F.max("file_size") / F.lit(MB)).alias("max_file_size_mb"), (F.min("file_size") / F.lit(MB)).alias("min_file_size_mb"),
        total("row_count").alias("row_count"), F.try_divide(F.sum("row_count"), F.sum("row_count_n")).alias("average_row_count"),
        total("row_parsed").alias("row_parsed"), total("error_count").alias("error_count"))


def live_progress_eta(spark: SparkSession, stats_path: str, now: Column, segments: int = 12) -> DataFrame:
    """``progress_eta`` from the sums."""
    rows = _read_sums(spark, stats_path).where("files > 0")
    size = F.col("file_size") * F.col("files")
    parts = rows.agg(F.sum(F.when(F.col("ingestion_status") == LOADED, size)).alias("_loaded"), F.sum(size).alias("_all"),
                     F.min("start_time").alias("_first_start"))
    return eta_columns(parts, now, segments)


# -- stuck files

_ALERT = "file_path string, stuck boolean, start_time timestamp_ntz, seq long"


def _watch_bucket(minutes: int):
    """Records and timer of one bucket of files; the state holds each file's last number, its start, and whether it was told as stuck."""

    def run(bucket, frames, state):
        known, rows = _unpacked(state.get[0]) if state.exists else _WATCHED.empty_table(), []
        if not state.hasTimedOut:
            new = pd.concat(list(frames))
            new = new[new["_file"] != ""]  # clock ticks and files without a name
            begun = (new["ingestion_status"] == "LOADING") & new["start_time"].notna()
            new = _arrived([new.assign(file_path=new["_file"], start_time=pd.to_datetime(new["start_time"]).where(begun), told=False)], _WATCHED)
            old, other = _split(known, "file_path", new["file_path"])
            before = old.select(["file_path", "seq", "told"]).rename_columns(["file_path", "_seq", "_told"])
            new = new.join(before, "file_path", join_type="left outer", use_threads=False)
            new = new.filter(pc.greater(new["seq"], pc.fill_null(new["_seq"], -1)))
            cleared = new.filter(pc.fill_null(new["_told"], False)).group_by("file_path", use_threads=False).aggregate([("seq", "min")])
            rows.append(pd.DataFrame({"file_path": cleared["file_path"].to_pandas(), "stuck": False, "start_time": pd.NaT,
                                      "seq": cleared["seq_min"].to_pandas()}))
            new = _newest(new.select(_WATCHED.names))
            known = pa.concat_tables([other, _split(old, "file_path", new["file_path"])[1], new])
        # Minutes are counted by their borders: more than `minutes` of them lie behind from `at` on.
        start = known["start_time"].cast(pa.int64()).fill_null(0).to_numpy()
        at = (start // 60_000_000 + minutes + 1) * 60_000
        told = known["told"].to_numpy(zero_copy_only=False).astype(bool)
        waits = known["start_time"].is_valid().to_numpy(zero_copy_only=False).astype(bool) & ~told
        due = waits & (at <= state.getCurrentWatermarkMs())
        alerts = known.filter(pa.array(due, pa.bool_())).to_pandas()
        rows.append(alerts.assign(stuck=True)[["file_path", "stuck", "start_time", "seq"]])
        state.update((_packed(known.set_column(known.column_names.index("told"), "told", pa.array(told | due, pa.bool_()))),))
        if (waits & ~due).any():
            state.setTimeoutTimestamp(int(at[waits & ~due].min()) - 1)
        for frame in rows:
            if len(frame):
                yield frame.assign(start_time=pd.to_datetime(frame["start_time"]))

    return run


def stuck_alerts(changes: DataFrame, ticks: DataFrame, minutes: int = 60) -> DataFrame:
    """Streaming alerts: ``stuck`` when a file has been LOADING for more than ``minutes``, and false when a later record clears that.

    ``changes``: manifest records with ``seq``; ``ticks``: a stream with a column
    ``at`` (timestamp_ntz), the time now. The stream's time is the latest tick.
    """
    # A record has no time of its own (and so is never late): ticks alone carry the time on.
    records = changes.where("file_path IS NOT NULL").select(
        F.col("file_path").alias("_file"), F.lit(None).cast("timestamp").alias("at"), "ingestion_status", "start_time", "seq")
    time = F.expr("timestamp_micros(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', at))")  # wall clock, whatever the session's zone
    clock = ticks.select(F.lit("").alias("_file"), time.alias("at"), F.lit("").alias("ingestion_status"),
                         F.lit(None).cast("timestamp_ntz").alias("start_time"), F.lit(0).cast("long").alias("seq"))
    return (records.unionByName(clock).withColumn("_bucket", _bucket("_file")).withWatermark("at", "0 seconds").groupBy("_bucket")
            .applyInPandasWithState(_watch_bucket(minutes), _ALERT, "files binary", "Update", GroupStateTimeout.EventTimeTimeout))


def start_stuck_alerts(spark: SparkSession, store: ManifestStore, ticks: DataFrame, alerts_path: str, *, checkpoint_path: str,
                       minutes: int = 60, max_files_per_trigger: int | None = None, processing_time: str = "10 seconds"):
    """Start the alerts; each step's rows go to a folder of their own below ``alerts_path``."""

    def record(rows: DataFrame, step: int) -> None:
        (rows.withColumn("step", F.lit(step).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("step").parquet(alerts_path))

    alerts = stuck_alerts(change_stream(spark, store, max_files_per_trigger), ticks, minutes)
    return (alerts.writeStream.outputMode("update").foreachBatch(record).option("checkpointLocation", checkpoint_path)
            .trigger(processingTime=processing_time).start())


def live_stuck_files(spark: SparkSession, alerts_path: str, now: Column) -> DataFrame:
    """``stuck_files`` from the alerts: files whose last alert stands, with their minutes."""
    schema = T.StructType([*spark.createDataFrame([], _ALERT).schema.fields, T.StructField("step", T.LongType())])
    rows = spark.read.schema(schema).parquet(alerts_path) if path_exists(spark, alerts_path) else spark.createDataFrame([], schema)
    last = rows.groupBy("file_path").agg(F.max_by(F.struct("stuck", "start_time"), F.struct("seq", "stuck")).alias("last"))
    return last.where("last.stuck").select("file_path", minutes_between(F.col("last.start_time"), now).alias("loading_minutes"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["change_stream", "history_stream", "live_load_stats", "live_progress_eta", "live_stuck_files", "start_live_stats", "start_stuck_alerts"]
