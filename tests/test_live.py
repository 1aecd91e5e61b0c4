"""Live figures equal the scans after every step, in any order of records, over restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stagecraft.functions.timing import ntz_literal
from stagecraft.operators.monitor import load_stats, progress_eta, stuck_files
from stagecraft.schemas import LOAD_HISTORY_SCHEMA, control_schema
from stagecraft.sources.loader import read_history, write_history
from stagecraft.sources.tables import ManifestStore
from stagecraft.streaming import live

T0 = dt.datetime(2024, 5, 1, 10, 0, 30)
def now():
    return ntz_literal(T0 + dt.timedelta(hours=5))


def files(rng, n):
    paths = [f"s3://b/TPCH/ORDERS/f{i}.csv" for i in range(n)] + ["no-slash.csv"]
    return [(p, "ORDERS", T0, "WAITING", None, None, 0, None, None, rng.choice([None, 5, 5, 1000, 70_000]), None) for p in paths]


def changed(rng, rows, step):
    out = []
    for r in rng.sample(rows, len(rows) // 2):
        status = rng.choice(["WAITING", "LOADING", "LOADING", "LOADED", "LOAD_FAILED"])
        out.append((*r[:3], status, 1, "u", 1, T0 + dt.timedelta(minutes=7 * step + rng.randint(0, 6), seconds=rng.randint(0, 59)), None, r[9], ""))
    return out


def history(spark, rng, rows, load):
    some = rng.sample(rows, len(rows) // 3)
    data = [(r[0].replace("s3://b/", "azure://c/"), "LOADED", rng.choice([None, 3, 10]), 12, None, None, None, None, rng.choice([0, 2]), load, "T") for r in some]
    return spark.createDataFrame(data, LOAD_HISTORY_SCHEMA)


def plain(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def drained(query):
    query.awaitTermination()
    assert query.exception() is None, query.exception()


@pytest.mark.parametrize("fold", [live.FOLD, 2])
def test_stats_equal_the_scan_after_every_step(spark, tmp_path, monkeypatch, fold):
    monkeypatch.setattr(live, "FOLD", fold)
    rng = random.Random(fold)
    rows = files(rng, 40)
    store = ManifestStore.create(spark, f"{tmp_path}/m", spark.createDataFrame(rows, control_schema()))
    paths = dict(checkpoint_path=f"{tmp_path}/c", available_now=True)
    for step in range(5):
        if step:
            store.append_changes(spark.createDataFrame(changed(rng, rows, step), control_schema()))
        if step != 2:
            # The second load id is written again with other rows: its history counts as it is read now.
            write_history(history(spark, rng, rows, f"load-{step}"), f"{tmp_path}/h")
        drained(live.start_live_stats(spark, store, f"{tmp_path}/h", f"{tmp_path}/s", **paths))  # a restart each time
        control, hist = store.read(), read_history(spark, f"{tmp_path}/h")
        assert plain(live.live_load_stats(spark, f"{tmp_path}/s")) == plain(load_stats(control, hist)), step
        assert plain(live.live_progress_eta(spark, f"{tmp_path}/s", now())) == plain(progress_eta(control, now())), step


def test_records_in_any_order(spark, tmp_path):
    rng = random.Random(9)
    rows = files(rng, 20)
    store = ManifestStore.create(spark, f"{tmp_path}/m", spark.createDataFrame(rows, control_schema()))
    later, earlier = changed(rng, rows, 3), changed(rng, rows, 1)
    store.append_changes(spark.createDataFrame(later, control_schema()))
    newest = store.seq
    drained(live.start_live_stats(spark, store, f"{tmp_path}/h", f"{tmp_path}/s", checkpoint_path=f"{tmp_path}/c", available_now=True))
    # A record with a lower number comes late.
    (spark.createDataFrame(earlier, control_schema()).withColumn("seq", F.lit(newest - 10)).write.mode("append")
     .partitionBy("seq").parquet(store._changes(store.epoch)))
    drained(live.start_live_stats(spark, store, f"{tmp_path}/h", f"{tmp_path}/s", checkpoint_path=f"{tmp_path}/c", available_now=True))
    assert plain(live.live_progress_eta(spark, f"{tmp_path}/s", now())) == plain(progress_eta(store.refresh().read(), now()))


def test_a_step_that_runs_again_counts_once(spark, tmp_path):
    deltas = spark.createDataFrame([("LOADED", 5, T0, *[1] * 8), ("WAITING", 5, None, *[-1] * 8)], live._DELTA)
    record = live._record_step(f"{tmp_path}/s")
    for step in (0, 1, 1, 0):
        record(deltas, step)
    assert [r["files"] for r in live._read_sums(spark, f"{tmp_path}/s").orderBy("files").collect()] == [-2, 2]


def test_stuck_alerts_equal_the_scan_at_given_times(spark, tmp_path):
    rng = random.Random(4)
    rows = files(rng, 30)
    store = ManifestStore.create(spark, f"{tmp_path}/m", spark.createDataFrame(rows, control_schema()))
    (tmp_path / "ticks").mkdir()
    times = [0, 29, 61, 62, 75, 90, 130, 300]
    for n, minutes in enumerate(times):
        if n in (1, 3, 5):
            store.append_changes(spark.createDataFrame(changed(rng, rows, n), control_schema()))
        at = T0 + dt.timedelta(minutes=minutes)
        spark.createDataFrame([(at,)], "at timestamp_ntz").write.mode("append").parquet(f"{tmp_path}/ticks")
        ticks = spark.readStream.schema("at timestamp_ntz").parquet(f"{tmp_path}/ticks")
        query = live.start_stuck_alerts(spark, store, ticks, f"{tmp_path}/a", checkpoint_path=f"{tmp_path}/c", minutes=20, processing_time="0 seconds")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        at_ = ntz_literal(at)
        assert plain(live.live_stuck_files(spark, f"{tmp_path}/a", at_)) == plain(stuck_files(store.read(), at_, 20)), minutes


def test_states_are_buckets_not_keys(spark, tmp_path, monkeypatch):
    """A step's calls and states are bounded by the buckets, however many keys come."""
    monkeypatch.setattr(live, "BUCKETS", 3)
    rng = random.Random(5)
    rows = files(rng, 200)
    store = ManifestStore.create(spark, f"{tmp_path}/m", spark.createDataFrame(rows + [rows[7], (None, *rows[0][1:])], control_schema()))
    write_history(history(spark, rng, rows, "load"), f"{tmp_path}/h")
    query = live.start_live_stats(spark, store, f"{tmp_path}/h", f"{tmp_path}/s", checkpoint_path=f"{tmp_path}/c", available_now=True)
    drained(query)
    assert 0 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3
    # Of equal numbers one record of a file counts; a file without a path is one as well.
    assert live._read_sums(spark, f"{tmp_path}/s").agg(F.sum("files")).first()[0] == 202

    at = T0 + dt.timedelta(hours=3)
    store.append_changes(spark.createDataFrame([("", *r[1:3], "LOADING", 1, "u", 1, T0, *r[8:]) for r in rows[:1]]
                                               + [(*r[:3], "LOADING", 1, "u", 1, T0, *r[8:]) for r in rows], control_schema()))
    spark.createDataFrame([(at,)], "at timestamp_ntz").write.parquet(f"{tmp_path}/ticks")
    query = live.start_stuck_alerts(spark, store, spark.readStream.schema("at timestamp_ntz").parquet(f"{tmp_path}/ticks"), f"{tmp_path}/a",
                                    checkpoint_path=f"{tmp_path}/c2", minutes=20, processing_time="0 seconds")
    try:
        query.processAllAvailable()
        assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3
    finally:
        query.stop()
    assert live.live_stuck_files(spark, f"{tmp_path}/a", ntz_literal(at)).count() == 201
