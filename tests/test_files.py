"""Files: loader error capture, manifest store, ingest job rules, stream ingest."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from stagecraft import staging
from stagecraft.operators.manifest import build_manifest, listing_from_stage
from stagecraft.plans.ingest import (ALL_DONE, FILE_LIMIT, MSG_DUPLICATES, MSG_FILES_AT_ONCE, MSG_SORT_ORDER,
                                     PASS_LIMIT, TIME_LIMIT, check_parameters, file_ingest)
from stagecraft.schemas import CONTROL_COLUMNS, control_schema
from stagecraft.session import local_path, work_dir
from stagecraft.sources.loader import LoadTemplate, load_files, load_results, read_history, read_rejects, read_target
from stagecraft.sources.stage import list_stage
from stagecraft.sources.tables import ManifestStore, clone_schema, empty_manifest

SF = "/root/testdata/sf0.001"

BAD_CSV = ("x,1,F,2.0,1998-01-01T00:00:00.000,LOW\n"
           "1,2,F,3.0,1998-01-01T00:00:00.000,LOW\n"
           "1,2\n")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture()
def tmp_stage(spark):
    return work_dir(spark, "test")


def test_load_bad_rows_and_empty_file(spark, tmp_stage):
    d = local_path(tmp_stage)
    _write(f"{d}/in/bad.csv", BAD_CSV)
    _write(f"{d}/in/empty.csv", "")
    _write(f"{d}/in/blank lines+x.csv", "\n5,6,O,1.5,1999-01-01T00:00:00.000,HIGH\n\n")
    tpl = LoadTemplate("ORDERS", "ORDERS", staging.ORDERS_DDL)
    paths = [f"file:{d}/in/bad.csv", f"file:{d}/in/empty.csv", f"file:{d}/in/blank lines+x.csv"]
    hist = {r.file_name.rsplit("/", 1)[1]: r for r in load_files(spark, paths, tpl, f"{tmp_stage}/t", "L1").collect()}
    bad = hist["bad.csv"]
    assert (bad.row_parsed, bad.row_count, bad.error_count, bad.status) == (3, 1, 2, "PARTIALLY_LOADED")
    assert bad.first_error_line_number == 1 and bad.first_error_col_name == "O_ORDERKEY"
    assert bad.first_error_character_position == 1
    assert "'x'" in bad.first_error_message
    empty = hist["empty.csv"]
    assert (empty.row_parsed, empty.row_count, empty.error_count, empty.status) == (0, 0, 0, "LOADED")
    blank = hist["blank lines+x.csv"]
    assert (blank.row_parsed, blank.row_count, blank.status) == (1, 1, "LOADED")
    target = read_target(spark, f"{tmp_stage}/t")
    assert sorted(r.o_orderkey for r in target.collect()) == [1, 5]
    rejects = read_rejects(spark, f"{tmp_stage}/t").collect()
    assert sorted(r._raw_line for r in rejects) == ["1,2", "x,1,F,2.0,1998-01-01T00:00:00.000,LOW"]
    # same load id again: the partition is replaced, not appended
    load_files(spark, paths, tpl, f"{tmp_stage}/t", "L1").collect()
    assert read_target(spark, f"{tmp_stage}/t").count() == 2
    res = load_results(spark.createDataFrame([bad])).first()
    assert (res.status, res.first_error) == ("PARTIALLY_LOADED", bad.first_error_message)


def test_load_error_line_and_column_count(spark, tmp_stage):
    d = local_path(tmp_stage)
    lines = [f"{i},1,F,2.0,1998-01-01T00:00:00.000,LOW" for i in range(1, 6)]
    lines.insert(3, "9,9,F")
    _write(f"{d}/in/a.csv", "\n".join(lines) + "\n")
    tpl = LoadTemplate("ORDERS", "ORDERS", staging.ORDERS_DDL)
    r = load_files(spark, [f"file:{d}/in/a.csv"], tpl, f"{tmp_stage}/t", "L").first()
    assert (r.first_error_line_number, r.error_count, r.row_count) == (4, 1, 5)
    assert r.first_error_message.startswith("Number of columns in file (3)")
    assert r.first_error_character_position == len("9,9,F") + 1


@pytest.mark.parametrize("mode, statuses, rows", [
    ("skip_file", {"bad.csv": "LOAD_FAILED", "good.csv": "LOADED"}, 1),
    ("abort_statement", {"bad.csv": "LOAD_FAILED", "good.csv": "LOAD_FAILED"}, 0),
])
def test_on_error_modes(spark, tmp_stage, mode, statuses, rows):
    d = local_path(tmp_stage)
    _write(f"{d}/in/bad.csv", BAD_CSV)
    _write(f"{d}/in/good.csv", "7,1,F,2.0,1998-01-01T00:00:00.000,LOW\n")
    tpl = LoadTemplate("ORDERS", "ORDERS", staging.ORDERS_DDL, on_error=mode)
    hist = load_files(spark, [f"file:{d}/in/bad.csv", f"file:{d}/in/good.csv"], tpl, f"{tmp_stage}/t", "L")
    got = {r.file_name.rsplit("/", 1)[1]: r.status for r in hist.collect()}
    assert got == statuses
    assert read_target(spark, f"{tmp_stage}/t").count() == rows


def test_manifest_store_changes_and_compact(spark, tmp_stage):
    rows = [(f"f{i}", "A", dt.datetime(2000, 1, 1), "WAITING", None, None, 0, None, None, 10, None) for i in range(5)]
    store = ManifestStore.create(spark, f"{tmp_stage}/m", spark.createDataFrame(rows, control_schema()))
    ch1 = spark.createDataFrame([("f1", "A", dt.datetime(2000, 1, 1), "LOADING", 3, "u", 1, None, None, 10, None)],
                                control_schema())
    store.append_changes(ch1)
    ch2 = spark.createDataFrame([("f1", "A", dt.datetime(2000, 1, 1), "LOADED", 3, None, 1, None, None, 10, "")],
                                control_schema())
    store.append_changes(ch2)
    cur = {r.file_path: r for r in store.read().collect()}
    assert cur["f1"].ingestion_status == "LOADED" and cur["f1"].exec_uuid is None and cur["f1"].try_count == 1
    assert cur["f0"].ingestion_status == "WAITING" and len(cur) == 5
    reopened = ManifestStore.open(spark, f"{tmp_stage}/m")
    assert (reopened.epoch, reopened.seq) == (1, store.seq) and store.seq > 2
    assert {r.file_path: r.ingestion_status for r in reopened.read().collect()} == \
        {p: r.ingestion_status for p, r in cur.items()}
    store.compact()
    assert store.seq == 0 and store.epoch == 2
    assert {r.file_path: r.ingestion_status for r in store.read().collect()}["f1"] == "LOADED"
    assert store.read().columns == CONTROL_COLUMNS


def test_clone_and_reset(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    c = clone_schema(spark, orders)
    assert c.schema == orders.schema and c.count() == 0
    e = empty_manifest(spark)
    assert e.columns == CONTROL_COLUMNS and e.count() == 0


def test_check_parameters():
    assert check_parameters(16, 8, "ASC", 20, 3) == "No_Errors"
    assert check_parameters(16, 8, " desc ", 20, 3) == "No_Errors"
    assert check_parameters(0, 0, "x", 0, 0).startswith("FILES_TO_PROCESS")   # first failure wins
    assert check_parameters(16, 1001, "ASC", 20, 3) == MSG_FILES_AT_ONCE
    assert check_parameters(16, 8, "UP", 20, 3) == MSG_SORT_ORDER
    assert check_parameters(16, 8, "ASC", 0, 3).startswith("MAX_RUN_MINUTES")
    assert check_parameters(16, 8, "ASC", 20, 0).startswith("TRIES")


def _staged_store(spark, root):
    stage = staging.stage_tables(spark, SF, root)
    control = build_manifest(listing_from_stage(list_stage(spark, stage)), staging.STAGE_ROUTES)
    return ManifestStore.create(spark, f"{root}/manifest", control)


def test_ingest_job_cycle(spark, tmp_stage):
    store = _staged_store(spark, tmp_stage)
    before = store.read()
    routed = before.where("copy_into_name is not null").count()
    run = file_ingest(spark, store, staging.load_templates(spark), target_root=f"{tmp_stage}/target",
                      history_path=f"{tmp_stage}/history", files_to_process=16, files_at_once=8,
                      max_run_minutes=20, tries=3, run_id="r1", owner_session=7, wave_files=8)
    s = run.summary
    assert s.files_processed == 16 and s.termination_reason == FILE_LIMIT and s.uuid == "r1"
    after = store.read()
    st = {r.ingestion_status: r[1] for r in after.groupBy("ingestion_status").count().collect()}
    assert sum(st.values()) == before.count()
    assert st.get("LOADING", 0) == 0
    done = after.where("exec_uuid is null and try_count = 1")
    assert done.count() == 16
    # the 16 loaded files are the first two planned batches, in ingestion order
    hist = read_history(spark, run.history_path)
    assert hist.count() == 16
    # second run: everything else
    run2 = file_ingest(spark, store, staging.load_templates(spark), target_root=f"{tmp_stage}/target",
                       history_path=f"{tmp_stage}/history", files_to_process=100000, files_at_once=50,
                       max_run_minutes=20, tries=3, run_id="r2", owner_session=7)
    assert store.epoch == 1
    assert run2.summary.termination_reason == ALL_DONE
    assert run2.summary.files_processed == routed - 16
    final = store.read()
    assert final.where("copy_into_name is not null and ingestion_status = 'WAITING'").count() == 0
    # nothing left: the next run ends at once
    run3 = file_ingest(spark, store, staging.load_templates(spark), target_root=f"{tmp_stage}/target",
                       history_path=f"{tmp_stage}/history", files_to_process=10, files_at_once=5,
                       max_run_minutes=20, tries=3, run_id="r3")
    assert (run3.summary.termination_reason, run3.summary.files_processed) == (ALL_DONE, 0)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    good = orders.where("o_orderpriority in ('1-URGENT', '5-LOW') and o_orderstatus <> 'P'").count()
    assert read_target(spark, f"{tmp_stage}/target/ORDERS").count() == good


def test_ingest_job_guards(spark, tmp_stage):
    rows = [("f1", "A", None, "WAITING", None, None, 0, None, None, 1, None)] * 2
    store = ManifestStore.create(spark, f"{tmp_stage}/dup", spark.createDataFrame(rows, control_schema()))
    tpl = staging.load_templates(spark)
    run = file_ingest(spark, store, tpl, target_root="x", history_path="y", files_at_once=5000)
    assert run.summary.parameter_error == MSG_FILES_AT_ONCE
    run = file_ingest(spark, store, tpl, target_root="x", history_path="y")
    assert run.summary.duplicate_files_error == MSG_DUPLICATES


def test_ingest_time_and_pass_limit(spark, tmp_stage):
    store = _staged_store(spark, tmp_stage)
    tpl = staging.load_templates(spark)
    run = file_ingest(spark, store, tpl, target_root=f"{tmp_stage}/t", history_path=f"{tmp_stage}/h",
                      files_to_process=100000, files_at_once=4, max_run_minutes=1e-6, tries=3, wave_files=4)
    assert run.summary.termination_reason == TIME_LIMIT and run.summary.files_processed == 4
    # 3 files at once, 5 files wanted -> 2 passes; the limit rounds up to the passes
    run = file_ingest(spark, store, tpl, target_root=f"{tmp_stage}/t", history_path=f"{tmp_stage}/h",
                      files_to_process=5, files_at_once=3, max_run_minutes=20, tries=3, wave_files=3)
    assert run.summary.files_processed == 6 and run.summary.termination_reason == FILE_LIMIT
    assert PASS_LIMIT != FILE_LIMIT


def test_stream_ingest_matches_events(spark):
    from stagecraft.catalog_files import q_stream_ingest
    got = q_stream_ingest(spark, SF)
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert got.count() == events.count()
    assert got.exceptAll(events.select(*got.columns)).count() == 0


def test_ingest_error_leaves_claimed_files_loading(spark, tmp_stage):
    from stagecraft.operators.transitions import reset_stuck
    store = _staged_store(spark, tmp_stage)
    broken = staging.template_rows()
    for r in broken:
        r["schema_ddl"] = "o_orderkey not_a_type"
    from stagecraft.sources.tables import templates_table
    run = file_ingest(spark, store, templates_table(spark, broken), target_root=f"{tmp_stage}/t",
                      history_path=f"{tmp_stage}/h", files_to_process=4, files_at_once=4,
                      max_run_minutes=20, tries=3, run_id="bad", wave_files=4)
    assert run.summary.termination_reason.startswith("ERROR: ")
    assert run.summary.files_processed == 0
    cur = store.read()
    stuck = cur.where("ingestion_status = 'LOADING' and exec_uuid = 'bad'")
    assert stuck.count() == 4
    # a stuck reset makes them eligible again (tries stay spent)
    later = F.lit(dt.datetime(2100, 1, 1)).cast("timestamp_ntz")
    reset = reset_stuck(cur, later, 60)
    assert reset.where("exec_uuid = 'bad' and ingestion_status = 'WAITING' and try_count = 1").count() == 4


def test_monitoring_over_a_real_run(spark, tmp_stage):
    from stagecraft.operators import monitor
    store = _staged_store(spark, tmp_stage)
    run = file_ingest(spark, store, staging.load_templates(spark), target_root=f"{tmp_stage}/t",
                      history_path=f"{tmp_stage}/h", files_to_process=100000, files_at_once=100,
                      max_run_minutes=20, tries=3, run_id="m")
    control, hist = store.read(), read_history(spark, run.history_path)
    stats = {r.ingestion_status: r for r in monitor.load_stats(control, hist).collect()}
    assert set(stats) <= {"LOADED", "PARTIALLY_LOADED", "LOAD_FAILED"}
    assert sum(r.files for r in stats.values()) == hist.count()
    assert sum(r.row_parsed for r in stats.values()) == hist.agg(F.sum("row_parsed")).first()[0]
    pct = monitor.percent_complete(control).first()[0]
    assert 0 < pct < 100   # unrouted files are still waiting
    eta = monitor.progress_eta(control, F.lit(dt.datetime(2100, 1, 1)).cast("timestamp_ntz")).first()
    assert eta.progress.endswith("%") and eta.estimated_total_runtime_minutes >= eta.running_minutes
    log = monitor.load_log(control, hist)
    assert log.count() == hist.count()


def test_header_template_skips_first_line(spark, tmp_stage):
    d = local_path(tmp_stage)
    head = "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority\n"
    _write(f"{d}/in/h1.csv", head + "1,1,F,2.0,1998-01-01T00:00:00.000,LOW\n"
           "2,1,F,2.5,1998-01-01T00:00:00.000,LOW\n" "3,1,F,oops,1998-01-01T00:00:00.000,LOW\n")
    _write(f"{d}/in/h2.csv", head + "4,1,F,2.0,1998-01-01T00:00:00.000,LOW\n")
    tpl = LoadTemplate("ORDERS", "ORDERS", staging.ORDERS_DDL, options={"header": "true"})
    hist = {r.file_name.rsplit("/", 1)[1]: r
            for r in load_files(spark, [f"file:{d}/in/h1.csv", f"file:{d}/in/h2.csv"], tpl,
                                f"{tmp_stage}/t", "H").collect()}
    h1 = hist["h1.csv"]
    assert (h1.row_parsed, h1.row_count, h1.error_count, h1.status) == (3, 2, 1, "PARTIALLY_LOADED")
    assert h1.first_error_line_number == 4 and h1.first_error_col_name == "O_TOTALPRICE"
    assert h1.first_error_character_position == len("3,1,F,") + 1
    assert (hist["h2.csv"].row_parsed, hist["h2.csv"].status) == (1, "LOADED")
    assert sorted(r.o_orderkey for r in read_target(spark, f"{tmp_stage}/t").collect()) == [1, 2, 4]


def test_stream_newest_first_each_file_once(spark, tmp_stage):
    from stagecraft.streaming.ingest import start_stream_ingest
    stage = staging.stage_events(spark, SF, tmp_stage)
    tpl = LoadTemplate("EVENTS", "EVENTS", staging.EVENTS_DDL, "csv",
                       {"escape": '"', "timestampNTZFormat": staging.TS_TEXT})
    kw = dict(target_path=f"{tmp_stage}/target", history_path=f"{tmp_stage}/history",
              checkpoint_path=f"{tmp_stage}/checkpoint", run_id="s", max_files_per_trigger=1,
              latest_first=True)
    q = start_stream_ingest(spark, stage, tpl, **kw)
    q.awaitTermination()
    hist = spark.read.parquet(f"{tmp_stage}/history")
    days = {r.load_id: r.file_name.split("month=")[1][:10] for r in hist.collect()}
    assert len(days) == hist.count()            # one file per micro-batch
    ordered = [days[k] for k in sorted(days)]
    assert ordered == sorted(ordered, reverse=True)   # newest day first
    n = read_target(spark, f"{tmp_stage}/target").count()
    # restarting on the same checkpoint loads nothing twice
    q2 = start_stream_ingest(spark, stage, tpl, **kw)
    q2.awaitTermination()
    assert read_target(spark, f"{tmp_stage}/target").count() == n == spark.read.parquet(f"{SF}/events.parquet").count()


def test_load_of_only_empty_files(spark, tmp_stage):
    d = local_path(tmp_stage)
    _write(f"{d}/in/e1.csv", "")
    _write(f"{d}/in/e2.csv", "")
    tpl = LoadTemplate("ORDERS", "ORDERS", staging.ORDERS_DDL)
    hist = load_files(spark, [f"file:{d}/in/e1.csv", f"file:{d}/in/e2.csv"], tpl, f"{tmp_stage}/t", "E").collect()
    assert sorted((r.status, r.row_parsed, r.row_count) for r in hist) == [("LOADED", 0, 0)] * 2


def test_parquet_template_loads_every_row(spark, tmp_stage):
    from stagecraft.sources.stage import unload
    from stagecraft.sources.loader import load_stage
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    unload(orders, f"{tmp_stage}/pq", "parquet")
    tpl = LoadTemplate("ORDERS", "ORDERS", staging.ORDERS_DDL, file_format="parquet")
    hist = load_stage(spark, f"{tmp_stage}/pq", tpl, f"{tmp_stage}/t", "P").collect()
    assert all(r.status == "LOADED" and r.error_count == 0 for r in hist)
    assert sum(r.row_parsed for r in hist) == orders.count()
    got = read_target(spark, f"{tmp_stage}/t", staging.ORDERS_DDL)
    assert got.exceptAll(orders).count() == 0 and got.count() == orders.count()


def test_stream_of_parquet_files(spark, tmp_stage):
    from stagecraft.sources.stage import unload
    from stagecraft.streaming.ingest import start_stream_ingest
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    unload(orders.repartition(4), f"{tmp_stage}/pq", "parquet")
    tpl = LoadTemplate("ORDERS", "ORDERS", staging.ORDERS_DDL, file_format="parquet")
    q = start_stream_ingest(spark, f"{tmp_stage}/pq", tpl, target_path=f"{tmp_stage}/t",
                            history_path=f"{tmp_stage}/h", checkpoint_path=f"{tmp_stage}/c",
                            max_files_per_trigger=2)
    q.awaitTermination()
    got = read_target(spark, f"{tmp_stage}/t", staging.ORDERS_DDL)
    assert got.count() == orders.count() and got.exceptAll(orders).count() == 0
    assert spark.read.parquet(f"{tmp_stage}/h").select("load_id").distinct().count() == 2


ODD_DDL = "a int, b string, c double"


def _write_in(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    data = text if isinstance(text, bytes) else text.encode()
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data)
    return f"{folder}/{name}"


def test_odd_names_missing_and_cut_off_files(spark, tmp_stage):
    d = tmp_stage.removeprefix("file:")
    cut = gzip.compress(("1,x,1.0\n" * 5000).encode())
    names = ["x[1].csv", "x1.csv", "a b.csv", "p+q%41.csv", "{s}.csv"]
    paths = [_write_in(f"{d}/in", n, f"{i},{n},1.0\n{i},only\n") for i, n in enumerate(names)]
    gz = _write_in(f"{d}/in", "cut.csv.gz", cut[:len(cut) // 2])
    empty = _write_in(f"{d}/in", "empty.csv", "")
    tpl = LoadTemplate("ODD", "ODD", ODD_DDL)
    # Plain, file: and file:/// spellings; all but x1.csv, whose rows must not come in.
    asked = [paths[0], "file:" + paths[2], "file://" + paths[3], paths[4], gz, empty, f"{d}/in/missing.csv"]
    hist = {r.file_name: r for r in load_files(spark, asked, tpl, f"{tmp_stage}/t", "2026-12-02T10:00:00").collect()}
    for p in (asked[0], asked[1], asked[2], asked[3]):
        assert (hist[p].status, hist[p].row_count, hist[p].error_count) == ("PARTIALLY_LOADED", 1, 1), p
    assert hist[gz].status == "LOAD_FAILED" and hist[gz].first_error_message
    assert hist[asked[6]].status == "LOAD_FAILED" and hist[empty].status == "LOADED"
    got = sorted(r.b for r in read_target(spark, f"{tmp_stage}/t", ODD_DDL).collect())
    assert got == sorted(n for n in names if n != "x1.csv")


def test_target_without_rows(spark, tmp_stage):
    d = tmp_stage.removeprefix("file:")
    empty = _write_in(f"{d}/in", "empty.csv", "")
    tpl = LoadTemplate("ODD", "ODD", ODD_DDL)
    assert load_files(spark, [empty], tpl, f"{tmp_stage}/t", "E").first().status == "LOADED"
    assert read_target(spark, f"{tmp_stage}/t", ODD_DDL).count() == 0
    assert load_files(spark, [f"{d}/none"], tpl, f"{tmp_stage}/t", "F").first().status == "LOAD_FAILED"


def test_error_details_of_quoted_lines(spark, tmp_stage):
    d = tmp_stage.removeprefix("file:")
    paths = [_write_in(f"{d}/in", "n.csv", '1,"a,b",1.0,extra\n'), _write_in(f"{d}/in", "v.csv", '1,"a,b",oops\n')]
    rows = {r.file_name[-5:]: r for r in load_files(spark, paths, LoadTemplate("O", "O", ODD_DDL), f"{tmp_stage}/t", "Q").collect()}
    assert "(4)" in rows["n.csv"].first_error_message
    assert rows["v.csv"].first_error_character_position == 9 and rows["v.csv"].first_error_col_name == "C"


def test_landing_puts_the_writer_setting_back(spark, tmp_stage):
    tpl = LoadTemplate("O", "O", ODD_DDL)
    d = tmp_stage.removeprefix("file:")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    load_files(spark, [_write_in(f"{d}/in", "n.csv", "1,b,1.0\n")], tpl, f"{tmp_stage}/t", "Q")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def _ingest_store(spark, d, tmp_stage, n=6):
    paths = [_write_in(f"{d}/in", f"f{i}.csv", f"{i},r{i},1.0\n") for i in range(n)]
    rows = [("file:" + p, "ODD", dt.datetime(2000, 1, 1 + i), "WAITING", None, None, 0, None, None, 10, None)
            for i, p in enumerate(paths)]
    store = ManifestStore.create(spark, f"{tmp_stage}/m", spark.createDataFrame(rows, control_schema()))
    from stagecraft.sources.tables import templates_table
    templates = templates_table(spark, [{"statement_name": "ODD", "schema_ddl": ODD_DDL, "effective": dt.datetime(1990, 1, 1)}])
    return store, templates


def test_kill_switch_stops_a_running_job(spark, tmp_stage):
    from stagecraft.operators import transitions
    d = tmp_stage.removeprefix("file:")
    store, templates = _ingest_store(spark, d, tmp_stage)
    ticks = []

    def clock():
        ticks.append(1)
        if len(ticks) == 4:  # after the first wave's record time: another session suspends
            ManifestStore.open(spark, f"{tmp_stage}/m").update(transitions.suspend)
        return dt.datetime(2020, 1, 1)
    kw = dict(target_root=f"{tmp_stage}/t", history_path=f"{tmp_stage}/h", files_at_once=2, wave_files=2)
    run = file_ingest(spark, store, templates, clock=clock, run_id="r:1", **kw)
    status = [r.ingestion_status for r in ManifestStore.open(spark, f"{tmp_stage}/m").read().collect()]
    assert sorted(status) == ["LOADED"] * status.count("LOADED") + ["SUSPENDED"] * status.count("SUSPENDED")
    assert 0 < status.count("LOADED") < 6 and run.summary.files_processed == status.count("LOADED")
    store.update(transitions.resume)
    file_ingest(spark, store, templates, run_id="r2", **kw)
    got = read_target(spark, f"{tmp_stage}/t/ODD", ODD_DDL, read_history(spark, f"{tmp_stage}/h"))
    assert sorted(r.a for r in got.collect()) == list(range(6))


def test_rerun_after_a_failure_loads_each_row_once(spark, tmp_stage, monkeypatch):
    from stagecraft.operators import transitions
    from stagecraft.plans import ingest
    d = tmp_stage.removeprefix("file:")
    store, templates = _ingest_store(spark, d, tmp_stage, 4)
    kw = dict(target_root=f"{tmp_stage}/t", history_path=f"{tmp_stage}/h", files_at_once=2, wave_files=2)
    reset = lambda c: transitions.reset_stuck(c, F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz"))
    for broken in ("write_history", "load_results"):  # before and after the commit of a wave's loads
        with monkeypatch.context() as m:
            m.setattr(ingest, broken, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            run = file_ingest(spark, store, templates, run_id=f"bad-{broken}", **kw)
            assert run.summary.termination_reason == "ERROR: lost"
        store.update(reset)
    file_ingest(spark, store, templates, run_id="good", **kw)
    assert {r.ingestion_status for r in store.refresh().read().collect()} == {"LOADED"}
    got = read_target(spark, f"{tmp_stage}/t/ODD", ODD_DDL, read_history(spark, f"{tmp_stage}/h"))
    assert sorted(r.a for r in got.collect()) == [0, 1, 2, 3]


@pytest.mark.parametrize("mode", ["continue", "skip_file", "abort_statement"])
def test_lines_are_parsed_once_and_never_sorted(spark, tmp_stage, mode, monkeypatch):
    """The text is read by one pass, and counting lines sorts none of the good ones."""
    from stagecraft.sources import loader
    d, plans = local_path(tmp_stage), []
    _write(f"{d}/in/bad.csv", BAD_CSV)
    _write(f"{d}/in/good.csv", "7,2,F,3.0,1998-01-01T00:00:00.000,LOW\n\n")
    _write(f"{d}/in/two%20words +.csv", "8,2,F,3.0,1998-01-01T00:00:00.000,LOW\nz\n")

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    write, keep = loader._write_landing, loader.materialize
    monkeypatch.setattr(loader, "_write_landing", lambda df, path: (seen(df), write(df, path)))
    monkeypatch.setattr(loader, "materialize", lambda df, name: (seen(df), keep(df, name))[1])
    tpl = LoadTemplate("ORDERS", "ORDERS", staging.ORDERS_DDL, on_error=mode)
    paths = [f"file:{d}/in/{n}.csv" for n in ("bad", "good", "two%20words +")]
    hist = {r.file_name.rsplit("/", 1)[1]: r for r in load_files(spark, paths, tpl, f"{tmp_stage}/t", "L1").collect()}
    assert sum("FileScan text" in p for p in plans) == 1
    assert not any("SortAggregate" in p and "Filter" not in p for p in plans)
    bad, two = hist["bad.csv"], hist["two%20words +.csv"]
    assert (bad.row_parsed, bad.error_count, bad.first_error_line_number) == (3, 2, 1)
    assert (two.row_parsed, two.error_count, two.first_error_line_number) == (2, 1, 2)
    want = {"continue": [1, 7, 8], "skip_file": [7], "abort_statement": []}[mode]
    assert sorted(r.o_orderkey for r in read_target(spark, f"{tmp_stage}/t", staging.ORDERS_DDL).collect()) == want
    kinds = {(r._kind, r.n) for r in spark.read.parquet(f"{tmp_stage}/t").groupBy("_kind").agg(F.count("*").alias("n")).collect()}
    left = {"continue": set(), "skip_file": {("skipped", 2)}, "abort_statement": {("skipped", 3)}}[mode]
    assert kinds == left | {("rejected", 3), ("blank", 1)} | ({("loaded", len(want))} if want else set())
    if mode != "abort_statement":
        done = read_target(spark, f"{tmp_stage}/t", staging.ORDERS_DDL, load_files(spark, paths, tpl, f"{tmp_stage}/t", "L1"))
        assert sorted(r.o_orderkey for r in done.collect()) == want
