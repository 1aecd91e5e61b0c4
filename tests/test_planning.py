"""Planning: skew-safe numbering, plan = repeated claims, claim and transitions."""

import datetime as dt
import random

from pyspark.sql import Window, functions as F

from stagecraft.operators import batches, transitions
from stagecraft.operators.ranking import number_within
from stagecraft.schemas import CONTROL_COLUMNS, control_schema

NOW = dt.datetime(2001, 8, 1)


def _manifest(spark, rows):
    return spark.createDataFrame(rows, control_schema())


def _random_rows(rng, n, templates=("A", "B", "C", None), hot=None):
    rows = []
    for i in range(n):
        t = hot if hot and rng.random() < 0.6 else rng.choice(templates)
        order = None if rng.random() < 0.05 else dt.datetime(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 20))
        status = rng.choice(["WAITING"] * 6 + ["LOADED", "LOADING", "SUSPENDED"])
        rows.append((f"s3://b/p/{i:05d}.csv", t, order, status, None, None, rng.randint(0, 3), None, None,
                     rng.randint(1, 1000), None))
    return rows


def test_number_within_equals_row_number(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o int, k int").repartition(5)
    ours = number_within(df, ["g"], [F.col("o").asc(), F.col("k").asc()], "rn")
    w = Window.partitionBy("g").orderBy("o", "k")
    ref = df.withColumn("rn", F.row_number().over(w))
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, ref.collect()))
    glob = number_within(df, [], [F.col("o").desc(), F.col("k").asc()], "rn")
    ref2 = df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("o").desc(), "k")))
    assert sorted(map(repr, glob.collect())) == sorted(map(repr, ref2.collect()))


def _loop(rows, tries, n, sort_order):
    """Brute force: repeat 'first eligible file picks the template, take N of it'."""
    idx = {c: i for i, c in enumerate(CONTROL_COLUMNS)}
    state = {r[0]: list(r) for r in rows}
    desc = sort_order == "DESC"

    def key(r):
        o = r[idx["ingestion_order"]]
        if desc:
            return (o is None, -(o.timestamp()) if o else 0, r[0])
        return (o is None, o.timestamp() if o else 0, r[0])

    out, batch = {}, 0
    while True:
        elig = sorted((r for r in state.values() if r[idx["ingestion_status"]] == "WAITING"
                       and r[idx["try_count"]] < tries and r[idx["copy_into_name"]] is not None), key=key)
        if not elig:
            return out
        batch += 1
        t = elig[0][idx["copy_into_name"]]
        for r in [r for r in elig if r[idx["copy_into_name"]] == t][:n]:
            r[idx["ingestion_status"]] = "LOADING"
            out[r[0]] = batch


def test_plan_equals_repeated_claims(spark):
    rng = random.Random(11)
    for case in range(4):
        rows = _random_rows(rng, rng.randint(20, 120), hot="A" if case % 2 else None)
        n = rng.choice([1, 3, 8])
        order = rng.choice(["ASC", "DESC"])
        expected = _loop(rows, 3, n, order)
        plan = batches.plan_batches(_manifest(spark, rows), tries=3, files_at_once=n, sort_order=order)
        got = {r.file_path: r.batch_no for r in plan.collect()}
        assert got == expected, (case, n, order)


def test_claim_next_is_first_planned_batch(spark):
    rng = random.Random(5)
    rows = _random_rows(rng, 60)
    m = _manifest(spark, rows)
    plan = batches.plan_batches(m, tries=3, files_at_once=4, sort_order="ASC")
    first = {r.file_path for r in plan.where("batch_no = 1").collect()}
    claimed = batches.claim_next(m, tries=3, files_at_once=4, sort_order="ASC", run_id="r1", owner_session=9,
                                 now=F.lit(NOW).cast("timestamp_ntz"))
    got = claimed.where("ingestion_status = 'LOADING' and exec_uuid = 'r1'").collect()
    assert {r.file_path for r in got} == first
    assert all(r.owner_session == 9 and r.start_time == NOW for r in got)
    before = {r.file_path: r.try_count for r in m.collect()}
    assert all(r.try_count == before[r.file_path] + 1 for r in got)
    assert claimed.count() == m.count()


def test_plan_respects_templates_and_pass_limit(spark):
    rows = [(f"f{i}", t, dt.datetime(2000, 1, 1 + i), "WAITING", None, None, 0, None, None, 1, None)
            for i, t in enumerate(["A", "B", "A", "C", None, "A"])]
    m = _manifest(spark, rows)
    tpl = spark.createDataFrame([("A", "a", dt.datetime(1990, 1, 1), None),
                                 ("B", "b", dt.datetime(1990, 1, 1), dt.datetime(2000, 1, 1)),
                                 ("C", "c1", dt.datetime(1990, 1, 1), None),
                                 ("C", "c2", dt.datetime(1999, 1, 1), None)],
                                "statement_name string, statement_text string, effective timestamp_ntz, "
                                "superseded timestamp_ntz")
    now = F.lit(NOW).cast("timestamp_ntz")
    plan = batches.plan_batches(m, tries=3, files_at_once=2, sort_order="ASC", templates=tpl, now=now)
    got = sorted((r.file_path, r.batch_no) for r in plan.collect())
    assert got == [("f0", 1), ("f2", 1), ("f3", 2), ("f5", 3)]
    limited = batches.plan_batches(m, tries=3, files_at_once=2, sort_order="ASC", templates=tpl, now=now,
                                   files_to_process=3)
    assert {r.batch_no for r in limited.collect()} == {1, 2}
    live = {r.statement_name: r.statement_text for r in batches.valid_templates(tpl, now).collect()}
    assert live == {"A": "a", "C": "c2"}   # B expired; overlapping C: latest effective wins
    out = {r.file_path: r.reason for r in batches.unplannable_files(m, 3, tpl, now).collect()}
    assert out == {"f1": "NO_TEMPLATE", "f4": "NO_ROUTE"}


def test_state_transitions_keep_files(spark):
    rows = _random_rows(random.Random(3), 40)
    m = _manifest(spark, rows)
    now = F.lit(NOW).cast("timestamp_ntz")
    claimed = batches.claim_next(m, tries=3, files_at_once=5, sort_order="ASC", run_id="r", owner_session=1,
                                 now=F.lit(dt.datetime(2001, 7, 31, 22, 0)).cast("timestamp_ntz"))
    loading = [r.file_path for r in claimed.where("exec_uuid = 'r'").collect()]
    results = spark.createDataFrame([(p, "LOADED" if i % 2 else "LOAD_FAILED", None if i % 2 else "bad")
                                     for i, p in enumerate(loading)], "file string, status string, first_error string")
    done = transitions.mark_complete(claimed, results, now)
    d = {r.file_path: r for r in done.collect()}
    for i, p in enumerate(loading):
        assert d[p].ingestion_status == ("LOADED" if i % 2 else "LOAD_FAILED")
        assert d[p].exec_uuid is None and d[p].end_time == NOW
        assert d[p].error_msg == ("" if i % 2 else "bad")
    requeued = transitions.requeue_failed(done, tries=3)
    rq = {r.file_path: r.ingestion_status for r in requeued.collect()}
    assert all(rq[p] == "WAITING" for i, p in enumerate(loading) if i % 2 == 0 and d[p].try_count < 3)
    # stuck: claimed 2 hours before now -> reset; files and their count unchanged
    reset = transitions.reset_stuck(claimed, now, 60)
    assert {r.file_path for r in reset.where("ingestion_status = 'LOADING'").collect()}.isdisjoint(loading)
    sus = transitions.suspend(m)
    assert sus.where("ingestion_status = 'WAITING'").count() == 0
    back = transitions.resume(sus)
    orig = {r.file_path: r.ingestion_status for r in m.collect()}
    assert {r.file_path: r.ingestion_status for r in back.collect()} == {
        p: ("WAITING" if s in ("WAITING", "SUSPENDED") else s) for p, s in orig.items()}
    for df in (claimed, done, requeued, reset, sus, back):
        assert df.count() == m.count() and df.columns == CONTROL_COLUMNS


def test_number_within_nulls_and_desc(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["t1"] * 6 + ["t2", None]), None if rng.random() < 0.1 else rng.randint(0, 20), i)
            for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int, k int").repartition(7)
    order = [F.col("o").desc_nulls_last(), F.col("k").asc()]
    ours = number_within(df, ["g"], order, "rn")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, ref.collect()))
