"""Physical plan properties that matter at scale (checked with explain)."""

import io
import random
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from stagecraft import fixtures as fx
from stagecraft.operators.ranking import number_within
from stagecraft.session import materialize, work_dir
from stagecraft.sources.loader import read_target
from stagecraft.sources.stage import list_stage

SF = "/root/testdata/sf0.001"


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_skew_safe_numbering_range_partitions(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([("hot" if rng.random() < 0.9 else "x", i) for i in range(500)], "g string, k int")
    out = number_within(df, ["g"], [F.col("k").asc()], "rn")
    plan = _plan(out, "simple")
    # Whatever the planner broadcasts: the numbered rows are read back from their folder,
    # and no exchange deals rows by the group alone; a group's counts are pre-aggregated.
    assert "numbered-" in plan and "FileScan parquet" in plan
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    by_group = [e for e in exchanges if re.match(r"g#\d+, \d+$", e)]
    for e in by_group:
        below = plan[plan.index(f"Exchange hashpartitioning({e})"):]
        assert re.search(r"partial_(min|count)", below)
    assert sorted(r.rn for r in out.where("g = 'hot'").collect()) == list(range(1, out.where("g = 'hot'").count() + 1))


def test_projection_reads_only_needed_columns(spark):
    orders = fx.base_table(spark, SF, "orders")
    plan = _plan(orders.select("o_orderkey").where(F.col("o_orderstatus") == "F"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan


def test_listing_reads_no_content(spark):
    plan = _plan(list_stage(spark, SF), "simple")
    assert "BatchScan stage_listing" in plan and "content" not in plan and "binaryFile" not in plan


def test_target_read_prunes_kinds(spark):
    root = work_dir(spark, "plan-target")
    df = spark.createDataFrame([(1, "L", "loaded"), (2, "L", "rejected")], "a int, _load_id string, _kind string")
    df.write.partitionBy("_load_id", "_kind").parquet(root)
    t = read_target(spark, root)
    assert "PartitionFilters: [isnotnull(_kind" in _plan(t)
    assert [r.a for r in t.collect()] == [1]


def test_claim_is_distributed_top_k(spark):
    import datetime as dt
    from stagecraft import catalog
    from stagecraft.operators.batches import claim_next
    control = fx.fixture(spark, SF, "control")
    out = claim_next(control, tries=3, files_at_once=8, sort_order="ASC", run_id="r", owner_session=1,
                     now=F.lit(dt.datetime(2001, 8, 1)).cast("timestamp_ntz"),
                     templates=fx.fixture(spark, SF, "templates"))
    plan = _plan(out, "simple")
    # head (top 1) and batch (top N): no global sort of the manifest
    assert plan.count("TakeOrderedAndProject") == 2
    assert "rangepartitioning" not in plan
    # the claimed batch is broadcast into the manifest
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert catalog.FILES_AT_ONCE == 8


def test_path_key_join_drops_keyless_rows_first(spark):
    from stagecraft.operators.monitor import load_log
    tables = [materialize(fx.fixture(spark, SF, name), f"plan-{name}") for name in ("control", "history")]
    out = load_log(*tables)
    plan = _plan(out)
    # Paths without "/" have no key: the plain test goes into the scan of both sides.
    assert "StringContains(file_path,/)" in plan and "StringContains(file_name,/)" in plan
    assert out.where("file_name is null").count() == 0
