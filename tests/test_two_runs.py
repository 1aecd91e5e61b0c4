"""Claims of runs side by side, and files that two loads hold."""

import datetime as dt

from pyspark.sql import functions as F

from stagecraft.operators.transitions import claim_rows
from stagecraft.plans.ingest import _lost
from stagecraft.schemas import CONTROL_COLUMNS, LOADED, SUSPENDED
from stagecraft.session import work_dir
from stagecraft.sources.loader import LoadTemplate, load_files, read_target, surplus_loads
from stagecraft.sources.tables import ManifestStore

CONTROL = ("file_path string, copy_into_name string, ingestion_order int, ingestion_status string, owner_session long, exec_uuid string, "
           "try_count int, start_time timestamp_ntz, end_time timestamp_ntz, file_size long, error_msg string")


def test_the_earlier_claim_stands(spark):
    rows = [(f"a/{i}", "T", i, "WAITING", None, None, 0, None, None, 1, None) for i in range(6)]
    store = ManifestStore.create(spark, work_dir(spark, "two"), spark.createDataFrame(rows, CONTROL))
    planned_at = store.seq
    now = F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz")
    other = ManifestStore.open(spark, store.root)
    theirs = claim_rows(other.read().where("file_path IN ('a/1', 'a/2', 'a/5')"), run_id="other", owner_session=2, now=now)
    other.append_changes(theirs)
    other.append_changes(theirs.where("file_path = 'a/2'").withColumn("ingestion_status", F.lit(LOADED)).withColumn("exec_uuid", F.lit(None).cast("string")))
    other.append_changes(other.read().where("file_path = 'a/3'").withColumn("ingestion_status", F.lit(SUSPENDED)))
    mine = claim_rows(store.read().where("file_path <= 'a/4'").select(*CONTROL_COLUMNS), run_id="mine", owner_session=1, now=now)
    store.append_changes(mine)
    assert _lost(store, mine, planned_at) == {"a/1", "a/2", "a/3"}
    state = {r.file_path: (r.ingestion_status, r.exec_uuid) for r in ManifestStore.open(spark, store.root).read().collect()}
    assert state == {"a/0": ("LOADING", "mine"), "a/1": ("LOADING", "other"), "a/2": ("LOADED", None), "a/3": ("SUSPENDED", None),
                     "a/4": ("LOADING", "mine"), "a/5": ("LOADING", "other")}
    # A claim after which nobody else records is kept whole.
    planned_at = store.seq
    store.append_changes(mine.where("file_path = 'a/0'"))
    assert _lost(store, mine.where("file_path = 'a/0'"), planned_at) == set()


def test_one_load_of_a_file_counts(spark):
    d = work_dir(spark, "two")
    spark._jvm.java.io.File(d).mkdirs()
    paths = []
    for i in range(4):
        paths.append(f"{d}/x {i}.csv")
        with open(paths[-1], "w") as f:
            f.write(f"{i},a\n{i},b\n")
    tpl = LoadTemplate("T", "T", "a int, b string", "csv", {})
    one = load_files(spark, paths[:3], tpl, f"{d}/t", "one")
    two = load_files(spark, ["file:" + paths[2], paths[3]], tpl, f"{d}/t", "two")
    history = one.unionByName(two)
    assert [(r._again, r._key.rpartition("/")[2]) for r in surplus_loads(history, "file:").collect()] == [("two", "x 2.csv")]
    rows = read_target(spark, f"{d}/t", tpl.schema_ddl, history).collect()
    assert sorted((r.a, r.b) for r in rows) == [(i, b) for i in range(4) for b in "ab"]
    assert read_target(spark, f"{d}/t", tpl.schema_ddl, two).count() == 4  # the first is not committed: the second counts
