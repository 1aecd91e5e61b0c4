"""Stored tables in buckets: the same log and duplicates, nothing stored is shuffled."""

import collections
import io
import random
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from compare import rows_of
from stagecraft.operators.monitor import load_log
from stagecraft.session import work_dir
from stagecraft.sources.buckets import KnownPaths, bucketed_load_log, keyed_rows, path_table

CONTROL = ("file_path string, copy_into_name string, ingestion_order int, ingestion_status string, owner_session long, exec_uuid string, "
           "try_count int, start_time timestamp_ntz, end_time timestamp_ntz, file_size long, error_msg string")
HISTORY = "file_name string, row_count long, row_parsed long, error_count long"


def _control(spark, paths):
    return spark.createDataFrame([(p, "T", i, "LOADED", None, None, 1, None, None, i, "") for i, p in enumerate(paths)], CONTROL)


def _history(spark, names):
    return spark.createDataFrame([(n, i, i, 0) for i, n in enumerate(names)], HISTORY)


def _sorted(df):
    return sorted(rows_of(df.columns, [tuple(r) for r in df.collect()])[0])


def _plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def _stored(spark, root, rows, path_col, hot_rows, parts=3, buckets=5):
    keyed = keyed_rows(rows, path_col)
    table = path_table(spark, root, keyed, buckets)
    for part in range(parts):
        table.append(keyed.where(F.pmod(F.hash(path_col), F.lit(parts)) == part), f"p/{part}", hot_rows)
    return table


@pytest.mark.parametrize("hot_rows", [10_000, 3, 0])
def test_log_equals_the_join(spark, hot_rows):
    rng = random.Random(hot_rows)
    names = [f"x/{i}.csv" for i in range(60)]
    control = _control(spark, [f"s3://b/{rng.choice(names)}" for _ in range(150)] + [None, "nokey", "", "s3://b/x/0.csv"] + ["s3://b/x/1.csv"] * 20)
    # One file holds a third of the history.
    history = _history(spark, [f"azure://a/{rng.choice(names)}" for _ in range(100)] + ["s3://z/x/0.csv"] * 50 + [None, "nokey"])
    root = work_dir(spark, "t")
    c, h = _stored(spark, f"{root}/c", control, "file_path", hot_rows), _stored(spark, f"{root}/h", history, "file_name", hot_rows)
    assert (h.hot() is not None) == (hot_rows < 100) and (c.hot() is not None) == (hot_rows < 100)
    assert _sorted(bucketed_load_log(c, h)) == _sorted(load_log(control, history))


def test_part_replaces_itself_and_folder_is_reopened(spark):
    root = work_dir(spark, "t")
    rows = keyed_rows(_history(spark, ["a/1", "a/2", "a/2"]), "file_name")
    table = path_table(spark, root, rows, 4)
    assert table.rows().isEmpty() and table.hot() is None
    for _ in range(2):
        table.append(rows, "it's 1")
        table.append(rows.where("row_count = 0"), "two")
    table.append(rows.limit(0), "none")
    again = path_table(spark, root, rows, 4)
    assert again.rows().count() == 4 and again.hot() is None
    table.drop()
    assert again.rows().count() == 4


def test_empty_tables(spark):
    root = work_dir(spark, "t")
    control, history = _control(spark, []), _history(spark, [])
    c, h = _stored(spark, f"{root}/c", control, "file_path", 10), _stored(spark, f"{root}/h", history, "file_name", 10)
    assert bucketed_load_log(c, h).collect() == []


def test_stored_sides_are_not_shuffled(spark):
    root = work_dir(spark, "t")
    names = [f"a/{i}" for i in range(50)]
    c = _stored(spark, f"{root}/c", _control(spark, names), "file_path", 10)
    h = _stored(spark, f"{root}/h", _history(spark, names), "file_name", 10)
    known = KnownPaths(spark, f"{root}/k", 5)
    known.add(_control(spark, names), "1")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # at any size these are too large to broadcast
    try:
        log, new = _plan(bucketed_load_log(c, h)), _plan(known.duplicates(_control(spark, names[:3])))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in log and log.count("Bucketed: true") == 2
    stored_side = new[new.index("LeftOuter"):]
    stored_side = stored_side[stored_side.rindex("Sort ["):]
    assert "Bucketed: true" in stored_side and "Exchange" not in stored_side
    assert re.search(r"Exchange hashpartitioning", new)  # the new files are


def test_known_paths_equal_counting(spark):
    rng = random.Random(7)
    known, seen = KnownPaths(spark, work_dir(spark, "t"), 3), collections.Counter()
    for step in range(4):
        paths = [rng.choice([f"d/{i}" for i in range(30)] + [None, ""]) for _ in range(25)]
        files = spark.createDataFrame([(p,) for p in paths], "file_path string")
        here = collections.Counter(p for p in paths if p is not None)
        expected = {(p, n + seen[p]) for p, n in here.items() if n + seen[p] > 1}
        assert {tuple(r) for r in known.duplicates(files).collect()} == expected
        known.add(files, str(step))
        known.add(files, str(step))  # recorded again: counted once
        seen += here
