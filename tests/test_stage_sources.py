"""Listings and streams of whole stages: odd names, restarts, changed files."""

import os
import re

import pytest
from pyspark.sql import functions as F

from stagecraft import staging
from stagecraft.functions.paths import hidden_name, is_hidden
from stagecraft.operators.manifest import build_manifest, listing_from_stage
from stagecraft.plans.ingest import file_ingest
from stagecraft.sources import listing
from stagecraft.sources.loader import HIDDEN_FILE, load_stage, read_history, read_target
from stagecraft.sources.stage import _name_pattern, list_stage
from stagecraft.sources.tables import ManifestStore
from stagecraft.streaming.stage import NO_ROUTE, drain_stage

LINE = "%d,1,O,2.5,2020-01-01T00:00:00.000000,1-URGENT\n"
NAMES = ["a/x.csv", "a/_y.csv", "a/.z.csv", "a/deep/er/empty.csv", "b c/w[1].csv", "100%41+p.csv", "é/{s}.csv"]


def staged(tmp_path, names=NAMES):
    for k, n in enumerate(names):
        f = tmp_path / "stage" / n
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("" if "empty" in n else LINE % k)
    (tmp_path / "stage" / "_SUCCESS").write_text("")
    return str(tmp_path / "stage")


def short(rows):
    return {r["path"].split("/stage/")[1]: r["length"] for r in rows}


@pytest.mark.parametrize("form", ["{}", "file://{}", "file:{}", "{}/"])
def test_listing_is_complete(spark, tmp_path, form):
    stage = staged(tmp_path)
    rows = list_stage(spark, form.format(stage)).collect()
    assert short(rows) == {n: 0 if "empty" in n else len(LINE % 0) for n in NAMES}
    assert all(r["path"].startswith("file:/") for r in rows)
    seen = {r["path"]: (r["modificationTime"], r["length"]) for r in
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(stage).drop("content").collect()}
    mine = {r["path"]: (r["modificationTime"], r["length"]) for r in rows}
    assert set(seen) < set(mine)  # the same names and sizes as Spark's own, and more files
    assert all(mine[p][1] == s[1] and abs((mine[p][0] - s[0]).total_seconds()) < 0.01 for p, s in seen.items())


def test_listing_of_several_prefixes_and_globs(spark, tmp_path):
    stage = staged(tmp_path)
    both = list_stage(spark, [f"{stage}/a", f"{stage}/b c", f"{stage}/a"])
    assert sorted(short(both.collect())) == sorted(n for n in NAMES if n[:2] in ("a/", "b "))
    assert sorted(short(list_stage(spark, stage, "{x,w*}.csv").collect())) == ["a/x.csv", "b c/w[1].csv"]
    assert short(list_stage(spark, f"{stage}/a", "[!_.e]*").collect()) == {"a/x.csv": len(LINE % 0)}
    with pytest.raises(Exception, match="no such stage prefix"):
        list_stage(spark, f"{stage}/none").collect()


@pytest.mark.parametrize("glob,names", [("*.csv", ["a.csv"]), ("a?", ["ab"]), ("[ab]*", ["a.csv", "ab"]), ("{ab,x}", ["ab"]), ("a.c{s,t}v", ["a.csv"])])
def test_name_patterns(glob, names):
    assert [n for n in ("a.csv", "ab", "c") if re.fullmatch(_name_pattern(glob), n)] == names


def test_folders_are_shared_out_once(tmp_path):
    stage = staged(tmp_path, [f"d{i}/e{j}/f{k}.csv" for i in range(3) for j in range(3) for k in range(2)] + ["d0/top.csv"])
    for wanted in (1, 2, 4, 9, 100):
        found = [f[0] for p in listing._share_out([stage], wanted) for f in listing._walk(p.uri, p.below)]
        assert len(found) == len(set(found)) == 19, wanted


def test_hidden_names_agree(spark):
    names = ["s/_x", "s/_a=1", "s/.x", "s/x._COPYING_", "s/x", "x_", "_x", ".x", "s/a.b"]
    rows = spark.createDataFrame([(n,) for n in names], "p string").select("p", hidden_name("p").alias("h")).collect()
    assert [r["p"] for r in rows if r["h"]] == [n for n in names if is_hidden(n)] == ["s/_x", "s/.x", "s/x._COPYING_", "_x", ".x"]


def test_runs_see_empty_and_hidden_files(spark, tmp_path):
    stage = staged(tmp_path)
    tpl = staging.template("ORDERS")
    history = {r["file_name"].split("/stage/")[1]: r for r in load_stage(spark, stage, tpl, f"{tmp_path}/t", "one").collect()}
    assert set(history) == set(NAMES)
    for n, r in history.items():
        hidden = is_hidden(n)
        assert (r["status"], r["row_count"]) == ("LOAD_FAILED" if hidden else "LOADED", 0 if hidden or "empty" in n else 1)
        assert r["first_error_message"] == (HIDDEN_FILE if hidden else None)
    control = build_manifest(listing_from_stage(list_stage(spark, stage)), [("%", "ORDERS")])
    store = ManifestStore.create(spark, f"{tmp_path}/m", control)
    file_ingest(spark, store, staging.load_templates(spark), target_root=f"{tmp_path}/t2", history_path=f"{tmp_path}/h2")
    final = {r["file_path"].split("/stage/")[1]: (r["ingestion_status"], r["file_size"]) for r in store.read().collect()}
    assert final == {n: ("LOAD_FAILED" if is_hidden(n) else "LOADED", 0 if "empty" in n else len(LINE % 0)) for n in NAMES}


ROUTES = [("%/a/%", "ORDERS"), ("%/j/%", "JORDERS"), ("%/g/%", "GONE")]


def drain(spark, tmp_path, **options):
    drain_stage(spark, f"{tmp_path}/stage", ROUTES, staging.load_templates(spark), target_root=f"{tmp_path}/target",
                history_path=f"{tmp_path}/history", checkpoint_path=f"{tmp_path}/checkpoint", **options)
    return {r["file_name"].split("/stage/")[1]: r for r in read_history(spark, f"{tmp_path}/history").collect()}


def test_stream_restarts_and_takes_every_file_once(spark, tmp_path):
    staged(tmp_path, ["a/1.csv", "a/2.csv", "a/empty.csv", "a/_h.csv", "g/x.csv", "else/y.csv"])
    (tmp_path / "stage" / "j").mkdir()
    (tmp_path / "stage" / "j" / "1.json").write_text('{"o_orderkey":77}\n')
    got = drain(spark, tmp_path, max_files_per_trigger=2)
    assert {n: r["status"] for n, r in got.items()} == {"a/1.csv": "LOADED", "a/2.csv": "LOADED", "a/empty.csv": "LOADED", "a/_h.csv": "LOAD_FAILED",
                                                       "j/1.json": "LOADED", "g/x.csv": "LOAD_FAILED", "else/y.csv": "LOAD_FAILED"}
    assert got["else/y.csv"]["first_error_message"] == NO_ROUTE and "GONE" in got["g/x.csv"]["first_error_message"]
    assert got["a/empty.csv"]["row_count"] == 0
    steps = {r["load_id"] for r in got.values()}
    entries = sorted(os.listdir(f"{tmp_path}/checkpoint/stage-files"))
    assert len([e for e in entries if e.endswith(".json")]) == 4 and len(steps) >= 4  # seven files, two a step
    again = drain(spark, tmp_path, max_files_per_trigger=2)
    assert {n: r["load_id"] for n, r in again.items()} == {n: r["load_id"] for n, r in got.items()}
    staged(tmp_path, ["a/3.csv"])
    later = drain(spark, tmp_path, max_files_per_trigger=2)
    assert set(later) - set(got) == {"a/3.csv"}
    rows = read_target(spark, f"{tmp_path}/target/ORDERS", staging.ORDERS_DDL).select("o_orderkey").collect()
    assert sorted(r[0] for r in rows) == [0, 0, 1]


def test_stream_runs_a_step_again_without_doubling(spark, tmp_path):
    """The query's record of its last step is lost: the step's log entry is still there and replaces what it landed."""
    staged(tmp_path, ["a/1.csv", "a/2.csv"])
    first = drain(spark, tmp_path)
    commits = tmp_path / "checkpoint" / "query" / "commits"
    for f in commits.iterdir():
        if f.name.lstrip(".").startswith("0"):
            f.unlink()
    again = drain(spark, tmp_path)
    assert {n: r["load_id"] for n, r in again.items()} == {n: r["load_id"] for n, r in first.items()}
    assert read_target(spark, f"{tmp_path}/target/ORDERS", staging.ORDERS_DDL).count() == 2


def test_stream_takes_newest_first(spark, tmp_path):
    stage = staged(tmp_path, ["a/old.csv", "a/new.csv"])
    os.utime(f"{stage}/a/old.csv", (1, 1))
    got = drain(spark, tmp_path, max_files_per_trigger=1, newest_first=True)
    assert got["a/new.csv"]["load_id"] < got["a/old.csv"]["load_id"]
