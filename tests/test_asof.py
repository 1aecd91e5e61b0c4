"""Templates by each file's own time, and unloads by file size."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stagecraft.operators.asof import template_at
from stagecraft.session import work_dir
from stagecraft.sources.stage import list_stage, unload, writers_for

FILES = "file_path string, copy_into_name string, start_time timestamp_ntz, version int"
TEMPLATES = "statement_name string, k int, options map<string,string>, effective timestamp_ntz, superseded timestamp_ntz"


def day(n):
    return None if n is None else dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def brute(files, templates):
    out = {}
    for path, name, at, _ in files:
        live = [t for t in templates if at is not None and name is not None and t[0] == name and t[3] is not None
                and t[3] <= at and (t[4] is None or t[4] > at)]
        out[path] = max(live, key=lambda t: t[3])[1] if live else None
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_holding_every_file_against_every_version(spark, seed):
    rng = random.Random(seed)
    names = ["hot", "a", "b", "none", None]
    templates = []
    for name in ("hot", "a", "b", None):
        starts = rng.sample(range(0, 60), 8)  # overlapping, nested, empty and inverted ranges; starts are different
        templates += [(name, len(templates) + i, {"x": "y"}, day(s), day(rng.choice([None, s, s - 3, s + rng.randint(1, 40)]))) for i, s in enumerate(starts)]
    templates += [("a", 999, None, None, None)]
    files = [(f"f{i}", rng.choices(names, [6, 2, 2, 1, 1])[0], day(rng.choice([None, *range(-5, 70)])), i) for i in range(400)]
    got = template_at(spark.createDataFrame(files, FILES).select("file_path", "copy_into_name", "start_time").repartition(5),
                      spark.createDataFrame(templates, TEMPLATES))
    rows = {r["file_path"]: r["version"]["k"] if r["version"] else None for r in got.collect()}
    assert rows == brute(files, templates)


def test_empty_sides_and_repeated_rows(spark):
    files = spark.createDataFrame([("f", "a", day(3)), ("f", "a", day(3)), (None, None, None)], "file_path string, copy_into_name string, start_time timestamp_ntz")
    templates = spark.createDataFrame([("a", 1, None, day(3), None)], TEMPLATES)
    assert sorted((r["file_path"] or "", r["version"]["k"] if r["version"] else 0) for r in template_at(files, templates).collect()) == [("", 0), ("f", 1), ("f", 1)]
    assert template_at(files.limit(0), templates).collect() == []
    assert [r["version"] for r in template_at(files, templates.limit(0)).collect()] == [None] * 3


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_unload_files_have_the_size(spark, kind):
    df = spark.range(20_000).select("id", F.concat(F.lit('a "quoted", text '), F.col("id")).alias("odd `name")).coalesce(1)
    path = work_dir(spark, "sized")
    unload(df, path, kind, target_bytes=100_000)
    sizes = [r["length"] for r in list_stage(spark, path).collect()]
    assert len(sizes) > 3 and all(50_000 <= s <= 200_000 for s in sizes)
    assert (spark.read.text(path).count()) == 20_000


def test_unload_size_arguments(spark):
    df = spark.range(3)
    assert writers_for(df.limit(0), "csv", {}, 10) == 1
    for args in ({"file_format": "parquet", "target_bytes": 5}, {"target_bytes": 0}, {"target_bytes": 5, "partition_by": ["id"]}):
        with pytest.raises(ValueError):
            unload(df, work_dir(spark, "no"), **args)
