"""Scalar functions: path key, listing time, progress bar, size lookup, time differences."""

import datetime as dt

import pytest

from stagecraft.functions import (last_modified_to_timestamp, minutes_between, nodes_per_warehouse,
                                  progress_bar, seconds_between, stage_path_shorten, thousands_text)

# Path table: input -> expected key (None = no key).
PATHS = [
    ("s3://b/TPCH/o/1.csv", "TPCH/o/1.csv"),
    ("S3://b/x", "x"),
    ("s3://bucketonly", "s3://bucketonly"),
    ("pre/s3://b/x/y", "x/y"),
    ("azure://acct.blob/cont/p/q.csv", "cont/p/q.csv"),
    ("stages/abc/TPCH/x.csv", "TPCH/x.csv"),
    ("@~/stages/abc/d/x", "d/x"),
    ("stagesab12-ab12-ab12-ab12-abcdefabcdef/TPCH/x.csv", "TPCH/x.csv"),
    ("mystage/TPCH/x.csv", "TPCH/x.csv"),
    ("gcs://bkt/p/x", "/bkt/p/x"),
    ("s3://azure://a/b/c", "/a/b/c"),
    ("stages/only", "stages/only"),
    ("noslash", None),
    ("", None),
    (None, None),
]


def test_stage_path_shorten(spark):
    df = spark.createDataFrame([(p,) for p, _ in PATHS], "p string")
    got = [r[0] for r in df.select(stage_path_shorten("p")).collect()]
    assert got == [e for _, e in PATHS]


def test_stage_path_shorten_sql_matches_duckdb(duck_small):
    from stagecraft.functions.paths import stage_path_shorten_sql
    for p, expected in PATHS:
        if p is None:
            continue
        lit = "'" + p.replace("'", "''") + "'"
        assert duck_small.sql(f"select {stage_path_shorten_sql(lit)}").fetchall()[0][0] == expected, p


def test_last_modified_to_timestamp(spark):
    df = spark.createDataFrame([("Wed, 8 Sep 2021 15:22:01 GMT",), ("Mon, 27 Dec 1999 00:00:00 GMT",)], "t string")
    got = [r[0] for r in df.select(last_modified_to_timestamp("t")).collect()]
    assert got == [dt.datetime(2021, 9, 8, 15, 22, 1), dt.datetime(1999, 12, 27, 0, 0, 0)]


@pytest.mark.parametrize("pct, filled, text", [
    (33.333333, 3, "33.33%"), (-5.0, 0, "0.00%"), (250.0, 10, "100.00%"), (float("nan"), 0, "0.00%"),
    (66.6, 7, "66.60%"), (100.0, 10, "100.00%"), (0.0, 0, "0.00%"),
])
def test_progress_bar(spark, pct, filled, text):
    df = spark.createDataFrame([(pct,)], "p double")
    bar = df.select(progress_bar("p")).first()[0]
    assert bar == "⬛" * filled + "⬜" * (10 - filled) + " " + text


def test_progress_bar_null_and_options(spark):
    df = spark.createDataFrame([(None,), (37.5,)], "p double")
    got = [r[0] for r in df.select(progress_bar("p", 1, 12)).collect()]
    assert got[0] is None
    assert got[1] == "⬛" * 5 + "⬜" * 7 + " 37.5%"   # round(12 * 0.375) = round(4.5) = 5


def test_nodes_per_warehouse(spark):
    names = ["x-small", "XS", "Small", "m", "LARGE", "xl", "2X-Large", "3xl", "4XLARGE", "5xl", "6X-LARGE",
             "XXLARGE", None, "huge"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(nodes_per_warehouse("n")).collect()]
    assert got == [1, 1, 2, 4, 8, 16, 32, 64, 128, 256, 512, None, None, None]


def test_minutes_and_seconds_count_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 1, 0, 0, 59), dt.datetime(2021, 1, 1, 0, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    m, s = df.select(minutes_between("a", "b"), seconds_between("a", "b")).first()
    assert (m, s) == (1, 2)


def test_thousands_text(spark):
    df = spark.createDataFrame([(0,), (1234567,)], "n long")
    got = [r[0] for r in df.select(thousands_text("n")).collect()]
    assert got == [" " * 22 + "0", " " * 14 + "1,234,567"]


def test_progress_bar_matches_sql_on_random_values(spark, duck_small):
    import random
    from stagecraft.functions.text import progress_bar_sql
    rng = random.Random(2)
    values = [rng.random() * 200 - 50 for _ in range(300)] + [0.0, 100.0, -1.0, 101.0]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    for decimals, segments in ((2, 10), (0, 12), (3, 100)):
        got = [r[0] for r in df.select(progress_bar("p", decimals, segments)).collect()]
        rows = ", ".join(f"({i}, {v!r}::double)" for i, v in enumerate(values))
        sql = (f"select {progress_bar_sql('p', decimals, segments)} from (values {rows}) t(i, p) order by i")
        want = [r[0] for r in duck_small.sql(sql).fetchall()]
        assert got == want, (decimals, segments)


def test_stage_path_shorten_matches_sql_on_random_paths(spark, duck_small):
    import random
    from stagecraft.functions.paths import stage_path_shorten_sql
    rng = random.Random(4)
    tokens = ["s3://", "S3://", "azure://", "AZURE://", "stages/", "Stages/", "/", "a", "bc", "x.csv", "@~",
              "stagesab12-ab12-ab12-ab12-abcdefabcdef/", "stagesABCD12-ab12-ab12-ab12-abcdefabcdef", "gcs://"]
    paths = sorted({"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))) for _ in range(500)})
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = {r.p: r.k for r in df.select("p", stage_path_shorten("p").alias("k")).collect()}
    rows = ", ".join("('" + p.replace("'", "''") + "')" for p in paths)
    want = {p: k for p, k in duck_small.sql(f"select p, {stage_path_shorten_sql('p')} from (values {rows}) t(p)").fetchall()}
    assert got == want
