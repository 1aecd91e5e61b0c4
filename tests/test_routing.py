"""Routing by a table of rules against the CASE form; places of JSON errors."""

import random
import time

import pytest
from pyspark.sql import functions as F

from stagecraft.operators import routing
from stagecraft.operators.manifest import route_files
from stagecraft.operators.routing import RULES_SCHEMA, route_by_rules, rule_index
from stagecraft.session import work_dir
from stagecraft.sources.loader import LoadTemplate, load_stage


def case_form(spark, files, rules):
    ordered = [(p, t) for _, p, t in sorted((r for r in rules if r[1] is not None), key=lambda r: (r[0], r[1]))]
    out = {}
    for at in range(0, len(ordered), 200):  # a CASE of many branches is cut up for the planner
        part = route_files(files.distinct(), ordered[at:at + 200])
        for r in part.where("copy_into_name IS NOT NULL").collect():
            out.setdefault(r["file_path"], r["copy_into_name"])
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_case_form(spark, seed):
    rng = random.Random(seed)
    parts = ["TPCH", "ORDERS", "a", "b_c", "x%y", "data", "été", "\\w", "1", "22", "2024-01"]
    paths = ["/".join(rng.choices(parts, k=rng.randint(1, 6))) + rng.choice(["", ".csv"]) for _ in range(300)] + ["", None, "a", None]

    def pattern():
        text = "/".join(rng.choices(parts, k=rng.randint(1, 3))).replace("\\", "\\\\")
        text = text.replace("%", rng.choice(["\\%", "%"])).replace("_", rng.choice(["\\_", "_"]))
        return rng.choice(["%", "", "_", "__%"]) + text + rng.choice(["%", "", "_%", ".csv"])
    rules = [(rng.randint(0, 80), pattern(), f"T{i}") for i in range(150)]
    rules += [(500, "%", "any"), (300, "____%", "four"), (299, "_", "one"), (10, None, "null"), (301, "", "empty")][:rng.randint(1, 5)]
    rules = list({(n, p): (n, p, t) for n, p, t in rules}.values())
    files = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "file_path string, k int")
    got = route_by_rules(files, spark.createDataFrame(rules, RULES_SCHEMA))
    assert got.columns == ["file_path", "k", "copy_into_name"]
    want = case_form(spark, files.select("file_path"), rules)
    rows = got.collect()
    assert len(rows) == len(paths)
    for r in rows:
        assert r["copy_into_name"] == want.get(r["file_path"]), r


def test_ten_thousand_rules(spark):
    """Each file meets few rules, whatever all rules have in common."""
    rules = spark.range(10_000).selectExpr("id AS rule_no", "concat('%/TPCH/ORDERS/region_', id, '/%') AS pattern", "concat('T', id) AS copy_into_name")
    files = spark.range(20_000).selectExpr("concat('s3://b/TPCH/ORDERS/region-', id % 12000, '/f', id, '.csv') AS file_path")
    index = rule_index(rules)
    assert index.count() == 10_000 and index.groupBy("piece").count().agg(F.max("count")).first()[0] <= 200
    begun = time.time()
    got = route_by_rules(files, rules)
    wrong = got.where("NOT copy_into_name <=> if(cast(regexp_extract(file_path, 'region-([0-9]+)', 1) as int) < 10000,"
                      " concat('T', regexp_extract(file_path, 'region-([0-9]+)', 1)), null)")
    assert wrong.isEmpty() and time.time() - begun < 60
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert route_by_rules(files, rules.limit(0)).where("copy_into_name IS NULL").count() == 20_000


def json_history(spark, lines, ddl):
    root = work_dir(spark, "json-places")
    out = {}
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").write.partitionBy("i").text(f"{root}/in")
    for r in load_stage(spark, f"{root}/in", LoadTemplate("J", "J", ddl, "json"), f"{root}/t", "j").collect():
        out[int(r["file_name"].split("/i=")[1].split("/")[0])] = (r["first_error_message"], r["first_error_col_name"], r["first_error_character_position"])
    return out


def test_json_errors_have_places(spark):
    ddl = "a bigint, b string, c double"
    cases = [
        ('{"a":1,"b":"x","c":2.5}', (None, None, None)),
        ('{"a":123,', ("Invalid JSON record", "A", 10)),             # a member is missing
        ('{"a":123', ("Invalid JSON record", "A", 9)),               # the brace is missing
        ('{"a":1,"b":"cut o', ("Invalid JSON record", "B", 12)),     # an open string: its start
        ('{"a":1,"b"', ("Invalid JSON record", "B", 11)),
        ('{"a":1,"b":', ("Invalid JSON record", "B", 12)),
        ('{"a":1 "b":"x"}', ("Invalid JSON record", "A", 8)),        # a comma is missing
        ('{"a":{"x":[1,{"y":"}"}]},"b":', ("Invalid JSON record", "B", 30)),
        ('  { "a" : 5 , "c" : oops }', ("Invalid JSON record", "C", 21)),
        ('nonsense', ("Invalid JSON record", None, 1)),
        ('{"b":"q,\\"{","a":"seven","c":1}', ("Value 'seven' is not a valid bigint for column A", "A", 18)),
        ('{"a":1, "c": "n/a"}', ("Value 'n/a' is not a valid double for column C", "C", 14)),
    ]
    got = json_history(spark, [c[0] for c in cases], ddl)
    for i, (line, want) in enumerate(cases):
        assert got[i] == want, line


def test_json_error_of_a_very_long_line(spark):
    long = '{"a":1,"b":"' + "x\\n" * 400_000 + '","c":'
    begun = time.time()
    got = json_history(spark, [long, '{"b":"' + "[" * 100_000], "a bigint, b string, c double")
    assert got[0] == ("Invalid JSON record", "C", len(long) + 1) and got[1] == ("Invalid JSON record", "B", 6) and time.time() - begun < 60


def test_no_side_that_grows_is_broadcast(spark):
    """However small the planner takes them for, pieces, rules and paths are shuffled; only the table of lengths is not."""
    rules = spark.createDataFrame([(n, f"%/f_{n % 7}.c%", f"T{n}") for n in range(40)] + [(50, "%", None), (51, "%", "late")], RULES_SCHEMA)
    files = spark.createDataFrame([(f"s3://b/f-{n}.csv",) for n in range(9)] + [(None,)], "file_path string")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan(rule_index(rules))
    got = route_by_rules(files, rules)
    assert plan(got).count("BroadcastExchange") <= 2
    names = {r["file_path"]: r["copy_into_name"] for r in got.collect()}
    assert names == {**{f"s3://b/f-{n}.csv": f"T{n}" for n in range(7)}, **{f"s3://b/f-{n}.csv": None for n in (7, 8)}, None: None}


def test_odd_letters_and_gaps(spark):
    """Marks of the index, letters of several bytes, line breaks and gaps of any width in paths and patterns."""
    parts = ["a", "b", "\u0001", "\u0002", "\u0003", "\n", "é", "\U0001f600", "%", "_", "abcdefghijklmnop", "1.csv"]
    rng = random.Random(7)
    paths = ["".join(rng.choices(parts, k=rng.randint(0, 8))) for _ in range(250)] + ["", None, "\u0002", "\u0003a", "a" * 5000]
    odd = ["%\u0002%", "\u0001%", "\u0002\u0003", "%\u0003", "a_b_c%", "%a____________b%", "_%a", "%_a_%", "a_%", "%_\n_%", "__é%", "%\\%\\_%",
           "%a_____________________p%", "abcdefghijklmnop", "%_____________b_____________%", "%ijklmnop_bcdefgh%", "%\U0001f600_", "_\U0001f600%a"]
    odd += ["%" + "".join(rng.choices(["a", "b", "_", "é", "\n", "\U0001f600", "abcdefghijklmnop", "%"], k=rng.randint(1, 5))) + rng.choice(["", "%"]) for _ in range(60)]
    rules = [(rng.randint(0, 60), p, f"T{i}") for i, p in enumerate(dict.fromkeys(odd))]
    files = spark.createDataFrame([(p,) for p in paths], "file_path string")
    want = case_form(spark, files, rules)
    for r in route_by_rules(files, spark.createDataFrame(rules, RULES_SCHEMA)).collect():
        assert r["copy_into_name"] == want.get(r["file_path"]), r


def shuffled_rows(plan):
    """Rows written by the shuffles of a plan that has run."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled_rows(plan.children().apply(i)) for i in range(plan.children().size()))


def test_pieces_that_no_rule_has_are_not_shuffled(spark):
    """Rules of many lengths: a path has some hundred pieces of these, and few of them are a rule's."""
    rules = spark.range(2_000).selectExpr("id AS rule_no", "concat('%/data_', id * id, if(id % 2 = 0, '%', '.csv')) AS pattern", "concat('T', id) AS copy_into_name")
    files = spark.range(5_000).selectExpr("concat('s3://bucket/TPCH/ORDERS/data_', id, '.csv') AS file_path")
    got = route_by_rules(files, rules)
    assert sum(r["copy_into_name"] is not None for r in got.collect()) > 70
    assert shuffled_rows(got._jdf.queryExecution().executedPlan()) < 12 * 5_000


def test_slices(spark, monkeypatch):
    """In slices every row comes once, as in one go; the listing kept for them and their shuffles are gone then."""
    rules = spark.createDataFrame([(n, f"%/d_{n}.c%", f"T{n}") for n in range(40)] + [(90, "%7.csv", "seven"), (91, "__%", "two")], RULES_SCHEMA)
    rows = [(f"s3://b/d-{n % 60}.csv", n) for n in range(200)] + [(None, 200), (None, 201), ("", 202), ("x", 203)]
    files = spark.createDataFrame(rows, "file_path string, k int")
    want = sorted(route_by_rules(files, rules).collect(), key=lambda r: r["k"])
    made = []
    monkeypatch.setattr(routing, "work_dir", lambda *a: made.append(work_dir(*a)) or made[-1])
    monkeypatch.setattr(routing, "SLICE", 50)
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {x for x in store.getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}
    before = shuffles()
    got = route_by_rules(files, rules)
    until = time.time() + 30
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert sorted(got.collect(), key=lambda r: r["k"]) == want and got.columns == ["file_path", "k", "copy_into_name"] and len(want) == 204
    assert [routing.path_exists(spark, p) for p in made] == [False, True]
    monkeypatch.setattr(routing, "SLICES", 2)
    assert sorted(route_by_rules(files.select("file_path"), rules).collect(), key=str) == sorted([(r[0], r[2]) for r in want], key=str)
