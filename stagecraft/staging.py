"""Stage the driver's tables as files, the way the test runs of a bulk load
start: a stage prefix holding CSV and JSON files per target.

Layout below ``root``:

    TPCH/ORDERS/month=YYYY-MM/part-*.csv     orders with priority 1-URGENT or 5-LOW
    TPCH/JORDERS/month=YYYY-MM/part-*.json   orders with priority 2-HIGH, JSON lines
    TPCH/LINEITEM/month=YYYY-MM/part-*.csv   all of lineitem
    TPCH/OTHER/month=YYYY-MM/part-*.csv      other orders (no route matches)
    TPCH/ALLJSON/month=YYYY-MM/part-*.json   all orders as JSON lines (on demand)

Each month directory holds exactly one file with its lines sorted by key,
so per-file results are reproducible. ``stage_odd_files`` adds
``TPCH/ODD/month=YYYY-MM/`` with an empty file and two hidden-named ones. Bad lines are seeded by a rule on the
data (status 'P'): in ORDERS, 1-URGENT rows lose all but two fields and
5-LOW rows get the total price 'n/a'; in JORDERS the JSON text is cut off.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import fixtures as fx
from .sources.loader import LoadTemplate
from .session import write_text
from .sources.tables import templates_table

ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")
LINEITEM_DDL = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# Routing rules of the staged layout (first match wins).
STAGE_ROUTES = [
    ("%/TPCH/ORDERS/%", "ORDERS"),
    ("%/TPCH/JORDERS/%", "JORDERS"),
    ("%/TPCH/LINEITEM/%", "LINEITEM"),
]


def template_rows(on_error: str = "continue") -> list[dict]:
    """Templates for the staged layout, valid since 1990."""
    since = dt.datetime(1990, 1, 1)
    return [
        {"statement_name": "ORDERS", "target": "ORDERS", "file_format": "csv",
         "schema_ddl": ORDERS_DDL, "on_error": on_error, "effective": since},
        {"statement_name": "JORDERS", "target": "JORDERS", "file_format": "json",
         "schema_ddl": ORDERS_DDL, "options": {"timestampNTZFormat": TS_TEXT},
         "on_error": on_error, "effective": since},
        {"statement_name": "LINEITEM", "target": "LINEITEM", "file_format": "csv",
         "schema_ddl": LINEITEM_DDL, "on_error": on_error, "effective": since},
    ]


def load_templates(spark: SparkSession, on_error: str = "continue") -> DataFrame:
    return templates_table(spark, template_rows(on_error))


def template(name: str, on_error: str = "continue") -> LoadTemplate:
    row = next(r for r in template_rows(on_error) if r["statement_name"] == name)
    return LoadTemplate.from_row(row)


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def orders_csv_line(bad: bool = True) -> Column:
    fields = [_text("o_orderkey"), _text("o_custkey"), F.col("o_orderstatus"), _text("o_totalprice"),
              F.date_format("o_orderdate", TS_TEXT), F.col("o_orderpriority")]
    line = F.concat_ws(",", *fields)
    if not bad:
        return line
    p = F.col("o_orderstatus") == "P"
    short = F.concat_ws(",", _text("o_orderkey"), _text("o_custkey"))
    na_price = F.concat_ws(",", fields[0], fields[1], fields[2], F.lit("n/a"), fields[4], fields[5])
    return (F.when(p & (F.col("o_orderpriority") == "1-URGENT"), short)
            .when(p & (F.col("o_orderpriority") == "5-LOW"), na_price)
            .otherwise(line))


def orders_json_line() -> Column:
    js = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                            F.date_format("o_orderdate", TS_TEXT).alias("o_orderdate"), "o_orderpriority"))
    cut = F.concat(F.lit('{"o_orderkey":'), _text("o_orderkey"), F.lit(","))
    return F.when(F.col("o_orderstatus") == "P", cut).otherwise(js)


def lineitem_csv_line() -> Column:
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax"]
    return F.concat_ws(",", *[_text(c) for c in cols], F.col("l_returnflag"), F.col("l_linestatus"),
                       F.date_format("l_shipdate", TS_TEXT))


def _month(c: str) -> Column:
    """Year and month, cut from the text that the line has already."""
    return F.substring_index(F.date_format(c, TS_TEXT), "-", 2).alias("month")


def _write_dirs(lines: DataFrame, path: str) -> None:
    """One file per month directory, lines in key order.

    This builds test input with a fixed layout (one file per month, so that
    per-file results can be checked); it is not a library operator. Unloads
    use ``sources.stage.unload``, which writes one file per task.
    """
    (lines.repartition("month").sortWithinPartitions("month", "_key")
     .select("value", "month").write.mode("overwrite").partitionBy("month").text(path))


def stage_tables(spark: SparkSession, sf_dir: str, root: str,
                 routes: tuple[str, ...] = ("ORDERS", "JORDERS", "OTHER", "LINEITEM")) -> str:
    """Write the staged layout (the given route directories) below ``root``;
    returns the stage prefix. The route directories are written side by side."""
    orders = fx.base_table(spark, sf_dir, "orders")
    month = _month("o_orderdate")
    key = F.col("o_orderkey").alias("_key")
    stage = f"{root.rstrip('/')}/TPCH"
    jobs = {}
    if "ORDERS" in routes:
        routed = orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
        jobs["ORDERS"] = routed.select(orders_csv_line().alias("value"), month, key)
    if "JORDERS" in routes:
        jorders = orders.where(F.col("o_orderpriority") == "2-HIGH")
        jobs["JORDERS"] = jorders.select(orders_json_line().alias("value"), month, key)
    if "OTHER" in routes:
        other = orders.where(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"))
        jobs["OTHER"] = other.select(orders_csv_line(bad=False).alias("value"), month, key)
    if "ALLJSON" in routes:
        jobs["ALLJSON"] = orders.select(orders_json_line().alias("value"), month, key)
    if "LINEITEM" in routes:
        lineitem = fx.base_table(spark, sf_dir, "lineitem")
        li_key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        jobs["LINEITEM"] = lineitem.select(lineitem_csv_line().alias("value"),
                                           _month("l_shipdate"),
                                           li_key.alias("_key"))
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        list(pool.map(lambda kv: _write_dirs(kv[1], f"{stage}/{kv[0]}"), jobs.items()))
    return stage


def stage_odd_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """For every month of orders a folder with an empty file and two whose names readers pass over.

    Test input: one folder a month, written by the driver.
    """
    months = fx.base_table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("m")).distinct()
    for r in months.collect():
        folder = f"{root.rstrip('/')}/TPCH/ODD/month={r['m']}"
        for name, text in (("empty.csv", ""), ("_note.csv", r["m"]), (".draft.csv", r["m"])):
            write_text(spark, f"{folder}/{name}", text)
    return f"{root.rstrip('/')}/TPCH"


def stage_events(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Events as CSV files, one per day directory (input of the stream run)."""
    ev = fx.base_table(spark, sf_dir, "events")
    line = F.concat_ws(",", _text("event_id"), F.date_format("ts", TS_TEXT), _text("user_id"),
                       F.col("event_type"), _text("value"),
                       F.concat(F.lit('"'), F.regexp_replace("props", '"', '""'), F.lit('"')))
    path = f"{root.rstrip('/')}/EVENTS"
    _write_dirs(ev.select(line.alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("month"),
                          F.col("event_id").alias("_key")), path)
    return path
