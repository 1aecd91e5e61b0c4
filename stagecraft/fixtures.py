"""Fixture views derived from the driver's tables.

One order stands for one staged file. The same SQL text builds each view in
Spark (as a DataFrame) and in DuckDB (as a CTE of an oracle query); only the
timestamp type name differs. ``NOW`` is the fixed clock of every fixture
query so that results can be compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NOW = "2001-08-01 00:00:00"
BASE_TABLES = ("orders", "lineitem", "customer", "events")

# Fixed routing rules of the fixture: first matching pattern names the template.
ROUTES = [
    ("%/TPCH/ORDERS/%", "ORDERS"),
    ("%/TPCH/JORDERS/%", "JORDERS"),
    ("%/TPCH/LINEITEM/%", "LINEITEM"),
]

_ROUTE_DIR = ("case o_orderpriority when '1-URGENT' then 'ORDERS' when '2-HIGH' then 'JORDERS' "
              "when '3-MEDIUM' then 'LINEITEM' when '5-LOW' then 'ORDERS' else 'OTHER' end")

_VIEWS = {
    "listing": f"""
select concat(case o_custkey % 5 when 0 then 's3://bucket/' when 1 then 'azure://acct/'
                when 2 then 'stages/ab12/'
                when 3 then 'stagesab12-ab12-ab12-ab12-abcdefabcdef/' else 'test_stage/' end,
              'TPCH/', {_ROUTE_DIR}, '/data_', cast(o_orderkey as string), '.csv') as file_path,
       concat('TPCH/', {_ROUTE_DIR}, '/data_', cast(o_orderkey as string), '.csv') as short_path,
       o_orderkey, o_custkey, o_orderstatus, o_orderdate,
       cast(round(o_totalprice * 100) as bigint) as file_size
from {{orders}}
""",
    "control": """
select file_path,
       case when file_path like '%/TPCH/ORDERS/%' then 'ORDERS'
            when file_path like '%/TPCH/JORDERS/%' then 'JORDERS'
            when file_path like '%/TPCH/LINEITEM/%' then 'LINEITEM' end as copy_into_name,
       o_orderdate as ingestion_order,
       case when o_orderstatus = 'F' then 'LOADED' when o_orderstatus = 'O' then 'WAITING'
            when o_custkey % 3 = 0 then 'LOADING' when o_custkey % 3 = 1 then 'LOAD_FAILED'
            else 'SUSPENDED' end as ingestion_status,
       case when o_orderstatus = 'P' then o_custkey % 7 end as owner_session,
       cast(null as string) as exec_uuid,
       cast(o_custkey % 4 as int) as try_count,
       case when o_orderstatus <> 'O' then o_orderdate end as start_time,
       case when o_orderstatus = 'F' then o_orderdate end as end_time,
       file_size,
       case when o_orderstatus = 'P' and o_custkey % 3 = 1 then 'bad value'
            when o_orderstatus = 'F' then '' end as error_msg
from {listing}
""",
    "history": """
select concat('s3://archive/', l.short_path) as file_name,
       count(*) as row_parsed,
       sum(case when i.l_returnflag <> 'R' then 1 else 0 end) as row_count,
       sum(case when i.l_returnflag = 'R' then 1 else 0 end) as error_count,
       min(case when i.l_returnflag = 'R' then i.l_linenumber end) as first_error_line_number
from {lineitem} i join {listing} l on i.l_orderkey = l.o_orderkey
group by l.short_path
""",
    "templates": """
select * from (values
  ('ORDERS',   'v1', {TS} '1990-01-01 00:00:00', {TS} '1995-01-01 00:00:00'),
  ('ORDERS',   'v2', {TS} '1995-01-01 00:00:00', cast(null as {TSTYPE})),
  ('JORDERS',  'v1', {TS} '1990-01-01 00:00:00', {TS} '2010-01-01 00:00:00'),
  ('LINEITEM', 'v1', {TS} '2005-01-01 00:00:00', cast(null as {TSTYPE}))
) as t(statement_name, statement_text, effective, superseded)
""",
    # Listing as the stage LIST command prints it: name, last-modified text, size.
    "listing_text": """
select file_path as name, {LISTING_TEXT} as last_modified, file_size as size
from {listing}
""",
}

# Views each view reads (besides base tables).
_DEPENDS = {
    "listing": [], "control": ["listing"], "history": ["listing"], "templates": [],
    "listing_text": ["listing"],
}


def _dialect_sql(name: str, dialect: str) -> str:
    sql = _VIEWS[name]
    if dialect == "spark":
        ts, tstype = "timestamp_ntz", "timestamp_ntz"
        listing_text = "concat(date_format(o_orderdate, 'EEE, d MMM yyyy HH:mm:ss'), ' GMT')"
    else:
        ts, tstype = "timestamp", "timestamp"
        listing_text = "strftime(o_orderdate, '%a, %-d %b %Y %H:%M:%S') || ' GMT'"
    return sql.replace("{TS}", ts).replace("{TSTYPE}", tstype).replace("{LISTING_TEXT}", listing_text)


def now_sql(dialect: str) -> str:
    return f"timestamp_ntz '{NOW}'" if dialect == "spark" else f"timestamp '{NOW}'"


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in _DEPENDS[n]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def oracle_with(*names: str) -> str:
    """DuckDB ``with`` clause defining the named fixture views (and what they need)."""
    parts = []
    for n in _closure(names):
        sql = _dialect_sql(n, "duckdb")
        for t in BASE_TABLES + tuple(_VIEWS):
            sql = sql.replace("{" + t + "}", t)
        parts.append(f"{n} as ({sql.strip()})")
    return "with " + ",\n".join(parts) + "\n"


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named fixture view as a Spark DataFrame."""
    built: dict[str, DataFrame] = {}
    for n in _closure([name]):
        sql = _dialect_sql(n, "spark")
        kwargs = {}
        for t in BASE_TABLES:
            if "{" + t + "}" in sql:
                kwargs[t] = base_table(spark, sf_dir, t)
        for v, df in built.items():
            if "{" + v + "}" in sql:
                kwargs[v] = df
        built[n] = spark.sql(sql, **kwargs)
    return built[name]
