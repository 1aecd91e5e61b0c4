"""Registered queries and their DuckDB oracles.

Each query takes (spark, sf_dir) and returns a DataFrame over the driver's
tables (or over fixture views derived from them). The oracle is ANSI SQL
that DuckDB runs on the same parquet tables; fixture views become CTEs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import fixtures as fx
from .functions.paths import (last_modified_to_timestamp, stage_path_shorten, stage_path_shorten_sql)
from .functions.text import progress_bar, progress_bar_sql
from .functions.warehouse import NODES_BY_SIZE, nodes_per_warehouse, nodes_per_warehouse_sql
from .operators import asof, batches, manifest, monitor, routing, sizing, transitions
from .session import materialize, work_dir
from .sources import buckets
from .sources.tables import write_templates

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the fixture runs (the reference's smoke-test call uses
# 8 files at once and 3 tries, ascending order).
FILES_AT_ONCE = 8
TRIES = 3
SORT = "ASC"
RUN_ID = "run-0001"
OWNER = 42
STUCK_MINUTES = 60

D_NOW = fx.now_sql("duckdb")
ORDER_SQL = "ingestion_order asc nulls last, file_path asc"


def _now():
    return F.expr(fx.now_sql("spark"))


def _fix(spark, sf, name):
    return fx.fixture(spark, sf, name)


def _route_sql(col: str) -> str:
    whens = " ".join(f"when {col} like '{p}' then '{n}'" for p, n in fx.ROUTES)
    return f"case {whens} end"


def _short(col: str) -> str:
    return stage_path_shorten_sql(col, "duckdb")


_CONTROL_COLS = ("file_path, copy_into_name, ingestion_order, ingestion_status, owner_session, "
                 "exec_uuid, try_count, start_time, end_time, file_size, error_msg")

_D_VALID_TEMPLATES = f"""
valid_templates as (
  select * from (
    select *, row_number() over (partition by statement_name order by effective desc) as _r
    from templates
    where effective <= {D_NOW} and (superseded is null or superseded > {D_NOW})) where _r = 1)
"""

_D_ROUTABLE = f"""
routable as (
  select * from control
  where ingestion_status = 'WAITING' and try_count < {TRIES} and copy_into_name is not null
    and copy_into_name in (select statement_name from valid_templates))
"""

_D_PLAN = f"""
ranked as (
  select file_path, copy_into_name, ingestion_order, try_count, file_size,
         row_number() over (partition by copy_into_name order by {ORDER_SQL}) as file_rank
  from routable),
chunked as (select *, cast((file_rank - 1) // {FILES_AT_ONCE} as bigint) as chunk_no from ranked),
heads as (
  select copy_into_name, chunk_no, row_number() over (order by {ORDER_SQL}) as batch_no
  from chunked where (file_rank - 1) % {FILES_AT_ONCE} = 0),
plan as (
  select h.batch_no, c.copy_into_name, c.file_path, c.ingestion_order, c.file_rank, c.try_count, c.file_size
  from chunked c join heads h on c.copy_into_name = h.copy_into_name and c.chunk_no = h.chunk_no)
"""


def _with(*views: str, extra: str = "") -> str:
    w = fx.oracle_with(*views).rstrip()
    if extra:
        w += ",\n" + extra.strip()
    return w + "\n"


# ---------------------------------------------------------------- functions

def q_shorten_paths(spark, sf):
    listing = _fix(spark, sf, "listing").select(F.col("file_path").alias("path"))
    history = _fix(spark, sf, "history").select(F.col("file_name").alias("path"))
    paths = listing.unionByName(history)
    return paths.select("path", stage_path_shorten("path").alias("stage_path"))


# The fixture knows each path's key: it is what was put behind a prefix.
O_SHORTEN_PATHS = _with("listing", "history") + """
select file_path as path, short_path as stage_path from listing
union all
select 's3://archive/' || l.short_path, l.short_path from listing l
 where 's3://archive/' || l.short_path in (select file_name from history)
"""


def q_parse_last_modified(spark, sf):
    lt = _fix(spark, sf, "listing_text")
    return lt.select("name", "last_modified", last_modified_to_timestamp("last_modified").alias("modified_at"))


_D_PARSE = "strptime(left(last_modified, length(last_modified) - 4), '%a, %d %b %Y %H:%M:%S')"
O_PARSE_LAST_MODIFIED = _with("listing_text") + f"""
select name, last_modified, {_D_PARSE} as modified_at from listing_text
"""


def q_progress_bar(spark, sf):
    c = _fix(spark, sf, "control")
    pct = (F.try_divide(F.sum(F.when(F.col("ingestion_status") == "LOADED", F.col("file_size"))),
                        F.sum("file_size")) * F.lit(100.0))
    g = (c.groupBy("copy_into_name", F.year("ingestion_order").alias("order_year"))
         .agg(pct.alias("percent_complete")))
    return g.select("copy_into_name", "order_year", "percent_complete",
                    progress_bar("percent_complete").alias("bar"),
                    progress_bar("percent_complete", 1, 20).alias("bar_wide"),
                    progress_bar(F.col("percent_complete") * 3 - 50, 0, 12).alias("bar_clamped"))


O_PROGRESS_BAR = _with("control") + f"""
select copy_into_name, order_year, percent_complete,
       {progress_bar_sql('percent_complete')} as bar,
       {progress_bar_sql('percent_complete', 1, 20)} as bar_wide,
       {progress_bar_sql('(percent_complete * 3 - 50)', 0, 12)} as bar_clamped
from (
  select copy_into_name, cast(year(ingestion_order) as integer) as order_year,
         sum(case when ingestion_status = 'LOADED' then file_size end) / sum(file_size) * 100.0
           as percent_complete
  from control group by copy_into_name, year(ingestion_order)) g
"""

# Size names applied to every order: the known names plus two unknown ones,
# in mixed case, so that the lookup is case-insensitive and null-safe.
_SIZE_NAMES = list(NODES_BY_SIZE) + ["XXLARGE", "huge"]


def q_nodes_lookup(spark, sf):
    o = fx.base_table(spark, sf, "orders")
    names = F.array(*[F.lit(n) for n in _SIZE_NAMES])
    name = F.element_at(names, (F.col("o_orderkey") % len(_SIZE_NAMES) + 1).cast("int"))
    name = F.when(F.col("o_custkey") % 2 == 0, F.lower(name)).otherwise(name)
    return o.select("o_orderkey", name.alias("warehouse_size")).select(
        "o_orderkey", "warehouse_size", nodes_per_warehouse("warehouse_size").alias("nodes"))


_D_NAMES = "[" + ", ".join(f"'{n}'" for n in _SIZE_NAMES) + "]"
# Nodes double from size to size: the number before the X and the letter say which one it is.
_D_SIZE = "replace(upper(warehouse_size), '-', '')"
_D_NODES = f"""case when {_D_SIZE} in ('XS', 'XSMALL') then 1 when {_D_SIZE} in ('S', 'SMALL') then 2
       when {_D_SIZE} in ('M', 'MEDIUM') then 4 when {_D_SIZE} in ('L', 'LARGE') then 8
       when regexp_matches({_D_SIZE}, '^[2-6]?X(L|LARGE)$')
       then cast(8 * pow(2, coalesce(try_cast(left({_D_SIZE}, 1) as integer), 1)) as integer) end"""
O_NODES_LOOKUP = f"""
select o_orderkey, warehouse_size, {_D_NODES} as nodes from (
  select o_orderkey,
         case when o_custkey % 2 = 0 then lower({_D_NAMES}[o_orderkey % {len(_SIZE_NAMES)} + 1])
              else {_D_NAMES}[o_orderkey % {len(_SIZE_NAMES)} + 1] end as warehouse_size
  from orders) s
"""

# ---------------------------------------------------------------- manifest


def q_route_files(spark, sf):
    return manifest.route_files(_fix(spark, sf, "listing").select("file_path"), fx.ROUTES)


O_ROUTE_FILES = _with("listing") + f"""
select file_path, {_route_sql('file_path')} as copy_into_name from listing
"""


#: A table of rules as large as the part table: four kinds of patterns, one of wildcards only, numbers out of order.
_RULES = """
select cast((p_partkey * 7919) % 1000003 as bigint) as rule_no,
       case p_partkey % 4 when 0 then concat('%/data_', cast(p_partkey as {TEXT}), '%')
            when 1 then concat('%S/data\\_', cast(p_partkey * 7 as {TEXT}), '.csv')
            when 2 then concat('s3://%_', cast(p_partkey as {TEXT}), '.csv')
            else concat('stages_____%', cast(p_partkey % 10 as {TEXT}), '.c%v') end as pattern,
       concat('T', cast(p_partkey as {TEXT})) as copy_into_name
from part union all select 2000000, '%/TPCH/ORDERS/%', 'ORDERS' union all select 2000001, concat(repeat('_', 36), '%'), 'LONG'
"""


def q_route_many_rules(spark, sf):
    fx.base_table(spark, sf, "part").createOrReplaceTempView("part")
    rules = spark.sql(_RULES.replace("{TEXT}", "string").replace("\\", "\\\\"))
    return routing.route_by_rules(_fix(spark, sf, "listing").select("file_path"), rules)


O_ROUTE_MANY_RULES = _with("listing", extra="rules as (" + _RULES.replace("{TEXT}", "varchar") + ")") + """
select l.file_path, (select arg_min(r.copy_into_name, (r.rule_no, r.pattern)) from rules r where l.file_path like r.pattern escape '\\') as copy_into_name
from listing l
"""


def q_build_manifest(spark, sf):
    return manifest.build_manifest(_fix(spark, sf, "listing_text"), fx.ROUTES)


O_BUILD_MANIFEST = _with("listing_text") + f"""
select name as file_path, {_route_sql('name')} as copy_into_name, {_D_PARSE} as ingestion_order,
       'WAITING' as ingestion_status, cast(null as bigint) as owner_session,
       cast(null as varchar) as exec_uuid, cast(0 as integer) as try_count,
       cast(null as timestamp) as start_time, cast(null as timestamp) as end_time,
       cast(size as bigint) as file_size, cast(null as varchar) as error_msg
from listing_text
"""


def _relisted(spark, sf):
    c = _fix(spark, sf, "control")
    # Files listed twice: every file still LOADING shows up again in a second listing.
    return c.select("file_path").unionAll(c.where(F.col("ingestion_status") == "LOADING").select("file_path"))


_D_RELISTED = ("relisted as (select file_path from control union all "
               "select file_path from control where ingestion_status = 'LOADING')")


def q_duplicate_check(spark, sf):
    return manifest.duplicate_summary(_relisted(spark, sf))


O_DUPLICATE_CHECK = _with("control", extra=_D_RELISTED) + """
select count(file_path) as files_count, count(distinct file_path) as files_distinct,
       count(file_path) - count(distinct file_path) as duplicates
from relisted
"""


def q_duplicate_files(spark, sf):
    return manifest.duplicate_files(_relisted(spark, sf))


O_DUPLICATE_FILES = _with("control", extra=_D_RELISTED) + """
select file_path, count(*) as copies from relisted where file_path is not null
group by file_path having count(*) > 1
"""

# ---------------------------------------------------------------- filters


def q_eligible_files(spark, sf):
    return batches.eligible_files(_fix(spark, sf, "control"), TRIES)


O_ELIGIBLE_FILES = _with("control") + f"""
select {_CONTROL_COLS} from control where ingestion_status = 'WAITING' and try_count < {TRIES}
"""


def q_loading_files(spark, sf):
    return monitor.loading_files(_fix(spark, sf, "control"))


O_LOADING_FILES = _with("control") + f"select {_CONTROL_COLS} from control where ingestion_status = 'LOADING'"


def q_attempted_files(spark, sf):
    return monitor.attempted_files(_fix(spark, sf, "control"))


O_ATTEMPTED_FILES = _with("control") + f"""
select {_CONTROL_COLS} from control where ingestion_status <> 'WAITING'
order by ingestion_order desc nulls last, file_path
"""


def q_error_files(spark, sf):
    return monitor.error_files(_fix(spark, sf, "control"))


O_ERROR_FILES = _with("control") + f"select {_CONTROL_COLS} from control where error_msg <> ''"


def q_stuck_files(spark, sf):
    return monitor.stuck_files(_fix(spark, sf, "control"), _now(), STUCK_MINUTES)


O_STUCK_FILES = _with("control") + f"""
select file_path, loading_minutes from (
  select file_path, date_diff('minute', start_time, {D_NOW}) as loading_minutes
  from control where ingestion_status = 'LOADING') s
where loading_minutes > {STUCK_MINUTES}
"""


def q_manifest_preview(spark, sf):
    return batches.manifest_preview(_fix(spark, sf, "control"), 10, SORT)


O_MANIFEST_PREVIEW = _with("control") + f"select {_CONTROL_COLS} from control order by {ORDER_SQL} limit 10"

# ---------------------------------------------------------------- joins / planning


def q_template_join(spark, sf):
    c = _fix(spark, sf, "control")
    live = batches.valid_templates(_fix(spark, sf, "templates"), _now())
    return (c.join(live, c["copy_into_name"] == live["statement_name"], "inner")
            .select("file_path", "copy_into_name", "statement_text"))


O_TEMPLATE_JOIN = _with("control", "templates", extra=_D_VALID_TEMPLATES) + """
select c.file_path, c.copy_into_name, t.statement_text
from control c join valid_templates t on c.copy_into_name = t.statement_name
"""


def q_template_at_start(spark, sf):
    """The template in force at each file's own start (not at one time for all)."""
    found = asof.template_at(_fix(spark, sf, "control"), _fix(spark, sf, "templates"))
    return found.select("file_path", "copy_into_name", "start_time", F.col("version.statement_text").alias("statement_text"))


O_TEMPLATE_AT_START = _with("control", "templates") + """
select c.file_path, c.copy_into_name, c.start_time, t.statement_text
from control c left join templates t on t.statement_name = c.copy_into_name and t.effective <= c.start_time
  and (t.superseded is null or t.superseded > c.start_time)
qualify row_number() over (partition by c.file_path order by t.effective desc nulls last) = 1
"""


def q_template_table(spark, sf):
    """A template for each route of the manifest, written, replaced as a whole and read again: its files and bytes."""
    path = work_dir(spark, "templates")
    c = _fix(spark, sf, "control").where("copy_into_name IS NOT NULL")

    def routes(kind, since):
        return c.groupBy(F.col("copy_into_name").alias("statement_name")).agg(F.min("ingestion_order").alias("first")).select(
            "statement_name", F.concat(F.lit("RAW_"), "statement_name").alias("target"), F.lit(kind).alias("file_format"),
            F.lit("o_orderkey bigint").alias("schema_ddl"), F.create_map(F.lit("sep"), F.lit("|")).alias("options"),
            F.lit("continue").alias("on_error"), F.expr(since).alias("effective"), F.lit(None).cast("timestamp_ntz").alias("superseded"))

    write_templates(routes("json", "first"), path)
    write_templates(routes("csv", "first + interval 1 day"), path)
    live = spark.read.parquet(path)
    return (c.join(live, (F.col("copy_into_name") == F.col("statement_name")) & (F.col("ingestion_order") >= F.col("effective")))
            .groupBy("statement_name", "target", "file_format", "on_error", F.col("options")["sep"].alias("sep"))
            .agg(F.min("effective").alias("effective"), F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes")))


O_TEMPLATE_TABLE = _with("control", extra="""
live as (select copy_into_name as statement_name, min(ingestion_order) + interval 1 day as effective
         from control where copy_into_name is not null group by 1)""") + """
select t.statement_name, 'RAW_' || t.statement_name as target, 'csv' as file_format, 'continue' as on_error, '|' as sep,
       min(t.effective) as effective, count(*) as files, cast(sum(c.file_size) as bigint) as bytes
from control c join live t on c.copy_into_name = t.statement_name and c.ingestion_order >= t.effective
group by t.statement_name
"""


def q_claim_next(spark, sf):
    return batches.claim_next(_fix(spark, sf, "control"), tries=TRIES, files_at_once=FILES_AT_ONCE,
                              sort_order=SORT, run_id=RUN_ID, owner_session=OWNER, now=_now(),
                              templates=_fix(spark, sf, "templates"))


_D_CLAIM = f"""
head as (select copy_into_name from routable order by {ORDER_SQL} limit 1),
batch as (select file_path from routable where copy_into_name in (select copy_into_name from head)
          order by {ORDER_SQL} limit {FILES_AT_ONCE}),
claimed as (
  select c.file_path, c.copy_into_name, c.ingestion_order,
         case when b.file_path is not null then 'LOADING' else c.ingestion_status end as ingestion_status,
         case when b.file_path is not null then cast({OWNER} as bigint) else c.owner_session end as owner_session,
         case when b.file_path is not null then '{RUN_ID}' else c.exec_uuid end as exec_uuid,
         cast(case when b.file_path is not null then c.try_count + 1 else c.try_count end as integer) as try_count,
         case when b.file_path is not null then {D_NOW} else c.start_time end as start_time,
         c.end_time, c.file_size, c.error_msg
  from control c left join batch b on c.file_path = b.file_path)
"""
O_CLAIM_NEXT = _with("control", "templates", extra=_D_VALID_TEMPLATES + "," + _D_ROUTABLE + "," + _D_CLAIM) + \
    f"select {_CONTROL_COLS} from claimed"


def q_claim_next_desc(spark, sf):
    return batches.claim_next(_fix(spark, sf, "control"), tries=TRIES, files_at_once=FILES_AT_ONCE,
                              sort_order="DESC", run_id=RUN_ID, owner_session=OWNER, now=_now(),
                              templates=_fix(spark, sf, "templates"))


def _descending(sql: str) -> str:
    return sql.replace(ORDER_SQL, "ingestion_order desc nulls last, file_path asc")


O_CLAIM_NEXT_DESC = _descending(O_CLAIM_NEXT)


def _plan(spark, sf, sort_order=SORT):
    return batches.plan_batches(_fix(spark, sf, "control"), tries=TRIES, files_at_once=FILES_AT_ONCE,
                                sort_order=sort_order, templates=_fix(spark, sf, "templates"), now=_now())


def q_plan_batches(spark, sf):
    return _plan(spark, sf)


_D_PLAN_ALL = _D_VALID_TEMPLATES + "," + _D_ROUTABLE + "," + _D_PLAN
O_PLAN_BATCHES = _with("control", "templates", extra=_D_PLAN_ALL) + "select * from plan"


def q_plan_batches_desc(spark, sf):
    return _plan(spark, sf, "DESC")


O_PLAN_BATCHES_DESC = _descending(O_PLAN_BATCHES)


def q_batch_file_list(spark, sf):
    return batches.batch_file_lists(_plan(spark, sf), _fix(spark, sf, "templates"), _now())


O_BATCH_FILE_LIST = _with("control", "templates", extra=_D_PLAN_ALL) + f"""
select p.batch_no, p.copy_into_name, p.file_count, p.file_list, t.statement_text from (
  select batch_no, min(copy_into_name) as copy_into_name, count(*) as file_count,
         string_agg(chr(10) || '''' || ({_short('file_path')}) || '''', ',' order by file_rank) as file_list
  from plan group by batch_no) p
left join valid_templates t on p.copy_into_name = t.statement_name
"""

# ---------------------------------------------------------------- transitions


def _results_from_history(spark, sf):
    """Load results for the LOADING files, as the history reports them."""
    c = monitor.loading_files(_fix(spark, sf, "control"))
    h = _fix(spark, sf, "history")
    j = (c.withColumn("_key", stage_path_shorten("file_path"))
         .join(h.withColumn("_key", stage_path_shorten("file_name")), "_key", "inner"))
    status = (F.when(F.col("error_count") == 0, F.lit("LOADED"))
              .when(F.col("row_count") > 0, F.lit("PARTIALLY_LOADED"))
              .otherwise(F.lit("LOAD_FAILED")))
    err = F.when(F.col("error_count") > 0,
                 F.concat(F.lit("rejected line "), F.col("first_error_line_number").cast("string")))
    return j.select(F.col("file_path").alias("file"), status.alias("status"), err.alias("first_error"))


_D_RESULTS = f"""
results as (
  select c.file_path as file,
         case when h.error_count = 0 then 'LOADED' when h.row_count > 0 then 'PARTIALLY_LOADED'
              else 'LOAD_FAILED' end as status,
         case when h.error_count > 0 then 'rejected line ' || cast(h.first_error_line_number as varchar) end
           as first_error
  from control c join history h on ({_short('c.file_path')}) = ({_short('h.file_name')})
  where c.ingestion_status = 'LOADING')
"""


def q_mark_complete(spark, sf):
    return transitions.mark_complete(_fix(spark, sf, "control"), _results_from_history(spark, sf), _now())


O_MARK_COMPLETE = _with("control", "history", extra=_D_RESULTS) + f"""
select c.file_path, c.copy_into_name, c.ingestion_order,
       case when r.file is not null then r.status else c.ingestion_status end as ingestion_status,
       c.owner_session,
       case when r.file is not null then null else c.exec_uuid end as exec_uuid,
       c.try_count, c.start_time,
       case when r.file is not null then {D_NOW} else c.end_time end as end_time,
       c.file_size,
       case when r.file is not null then coalesce(r.first_error, '') else c.error_msg end as error_msg
from control c left join results r on c.file_path = r.file
"""


def q_reset_stuck(spark, sf):
    return transitions.reset_stuck(_fix(spark, sf, "control"), _now(), STUCK_MINUTES)


def _status_update_sql(cond: str, new_status: str) -> str:
    cols = _CONTROL_COLS.replace("ingestion_status",
                                 f"case when {cond} then '{new_status}' else ingestion_status end as ingestion_status")
    return f"select {cols} from control"


O_RESET_STUCK = _with("control") + _status_update_sql(
    f"ingestion_status = 'LOADING' and date_diff('minute', start_time, {D_NOW}) >= {STUCK_MINUTES}", "WAITING")


def q_suspend(spark, sf):
    return transitions.suspend(_fix(spark, sf, "control"))


O_SUSPEND = _with("control") + _status_update_sql("ingestion_status = 'WAITING'", "SUSPENDED")


def q_resume(spark, sf):
    return transitions.resume(_fix(spark, sf, "control"))


O_RESUME = _with("control") + _status_update_sql("ingestion_status = 'SUSPENDED'", "WAITING")


def q_requeue_failed(spark, sf):
    return transitions.requeue_failed(_fix(spark, sf, "control"), TRIES)


O_REQUEUE_FAILED = _with("control") + _status_update_sql(
    f"ingestion_status = 'LOAD_FAILED' and try_count < {TRIES}", "WAITING")

# ---------------------------------------------------------------- monitoring


def q_active_by_owner(spark, sf):
    return monitor.active_by_owner(_fix(spark, sf, "control"))


O_ACTIVE_BY_OWNER = _with("control") + """
select owner_session, count(file_path) as files_being_loaded, sum(file_size) / 1000000000 as gb_loading
from control where ingestion_status = 'LOADING' group by owner_session
"""


def q_load_stats(spark, sf):
    return monitor.load_stats(_fix(spark, sf, "control"), _fix(spark, sf, "history"))


O_LOAD_STATS = _with("control", "history") + f"""
select ingestion_status, count(c.file_path) as files,
       sum(c.file_size) / 1000000000 as gb_loaded,
       avg(c.file_size) / 1000000 as average_file_size_mb,
       max(c.file_size) / 1000000 as max_file_size_mb,
       min(c.file_size) / 1000000 as min_file_size_mb,
       cast(sum(h.row_count) as bigint) as row_count,
       avg(h.row_count) as average_row_count,
       cast(sum(h.row_parsed) as bigint) as row_parsed,
       cast(sum(h.error_count) as bigint) as error_count
from control c join history h on ({_short('c.file_path')}) = ({_short('h.file_name')})
group by ingestion_status having ingestion_status <> 'LOADING'
"""


def q_load_log(spark, sf):
    return monitor.load_log(_fix(spark, sf, "control"), _fix(spark, sf, "history"))


O_LOAD_LOG = _with("control", "history") + f"""
select c.file_path, h.file_name, cast(h.row_count as bigint) as row_count, h.row_parsed,
       cast(null as varchar) as first_error_message,
       h.first_error_line_number, cast(null as bigint) as first_error_character_position,
       cast(null as varchar) as first_error_col_name,
       cast(h.error_count as bigint) as error_count, c.ingestion_order, c.ingestion_status, c.owner_session, c.exec_uuid, c.try_count,
       c.start_time, c.end_time, c.file_size, c.error_msg
from control c join history h on ({_short('c.file_path')}) = ({_short('h.file_name')})
"""


#: Buckets of the fixtures' stored tables; both sides of a join have the same number.
BUCKETS = 16


def q_load_log_bucketed(spark, sf):
    """The load log from stored tables that were filled in two parts each."""
    root = work_dir(spark, "buckets")
    tables = []
    for name, path_col in (("control", "file_path"), ("history", "file_name")):
        # Built once: each part reads its rows twice.
        rows = materialize(buckets.keyed_rows(_fix(spark, sf, name), path_col), f"keyed-{name}")
        table = buckets.path_table(spark, f"{root}/{name}", rows, BUCKETS)
        for part in (0, 1):
            table.append(rows.where(F.pmod(F.hash(path_col), F.lit(2)) == part), f"p{part}")
        tables.append(table)
    return buckets.bucketed_load_log(*tables)


def q_duplicate_files_bucketed(spark, sf):
    """Files of a second listing that the stored first one holds already, or that come twice."""
    known = buckets.KnownPaths(spark, work_dir(spark, "known"), BUCKETS)
    c = _fix(spark, sf, "control")
    known.add(c, "first")
    again = c.where(F.col("ingestion_status") == "LOADING").select("file_path")
    return known.duplicates(again)


def _targets(spark, sf):
    return {"ORDERS": fx.base_table(spark, sf, "orders"),
            "LINEITEM": fx.base_table(spark, sf, "lineitem"),
            "CUSTOMER": fx.base_table(spark, sf, "customer")}


def q_target_counts(spark, sf):
    return monitor.target_counts(_targets(spark, sf))


O_TARGET_COUNTS = """
select (select count(*) from orders) as orders_count, (select count(*) from lineitem) as lineitem_count,
       (select count(*) from customer) as customer_count
"""


def q_target_counts_text(spark, sf):
    return monitor.target_counts_text(_targets(spark, sf))


O_TARGET_COUNTS_TEXT = """
select lpad(format('{:,}', (select count(*) from orders)), 23, ' ') as orders_count,
       lpad(format('{:,}', (select count(*) from lineitem)), 23, ' ') as lineitem_count,
       lpad(format('{:,}', (select count(*) from customer)), 23, ' ') as customer_count
"""


def q_progress(spark, sf):
    return monitor.progress(_fix(spark, sf, "control"), 100)


_D_PCT = ("(select sum(file_size) from control where ingestion_status = 'LOADED') / "
          "(select sum(file_size) from control) * 100.0")
O_PROGRESS = _with("control") + f"""
select {progress_bar_sql('percent_complete', 2, 100)} as progress from (select {_D_PCT} as percent_complete) p
"""


def q_progress_eta(spark, sf):
    return monitor.progress_eta(_fix(spark, sf, "control"), _now(), 12)


O_PROGRESS_ETA = _with("control") + f"""
select {progress_bar_sql('p.pct', 2, 12)} as progress,
       l.gb as gigabytes_loaded,
       round(r.secs / 60.0) as running_minutes,
       round((r.secs * (100.0 / p.pct)) / 60.0) as estimated_total_runtime_minutes,
       round((r.secs * (100.0 / p.pct)) / 60.0) - round(r.secs / 60.0) as estimated_minutes_remaining
from (select cast(date_diff('second', min(start_time), {D_NOW}) as double) as secs from control) r,
     (select {_D_PCT} as pct) p,
     (select sum(file_size) / 1000000000 as gb from control where ingestion_status = 'LOADED') l
"""

# ---------------------------------------------------------------- sizing

_ADVICE_GRID = [(s, w) for s in ("X-Small", "Small", "Medium", "Large", "XXLARGE") for w in (1, 2, 3, 12)]


def q_recommend_batch(spark, sf):
    grid = sizing.size_advice_rows(spark, _ADVICE_GRID)
    return sizing.recommend_batch(_fix(spark, sf, "control"), grid)


_D_GRID = "(values " + ", ".join(f"('{s}', {w})" for s, w in _ADVICE_GRID) + \
    ") as g(warehouse_size, number_of_warehouses)"
O_RECOMMEND_BATCH = _with("control") + f"""
select warehouse_size, number_of_warehouses, files_to_process,
       cast(case when at_once > 1000 then 1000 when at_once < cores then cores else at_once end as bigint)
         as files_at_once
from (
  select warehouse_size, number_of_warehouses, files_to_process, cores,
         ceil((512 / avg_mb) / cores) * cores
           * cast(round(ceil(8.0 / number_of_warehouses) * number_of_warehouses / 8.0) as bigint) as at_once
  from (
    select g.warehouse_size, g.number_of_warehouses,
           ({nodes_per_warehouse_sql('g.warehouse_size')}) * 8 as cores,
           s.files_to_process, s.avg_mb
    from {_D_GRID},
         (select count(*) as files_to_process, avg(file_size) / 2000000 as avg_mb from control) s) a) b
"""


def q_size_profile(spark, sf):
    return sizing.size_profile(_fix(spark, sf, "control"))


O_SIZE_PROFILE = _with("control") + """
select small as percent_abnormally_small_files, large as percent_abnormally_large_files,
       (100.0 - small) - large as percent_average_size_files,
       case when (100.0 - small) - large >= 95 and large < 0.5 then 'Medium'
            when (100.0 - small) - large >= 90 and large < 1.0 then 'Small'
            else 'X-Small' end as max_recommended_warehouse_size
from (
  select sum(case when file_size / s.avg_size < 0.50 then 1 else 0 end) / count(*) * 100.0 as small,
         sum(case when file_size / s.avg_size > 2.00 then 1 else 0 end) / count(*) * 100.0 as large
  from control, (select avg(file_size) as avg_size from control) s) p
"""


QUERIES: dict[str, QueryFn] = {
    "shorten_paths": q_shorten_paths,
    "parse_last_modified": q_parse_last_modified,
    "progress_bar": q_progress_bar,
    "nodes_lookup": q_nodes_lookup,
    "route_files": q_route_files,
    "route_many_rules": q_route_many_rules,
    "build_manifest": q_build_manifest,
    "duplicate_check": q_duplicate_check,
    "duplicate_files": q_duplicate_files,
    "eligible_files": q_eligible_files,
    "loading_files": q_loading_files,
    "attempted_files": q_attempted_files,
    "error_files": q_error_files,
    "stuck_files": q_stuck_files,
    "manifest_preview": q_manifest_preview,
    "template_join": q_template_join,
    "claim_next": q_claim_next,
    "plan_batches": q_plan_batches,
    "batch_file_list": q_batch_file_list,
    "mark_complete": q_mark_complete,
    "reset_stuck": q_reset_stuck,
    "suspend": q_suspend,
    "resume": q_resume,
    "requeue_failed": q_requeue_failed,
    "active_by_owner": q_active_by_owner,
    "load_stats": q_load_stats,
    "load_log": q_load_log,
    "target_counts": q_target_counts,
    "target_counts_text": q_target_counts_text,
    "progress": q_progress,
    "progress_eta": q_progress_eta,
    "recommend_batch": q_recommend_batch,
    "size_profile": q_size_profile,
    "template_at_start": q_template_at_start,
    "template_table": q_template_table,
    "claim_next_desc": q_claim_next_desc,
    "plan_batches_desc": q_plan_batches_desc,
    "load_log_bucketed": q_load_log_bucketed,
    "duplicate_files_bucketed": q_duplicate_files_bucketed,
}

ORACLES: dict[str, str] = {
    "shorten_paths": O_SHORTEN_PATHS,
    "parse_last_modified": O_PARSE_LAST_MODIFIED,
    "progress_bar": O_PROGRESS_BAR,
    "nodes_lookup": O_NODES_LOOKUP,
    "route_files": O_ROUTE_FILES,
    "route_many_rules": O_ROUTE_MANY_RULES,
    "build_manifest": O_BUILD_MANIFEST,
    "duplicate_check": O_DUPLICATE_CHECK,
    "duplicate_files": O_DUPLICATE_FILES,
    "eligible_files": O_ELIGIBLE_FILES,
    "loading_files": O_LOADING_FILES,
    "attempted_files": O_ATTEMPTED_FILES,
    "error_files": O_ERROR_FILES,
    "stuck_files": O_STUCK_FILES,
    "manifest_preview": O_MANIFEST_PREVIEW,
    "template_join": O_TEMPLATE_JOIN,
    "claim_next": O_CLAIM_NEXT,
    "plan_batches": O_PLAN_BATCHES,
    "batch_file_list": O_BATCH_FILE_LIST,
    "mark_complete": O_MARK_COMPLETE,
    "reset_stuck": O_RESET_STUCK,
    "suspend": O_SUSPEND,
    "resume": O_RESUME,
    "requeue_failed": O_REQUEUE_FAILED,
    "active_by_owner": O_ACTIVE_BY_OWNER,
    "load_stats": O_LOAD_STATS,
    "load_log": O_LOAD_LOG,
    "target_counts": O_TARGET_COUNTS,
    "target_counts_text": O_TARGET_COUNTS_TEXT,
    "progress": O_PROGRESS,
    "progress_eta": O_PROGRESS_ETA,
    "recommend_batch": O_RECOMMEND_BATCH,
    "size_profile": O_SIZE_PROFILE,
    "template_at_start": O_TEMPLATE_AT_START,
    "template_table": O_TEMPLATE_TABLE,
    "claim_next_desc": O_CLAIM_NEXT_DESC,
    "plan_batches_desc": O_PLAN_BATCHES_DESC,
    "load_log_bucketed": O_LOAD_LOG,
    "duplicate_files_bucketed": O_DUPLICATE_FILES,
}


def _merge_file_queries():
    from . import catalog_files, catalog_live
    QUERIES.update(catalog_files.QUERIES)
    ORACLES.update(catalog_files.ORACLES)
    QUERIES.update(catalog_live.QUERIES)  # the same results as the scans they stand beside
    ORACLES.update(live_load_stats=O_LOAD_STATS, live_progress_eta=O_PROGRESS_ETA, live_stuck_files=O_STUCK_FILES)


_merge_file_queries()

# The flagship: a full ingest cycle (stage, list, manifest, plan, load, record).
FLAGSHIP = "ingest_job"
