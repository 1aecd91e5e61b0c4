"""Registered queries that write and read staged files.

Each stages the driver's tables below a fresh folder of the shared root
(``spark.checkpoint.dir``), runs the operator on the files and returns what
it produced. Oracles compute the same figures from the source tables and
the seeding rule of ``staging``.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, functions as F

from . import fixtures as fx
from . import staging
from .functions.paths import hidden_name
from .operators.manifest import build_manifest, listing_from_stage
from .operators.transitions import reset_stuck, resume, suspend
from .plans.ingest import file_ingest
from .session import work_dir, write_prefix
from .sources.loader import LoadTemplate, load_files, load_results, load_stage, read_history, read_target
from .sources.stage import list_stage, unload
from .sources.tables import ManifestStore, clone_schema, empty_manifest, templates_table
from .streaming.ingest import start_stream_ingest
from .streaming.stage import drain_stage


def _dir_key(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(c, r"(TPCH/[^/]+/month=[^/]+)/[^/]*$", 1)


def _stage(spark, sf, routes=("ORDERS", "JORDERS", "OTHER", "LINEITEM")):
    root = work_dir(spark, "stage")
    return root, staging.stage_tables(spark, sf, root, routes)


def _template(spark, name) -> LoadTemplate:
    return staging.template(name)


# ---------------------------------------------------------------- O01 list stage

def q_list_stage(spark, sf):
    """Files, empty files and hidden names of every staged folder."""
    root, stage = _stage(spark, sf)
    staging.stage_odd_files(spark, sf, root)
    listing = list_stage(spark, stage)
    return (listing.groupBy(_dir_key("path").alias("stage_dir"))
            .agg(F.count(F.lit(1)).alias("files"),
                 F.sum(F.when(F.col("length") == 0, 1).otherwise(0)).cast("long").alias("empty_files"),
                 F.sum(hidden_name("path").cast("long")).alias("hidden_files")))


_D_MONTH_O = "strftime(o_orderdate, '%Y-%m')"
_D_MONTH_L = "strftime(l_shipdate, '%Y-%m')"

O_LIST_STAGE = f"""
with dirs as (
  select distinct 'TPCH/ORDERS/month=' || {_D_MONTH_O} as stage_dir, 1 as files, 0 as odd from orders
   where o_orderpriority in ('1-URGENT', '5-LOW')
  union select distinct 'TPCH/JORDERS/month=' || {_D_MONTH_O}, 1, 0 from orders where o_orderpriority = '2-HIGH'
  union select distinct 'TPCH/OTHER/month=' || {_D_MONTH_O}, 1, 0 from orders
   where o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED')
  union select distinct 'TPCH/LINEITEM/month=' || {_D_MONTH_L}, 1, 0 from lineitem
  union select distinct 'TPCH/ODD/month=' || {_D_MONTH_O}, 3, 1 from orders)
select stage_dir, cast(files as bigint) as files, cast(odd as bigint) as empty_files, cast(2 * odd as bigint) as hidden_files from dirs
"""

# ---------------------------------------------------------------- O03 load

_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


# Template by staged directory: a route without its own template is loaded by that of its format.
_TEMPLATE_OF = {"ORDERS": "ORDERS", "OTHER": "ORDERS", "JORDERS": "JORDERS", "ALLJSON": "JORDERS", "LINEITEM": "LINEITEM"}


def _load_routes(spark, sf, routes):
    """Stage the directories, load each with its template, and read the rows of all targets."""
    root, stage = _stage(spark, sf, routes)
    out = None
    for route in routes:
        tpl = _template(spark, _TEMPLATE_OF[route])
        target = f"{root}/target/{route}"
        load_stage(spark, f"{stage}/{route}", tpl, target, f"q-{route}")  # lands the rows eagerly
        rows = read_target(spark, target, tpl.schema_ddl)
        out = rows if out is None else out.unionByName(rows)
    return out


def q_load_files(spark, sf):
    """All orders: CSV and JSON files, as the routes say."""
    return _load_routes(spark, sf, ("ORDERS", "JORDERS", "OTHER"))


O_LOAD_FILES = f"""
select {_ORDER_COLS} from orders
where not (o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '5-LOW', '2-HIGH'))
"""


def q_load_json_files(spark, sf):
    return _load_routes(spark, sf, ("ALLJSON",))


O_LOAD_JSON_FILES = f"select {_ORDER_COLS} from orders where o_orderstatus <> 'P'"

# ---------------------------------------------------------------- O04 / O05 results and history


def _history(spark, sf, routes, on_error="continue"):
    root, stage = _stage(spark, sf, tuple(routes))

    def load(route):
        tpl = staging.template(_TEMPLATE_OF[route], on_error)
        return load_stage(spark, f"{stage}/{route}", tpl, f"{root}/target/{route}", f"q-{route}")

    # Different targets: the loads run side by side.
    with ThreadPoolExecutor(max_workers=len(routes)) as pool:
        parts = list(pool.map(load, routes))
    hist = parts[0]
    for p in parts[1:]:
        hist = hist.unionByName(p)
    return hist


def q_load_results(spark, sf):
    res = load_results(_history(spark, sf, ["ORDERS", "JORDERS", "OTHER", "LINEITEM"]))
    return res.select(_dir_key("file").alias("stage_dir"), "status", "first_error")


_D_FILE_ROWS = f"""
rows_ as (
  select 'ORDERS' as target, 'TPCH/ORDERS/month=' || {_D_MONTH_O} as stage_dir, o_orderkey as k,
         o_orderstatus = 'P' as bad,
         case when o_orderpriority = '1-URGENT'
              then 'Number of columns in file (2) does not match that of the corresponding table (6)'
              else 'Value ''n/a'' is not a valid double for column O_TOTALPRICE' end as msg,
         case when o_orderpriority = '1-URGENT' then null else 'O_TOTALPRICE' end as col_name,
         case when o_orderpriority = '1-URGENT'
              then length(cast(o_orderkey as varchar)) + length(cast(o_custkey as varchar)) + 2
              else length(cast(o_orderkey as varchar)) + length(cast(o_custkey as varchar))
                   + length(o_orderstatus) + 4 end as pos
  from orders where o_orderpriority in ('1-URGENT', '5-LOW')
  union all
  select 'JORDERS', 'TPCH/JORDERS/month=' || {_D_MONTH_O}, o_orderkey, o_orderstatus = 'P',
         'Invalid JSON record', 'O_ORDERKEY', length('{{"o_orderkey":' || cast(o_orderkey as varchar) || ',') + 1
  from orders where o_orderpriority = '2-HIGH'
  union all
  select 'OTHER', 'TPCH/OTHER/month=' || {_D_MONTH_O}, o_orderkey, false,
         cast(null as varchar), cast(null as varchar), cast(null as bigint)
  from orders where o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED')
  union all
  select 'LINEITEM', 'TPCH/LINEITEM/month=' || {_D_MONTH_L}, l_orderkey * 8 + l_linenumber, false,
         cast(null as varchar), cast(null as varchar), cast(null as bigint)
  from lineitem),
numbered as (select *, row_number() over (partition by stage_dir order by k) as line from rows_),
per_file as (
  select target, stage_dir, count(*) as n, count(*) filter (where bad) as nbad,
         first(msg order by line) filter (where bad) as first_error_message,
         min(line) filter (where bad) as first_error_line_number,
         first(pos order by line) filter (where bad) as first_error_character_position,
         first(col_name order by line) filter (where bad) as first_error_col_name
  from numbered group by target, stage_dir),
history as (
  select target, stage_dir,
         case when nbad = 0 then 'LOADED' when nbad < n then 'PARTIALLY_LOADED' else 'LOAD_FAILED' end as status,
         cast(n - nbad as bigint) as row_count, cast(n as bigint) as row_parsed, first_error_message,
         cast(first_error_line_number as bigint) as first_error_line_number,
         cast(first_error_character_position as bigint) as first_error_character_position,
         first_error_col_name, cast(nbad as bigint) as error_count
  from per_file)
"""

O_LOAD_RESULTS = "with " + _D_FILE_ROWS + """
select stage_dir, status, first_error_message as first_error from history
"""


def q_load_history(spark, sf):
    hist = _history(spark, sf, ["ORDERS", "JORDERS", "OTHER", "LINEITEM"])
    return hist.select(_dir_key("file_name").alias("stage_dir"), "status", "row_count", "row_parsed",
                       "first_error_message", "first_error_line_number", "first_error_character_position",
                       "first_error_col_name", "error_count")


O_LOAD_HISTORY = "with " + _D_FILE_ROWS + """
select stage_dir, status, row_count, row_parsed, first_error_message, first_error_line_number,
       first_error_character_position, first_error_col_name, error_count
from history
"""



def q_load_skip_file(spark, sf):
    """Files with any bad row load nothing at all."""
    hist = _history(spark, sf, ["ORDERS", "JORDERS", "OTHER", "LINEITEM"], "skip_file")
    return hist.select(_dir_key("file_name").alias("stage_dir"), "status", "row_count", "row_parsed",
                       "first_error_message", "first_error_line_number", "error_count")


O_LOAD_SKIP_FILE = "with " + _D_FILE_ROWS + """
select stage_dir, case when error_count > 0 then 'LOAD_FAILED' else 'LOADED' end as status,
       case when error_count > 0 then cast(0 as bigint) else row_count end as row_count, row_parsed,
       first_error_message, first_error_line_number, error_count
from history
"""

# ---------------------------------------------------------------- O06 unload


def q_unload_roundtrip(spark, sf):
    path = work_dir(spark, "unload") + "/TPCH/ORDERS"
    unload(fx.base_table(spark, sf, "orders"), path, "csv")
    return (spark.read.schema(staging.ORDERS_DDL)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))


O_UNLOAD_ROUNDTRIP = f"select {_ORDER_COLS} from orders"

#: Bytes of a file of a sized unload: small, so that the fixtures fill several.
UNLOAD_BYTES = 256 * 1024


def q_unload_sized(spark, sf):
    """Orders unloaded to files of a given size; every file's length must be within twice of it either way."""
    path = work_dir(spark, "unload") + "/TPCH/ORDERS"
    orders = fx.base_table(spark, sf, "orders")
    unload(orders, path, "csv", target_bytes=UNLOAD_BYTES)
    sizes = list_stage(spark, path).agg(F.count(F.lit(1)).alias("n"), F.min("length").alias("least"), F.max("length").alias("most")).first()
    if sizes["most"] > 2 * UNLOAD_BYTES or (sizes["n"] > 1 and 2 * sizes["least"] < UNLOAD_BYTES):
        raise RuntimeError(f"files of {sizes['least']} to {sizes['most']} bytes, not about {UNLOAD_BYTES}")
    return (spark.read.schema(staging.ORDERS_DDL)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path))

def q_lineitem_roundtrip(spark, sf):
    """Unload lineitem to CSV in parallel (O06), list the stage (O01) and load
    every listed file back with the LINEITEM template (O03)."""
    root = work_dir(spark, "roundtrip")
    stage = f"{root}/TPCH/LINEITEM"
    unload(fx.base_table(spark, sf, "lineitem"), stage, "csv")
    tpl = staging.template("LINEITEM")
    target = f"{root}/target/{tpl.target}"
    hist = load_stage(spark, stage, tpl, target, "roundtrip")
    bad = hist.where(F.col("error_count") > 0).count()
    if bad:
        raise RuntimeError(f"{bad} files with rejected rows in a clean round trip")
    return read_target(spark, target, tpl.schema_ddl)


O_LINEITEM_ROUNDTRIP = """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
from lineitem
"""

# ---------------------------------------------------------------- O35 ingest job


def run_ingest(spark, sf, *, files_at_once=100, wave_files=1000, files_to_process=1_000_000):
    root, stage = _stage(spark, sf)
    listing = listing_from_stage(list_stage(spark, stage))
    control = build_manifest(listing, staging.STAGE_ROUTES)
    store = ManifestStore.create(spark, f"{root}/manifest", control)
    run = file_ingest(spark, store, staging.load_templates(spark), target_root=f"{root}/target",
                      history_path=f"{root}/history", sort_order="ASC", files_to_process=files_to_process,
                      files_at_once=files_at_once, max_run_minutes=60, tries=3, run_id="ingest-q",
                      owner_session=1, wave_files=wave_files)
    return run, store


def q_ingest_job(spark, sf):
    run, store = run_ingest(spark, sf)
    final = store.read()
    hist = read_history(spark, run.history_path)
    j = final.join(hist, final["file_path"] == hist["file_name"], "left")
    return (j.groupBy("copy_into_name", "ingestion_status")
            .agg(F.count(F.lit(1)).alias("files"),
                 F.sum("row_parsed").cast("long").alias("row_parsed"),
                 F.sum("row_count").cast("long").alias("row_count"),
                 F.sum("error_count").cast("long").alias("error_count")))


O_INGEST_JOB = "with " + _D_FILE_ROWS + f"""
select target as copy_into_name, status as ingestion_status, count(*) as files,
       cast(sum(row_parsed) as bigint) as row_parsed, cast(sum(row_count) as bigint) as row_count,
       cast(sum(error_count) as bigint) as error_count
from history where target <> 'OTHER' group by target, status
union all
select null, 'WAITING', count(distinct {_D_MONTH_O}), null, null, null
from orders where o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED')
"""


def q_ingest_summary(spark, sf):
    run, _ = run_ingest(spark, sf)
    s = run.summary.to_df(spark)
    return s.select("Parameter_Error", "Duplicate_Files_Error", "Termination_Reason", "Files_Processed")


O_INGEST_SUMMARY = "with " + _D_FILE_ROWS + """
select cast(null as varchar) as Parameter_Error, cast(null as varchar) as Duplicate_Files_Error,
       'Processed_All_Waiting_Files' as Termination_Reason, count(*) as Files_Processed
from history where target <> 'OTHER'
"""

# ---------------------------------------------------------------- O03/O04 odd names, missing and cut-off files


def q_load_edge_paths(spark, sf):
    """All orders in files whose names hold reader patterns and escapes, one that is
    missing and one cut off, under a load id with colons: rows loaded per outcome."""
    root = work_dir(spark, "edge")
    orders = fx.base_table(spark, sf, "orders")
    names = F.array(*[F.lit(n) for n in ("x[1]", "x1", "a b", "p+q", "100%41", "{s}", "w*", "q?")])
    folder = F.element_at(names, (F.col("o_orderkey") % 8 + 1).cast("int")).alias("name")
    (orders.select(staging.orders_csv_line(bad=False).alias("value"), folder)
     .write.partitionBy("name").text(f"{root}/in"))
    # A gzip file without its end: the first half of the largest of the parts, written as bytes.
    orders.select(staging.orders_csv_line(bad=False).alias("value")).write.text(f"{root}/gz", compression="gzip")
    whole = list_stage(spark, f"{root}/gz").where("path like '%.gz'").orderBy(F.col("length").desc(), "path").first()["path"]
    cut = f"{root}/in/cut.csv.gz"
    write_prefix(spark, whole, cut)
    paths = [r["path"] for r in list_stage(spark, f"{root}/in").where("path not like '%.gz'").select("path").collect()]
    tpl = staging.template("ORDERS")
    hist = load_files(spark, [*paths, cut, f"{root}/in/missing.csv"], tpl, f"{root}/t", "2026-12-02T10:00:00")
    landed = read_target(spark, f"{root}/t", tpl.schema_ddl).agg(F.count(F.lit(1)).alias("rows_landed"), F.sum("o_orderkey").alias("key_sum"))
    return (hist.groupBy("status").agg(F.sum("row_count").cast("long").alias("row_count"),
                                       F.sum("error_count").cast("long").alias("error_count"),
                                       F.max(F.col("first_error_message").isNotNull()).alias("has_error"))
            .crossJoin(F.broadcast(landed)))  # one row


O_LOAD_EDGE_PATHS = """
select 'LOADED' as status, count(*) as row_count, cast(0 as bigint) as error_count, false as has_error,
       count(*) as rows_landed, cast(sum(o_orderkey) as bigint) as key_sum from orders
union all
select 'LOAD_FAILED', cast(0 as bigint), cast(0 as bigint), true, count(*), cast(sum(o_orderkey) as bigint) from orders
"""

# ---------------------------------------------------------------- O35/O51 rerun after a failure, O33/O34 in a run


def _ingest_setup(spark, sf):
    root, stage = _stage(spark, sf)
    control = build_manifest(listing_from_stage(list_stage(spark, stage)), ALL_ROUTES)
    store = ManifestStore.create(spark, f"{root}/manifest", control)
    args = dict(target_root=f"{root}/target", history_path=f"{root}/history", files_to_process=1_000_000,
                files_at_once=50, tries=3, owner_session=1)
    return root, store, args


def _target_rows(spark, root):
    """Committed rows and a checksum of every target."""
    hist = read_history(spark, f"{root}/history")
    out = None
    for name, key in (("ORDERS", "o_orderkey"), ("JORDERS", "o_orderkey"), ("LINEITEM", "l_orderkey")):
        rows = (read_target(spark, f"{root}/target/{name}", staging.template(name).schema_ddl, hist)
                .agg(F.lit(name).alias("target"), F.count(F.lit(1)).alias("n_rows"), F.sum(key).alias("key_sum")))
        out = rows if out is None else out.unionByName(rows)
    return out


_O_TARGET_ROWS = """
select 'ORDERS' as target, count(*) as n_rows, cast(sum(o_orderkey) as bigint) as key_sum from orders
 where o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED') or o_orderpriority in ('1-URGENT', '5-LOW') and o_orderstatus <> 'P'
union all
select 'JORDERS', count(*), cast(sum(o_orderkey) as bigint) from orders where o_orderpriority = '2-HIGH' and o_orderstatus <> 'P'
union all
select 'LINEITEM', count(*), cast(sum(l_orderkey) as bigint) from lineitem
"""


def q_ingest_rerun(spark, sf):
    """A run fails after one template has landed; its files are reset and a second
    run loads everything: every source row once."""
    root, store, args = _ingest_setup(spark, sf)
    broken = staging.template_rows()
    for row in broken:
        if row["statement_name"] == "LINEITEM":
            row["schema_ddl"] = "l_orderkey not_a_type"
    file_ingest(spark, store, templates_table(spark, broken), run_id="first", wave_files=100_000, **args)
    later = F.lit("2100-01-01").cast("timestamp_ntz")
    store.update(lambda control: reset_stuck(control, later))
    file_ingest(spark, store, staging.load_templates(spark), run_id="second", wave_files=100_000, **args)
    return _target_rows(spark, root)


def q_ingest_suspend_resume(spark, sf):
    """Another session suspends the files while a run is loading; after resume a
    second run loads the rest: every source row once."""
    root, store, args = _ingest_setup(spark, sf)
    ticks = []

    def clock():
        ticks.append(1)
        if len(ticks) == 3:  # the first wave has landed
            ManifestStore.open(spark, store.root).update(suspend)
        return dt.datetime(2100, 1, 1)

    first = file_ingest(spark, store, staging.load_templates(spark), run_id="first", wave_files=100, clock=clock, **args)
    store.update(resume)
    second = file_ingest(spark, store, staging.load_templates(spark), run_id="second", wave_files=100_000, **args)
    if not (first.summary.files_processed and second.summary.files_processed):
        raise RuntimeError("the suspended run should load some files and leave some")
    return _target_rows(spark, root)


def q_ingest_two_runs(spark, sf):
    """Two runs over one manifest at the same time: every source row once."""
    root, store, args = _ingest_setup(spark, sf)
    templates = staging.load_templates(spark)

    def run(name):
        done = file_ingest(spark, ManifestStore.open(spark, store.root), templates, run_id=name, wave_files=200, **args)
        if str(done.summary.termination_reason).startswith("ERROR"):
            raise RuntimeError(done.summary.termination_reason)
    with ThreadPoolExecutor(max_workers=2) as pool:
        list(pool.map(run, ("one", "two")))
    return _target_rows(spark, root)


# ---------------------------------------------------------------- O01/O02/O35 odd files, a bad template


def _odd_ingest(spark, sf, templates, **options):
    """Staged orders and odd files, loaded by one run: history rows by route and status."""
    root, stage = _stage(spark, sf, ("ORDERS", "JORDERS", "OTHER"))
    staging.stage_odd_files(spark, sf, root)
    control = build_manifest(listing_from_stage(list_stage(spark, stage)), ALL_ROUTES)
    store = ManifestStore.create(spark, f"{root}/manifest", control)
    run = file_ingest(spark, store, templates, target_root=f"{root}/target", history_path=f"{root}/history", files_to_process=1_000_000,
                      files_at_once=50, tries=3, owner_session=1, run_id="odd", wave_files=100_000, **options)
    if run.summary.termination_reason != "Processed_All_Waiting_Files":
        raise RuntimeError(f"the run ended by {run.summary.termination_reason}")
    rows = store.read().join(read_history(spark, run.history_path).withColumnRenamed("file_name", "file_path"), "file_path", "left")
    return (rows.groupBy(_route_of("file_path"), "ingestion_status")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"), F.sum("error_count").alias("error_count")))


#: Every staged folder has a template; odd files are taken for orders.
ALL_ROUTES = [*staging.STAGE_ROUTES, ("%/TPCH/OTHER/%", "ORDERS"), ("%/TPCH/ODD/%", "ORDERS")]


def _route_of(column: str) -> Column:
    return F.regexp_extract(column, "/TPCH/([A-Z]+)/", 1).alias("route")


def q_ingest_odd_files(spark, sf):
    """Empty files load with 0 rows; files that readers pass over are told so, never counted as loaded."""
    return _odd_ingest(spark, sf, staging.load_templates(spark))


def q_ingest_one_bad_template(spark, sf):
    """The JSON template cannot be read: its files fail with the reason, all others load."""
    rows = staging.template_rows()
    for row in rows:
        if row["statement_name"] == "JORDERS":
            row["schema_ddl"] = "o_orderkey not_a_type"
    return _odd_ingest(spark, sf, templates_table(spark, rows), on_template_error="continue")


def _o_routes(bad_json: bool, status: str = "ingestion_status") -> str:
    """Files and rows by route and status."""
    failed = "true" if bad_json else "false"
    return f"""
with rows_ as (
  select case when o_orderpriority in ('1-URGENT', '5-LOW') then 'ORDERS' when o_orderpriority = '2-HIGH' then 'JORDERS' else 'OTHER' end as route,
         {_D_MONTH_O} as month, o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '5-LOW', '2-HIGH') as bad from orders),
files_ as (
  select route, month, count(*) as n, sum(bad::int) as errors, {failed} and route = 'JORDERS' as failed from rows_ group by route, month
  union all select 'ODD', month, 0, 0, kind > 1 from (select distinct month from rows_) cross join (values (1), (2), (3)) k(kind))
select route, case when failed then 'LOAD_FAILED' when errors = 0 then 'LOADED' when errors < n then 'PARTIALLY_LOADED' else 'LOAD_FAILED' end as {status},
       count(*) as files, cast(sum(case when failed then 0 else n - errors end) as bigint) as row_count,
       cast(sum(case when failed then 0 else errors end) as bigint) as error_count
from files_ group by all
"""

# ---------------------------------------------------------------- O07 / O08 / O09


def q_clone_load(spark, sf):
    """Load all staged orders into an empty clone of the orders table."""
    orders = fx.base_table(spark, sf, "orders")
    return clone_schema(spark, orders).unionByName(_load_routes(spark, sf, ("ORDERS", "JORDERS", "OTHER")))


def q_reset_manifest(spark, sf):
    """A manifest emptied and built again from a listing: files per route."""
    root, store, _ = _ingest_setup(spark, sf)
    listed = store.read()
    store.replace(empty_manifest(spark, listed.schema["ingestion_order"].dataType))
    if not store.read().isEmpty():
        raise RuntimeError("a reset manifest has no files")
    store.replace(listed)
    return ManifestStore.open(spark, store.root).read().groupBy("copy_into_name").agg(F.count(F.lit(1)).alias("files"))


O_RESET_MANIFEST = f"""
with dirs as (
  select distinct case when o_orderpriority = '2-HIGH' then 'JORDERS' else 'ORDERS' end as copy_into_name,
         case when o_orderpriority = '2-HIGH' then 'JORDERS' when o_orderpriority in ('1-URGENT', '5-LOW') then 'ORDERS' else 'OTHER' end as route,
         {_D_MONTH_O} as month from orders
  union all
  select distinct 'LINEITEM', 'LINEITEM', {_D_MONTH_L} from lineitem)
select copy_into_name, count(*) as files from dirs group by 1
"""

# ---------------------------------------------------------------- O50 stream


def q_stream_ingest(spark, sf):
    root = work_dir(spark, "stream")
    stage = staging.stage_events(spark, sf, root)
    tpl = LoadTemplate("EVENTS", "EVENTS", staging.EVENTS_DDL, "csv",
                       {"escape": '"', "timestampNTZFormat": staging.TS_TEXT})
    q = start_stream_ingest(spark, stage, tpl, target_path=f"{root}/target/EVENTS",
                            history_path=f"{root}/history", checkpoint_path=f"{root}/checkpoint",
                            run_id="stream-q", max_files_per_trigger=8, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_target(spark, f"{root}/target/EVENTS", staging.EVENTS_DDL)


def q_stream_all_routes(spark, sf):
    """One stream over the whole stage, stopped and started again: every file once, by route and status."""
    root, stage = _stage(spark, sf, ("ORDERS", "JORDERS"))

    def drain():
        drain_stage(spark, stage, ALL_ROUTES, staging.load_templates(spark), target_root=f"{root}/target", history_path=f"{root}/history",
                    checkpoint_path=f"{root}/checkpoint", run_id="routes", max_files_per_trigger=100)
    drain()
    staging.stage_tables(spark, sf, root, ("OTHER",))  # more files come while no query runs
    staging.stage_odd_files(spark, sf, root)
    drain()
    return (read_history(spark, f"{root}/history").groupBy(_route_of("file_name"), "status")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"), F.sum("error_count").alias("error_count")))


O_STREAM_INGEST = "select event_id, ts, user_id, event_type, value, props from events"


QUERIES = {
    "list_stage": q_list_stage,
    "load_files": q_load_files,
    "load_json_files": q_load_json_files,
    "load_results": q_load_results,
    "load_history": q_load_history,
    "load_skip_file": q_load_skip_file,
    "load_edge_paths": q_load_edge_paths,
    "ingest_rerun": q_ingest_rerun,
    "ingest_suspend_resume": q_ingest_suspend_resume,
    "ingest_two_runs": q_ingest_two_runs,
    "ingest_odd_files": q_ingest_odd_files,
    "ingest_one_bad_template": q_ingest_one_bad_template,
    "clone_load": q_clone_load,
    "reset_manifest": q_reset_manifest,
    "unload_roundtrip": q_unload_roundtrip,
    "unload_sized": q_unload_sized,
    "lineitem_roundtrip": q_lineitem_roundtrip,
    "ingest_job": q_ingest_job,
    "ingest_summary": q_ingest_summary,
    "stream_ingest": q_stream_ingest,
    "stream_all_routes": q_stream_all_routes,
}

ORACLES = {
    "list_stage": O_LIST_STAGE,
    "load_files": O_LOAD_FILES,
    "load_json_files": O_LOAD_JSON_FILES,
    "load_results": O_LOAD_RESULTS,
    "load_history": O_LOAD_HISTORY,
    "load_skip_file": O_LOAD_SKIP_FILE,
    "load_edge_paths": O_LOAD_EDGE_PATHS,
    "ingest_rerun": _O_TARGET_ROWS,
    "ingest_suspend_resume": _O_TARGET_ROWS,
    "ingest_two_runs": _O_TARGET_ROWS,
    "ingest_odd_files": _o_routes(False),
    "ingest_one_bad_template": _o_routes(True),
    "clone_load": O_LOAD_FILES,
    "reset_manifest": O_RESET_MANIFEST,
    "unload_roundtrip": O_UNLOAD_ROUNDTRIP,
    "unload_sized": O_UNLOAD_ROUNDTRIP,
    "lineitem_roundtrip": O_LINEITEM_ROUNDTRIP,
    "ingest_job": O_INGEST_JOB,
    "ingest_summary": O_INGEST_SUMMARY,
    "stream_ingest": O_STREAM_INGEST,
    "stream_all_routes": _o_routes(False, "status"),
}
