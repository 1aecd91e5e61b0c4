"""Load staged files into a target, keeping bad rows out and reporting per
file: rows parsed, loaded, rejected and the first error (text, line,
character position, column).

CSV and JSON lines are read as text lines and parsed with ``from_csv`` /
``from_json`` in PERMISSIVE mode with a corrupt-record column, so every line
is validated inside Spark and can be traced to its file, split and position.
CSV with a header line or multi-line records uses Spark's CSV record reader;
other formats (Parquet, ORC, ...) are read with the template schema and have
no bad rows. Every line lands once in the target (``_kind`` = loaded,
rejected, blank or skipped) and the per-file figures are computed from the
landed lineage columns.
"""

from __future__ import annotations

import re
import threading
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..schemas import LOAD_FAILED, LOAD_HISTORY_SCHEMA, LOADED, PARTIALLY_LOADED
from ..functions.json_places import json_error
from ..functions.paths import hidden_name, is_hidden, path_key
from ..session import default_file_system, literal_rows, materialize, partition_folder, path_exists, remove_path, work_dir
from .probe import MISSING, can_probe, failing_files

ON_ERROR_MODES = ("continue", "skip_file", "abort_statement")
TEXT_FORMATS = ("csv", "json")
CORRUPT = "_corrupt"


@dataclass(frozen=True)
class LoadTemplate:
    """How one kind of file is loaded: format, schema, options, target, error rule."""
    name: str
    target: str
    schema_ddl: str
    file_format: str = "csv"
    options: dict[str, str] = field(default_factory=dict)
    on_error: str = "continue"

    def __post_init__(self):
        if self.on_error.lower() not in ON_ERROR_MODES:
            raise ValueError(f"on_error must be one of {ON_ERROR_MODES}")

    @classmethod
    def from_row(cls, row: Any) -> LoadTemplate:
        d = row.asDict(recursive=True) if hasattr(row, "asDict") else dict(row)
        return cls(name=d["statement_name"], target=d.get("target") or d["statement_name"],
                   schema_ddl=d["schema_ddl"], file_format=(d.get("file_format") or "csv").lower(),
                   options=dict(d.get("options") or {}), on_error=(d.get("on_error") or "continue").lower())


def schema_of(spark: SparkSession, ddl: str) -> T.StructType:
    return spark.createDataFrame([], ddl).schema


def _decoded_path(c: Column) -> Column:
    """``_metadata.file_path`` is URL-encoded; listings are not. Keep '+' literal.

    Every row carries its path, and most paths have nothing to decode.
    """
    return F.when(c.contains("%"), F.url_decode(F.regexp_replace(c, r"\+", "%2B"))).otherwise(c)


def _raw_fields(tpl: LoadTemplate, schema: T.StructType) -> Column:
    """A bad CSV line re-read with every field as text (one more field than the
    schema, to see extra fields)."""
    m = len(schema.fields)
    raw_ddl = ", ".join(f"c{i} string" for i in range(m + 1))
    return F.from_csv(F.col("value"), raw_ddl, {**_csv_options(tpl), "mode": "PERMISSIVE"})


def _field_pattern(tpl: LoadTemplate, sep: str) -> str:
    """One field of a CSV line, with the separator before it."""
    quote, escape = (re.escape(tpl.options.get(k, d)) for k, d in (("quote", '"'), ("escape", "\\")))
    s = re.escape(sep)
    return f"(?s)(?:^|{s})(?:{quote}(?:{escape}.|{quote}{quote}|(?!{quote}).)*{quote}|(?!{s}).)*"


def _error_details(tpl: LoadTemplate, schema: T.StructType) -> tuple[Column, Column, Column]:
    """(message, column name, 1-based character position) of a bad CSV line,
    from its text fields (column ``_raw``) and typed fields (``_row``).

    The first field whose text is present but whose typed value is not is
    the bad one; otherwise the field count is wrong.
    """
    m = len(schema.fields)
    sep = tpl.options.get("sep", tpl.options.get("delimiter", ","))
    raws = [F.col("_raw")[f"c{i}"] for i in range(m + 1)]
    typed = [F.col("_row")[f.name] for f in schema.fields]
    bad_idx = F.coalesce(*[F.when(raws[i].isNotNull() & typed[i].isNull(), F.lit(i)) for i in range(m)],
                         F.lit(None).cast("int"))
    names = F.array(*[F.lit(f.name.upper()) for f in schema.fields])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in schema.fields])
    # Fields as they stand in the line, each with the separator before it: a
    # separator within quotes does not end a field, and quotes count for positions.
    fields = F.regexp_extract_all(F.col("value"), F.lit(_field_pattern(tpl, sep)), F.lit(0))
    n_fields = F.size(fields)
    before = F.aggregate(F.slice(fields, 1, F.greatest(bad_idx, F.lit(0))), F.lit(0), lambda n, x: n + F.length(x))
    start = before + F.when(bad_idx > 0, F.lit(len(sep))).otherwise(F.lit(0)) + F.lit(1)
    idx1 = (bad_idx + 1).cast("int")
    msg = F.when(bad_idx.isNotNull(),
                 F.concat(F.lit("Value '"), F.element_at(F.array(*raws[:m]), idx1),
                          F.lit("' is not a valid "), F.element_at(types, idx1),
                          F.lit(" for column "), F.element_at(names, idx1))) \
        .otherwise(F.concat(F.lit("Number of columns in file ("), n_fields.cast("string"),
                            F.lit(") does not match that of the corresponding table ("),
                            F.lit(str(m)), F.lit(")")))
    col = F.when(bad_idx.isNotNull(), F.element_at(names, idx1))
    pos = F.when(bad_idx.isNotNull(), start) \
        .otherwise(F.length(F.col("value")) + F.lit(1))
    return msg, col, pos.cast("long")


# Read-ahead buffer of the CSV parser, in characters. The parser allocates it
# for every parsed line, so the library default (a million characters) turns
# into gigabytes of garbage per million lines. Long lines still parse.
CSV_INPUT_BUFFER = "4096"


def _csv_options(tpl: LoadTemplate) -> dict[str, str]:
    """Options for parsing one line: no line separator, no header."""
    opts = {k: v for k, v in tpl.options.items() if k not in ("lineSep", "header", "multiLine", "multiline")}
    opts.setdefault("inputBufferSize", CSV_INPUT_BUFFER)
    return opts


def reads_lines(tpl: LoadTemplate) -> bool:
    """Whether the template is read line by line (CSV / JSON lines) rather than
    with a record reader (CSV with a header line, multi-line records, columnar)."""
    if tpl.file_format not in TEXT_FORMATS or _flag(tpl, "multiLine"):
        return False
    return not (tpl.file_format == "csv" and _flag(tpl, "header"))


def record_reader(reader, tpl: LoadTemplate, schema: T.StructType):
    """Set up a batch or streaming reader for a record-reading template."""
    if tpl.file_format == "csv":
        ddl_c = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        opts = {**tpl.options, **_csv_options(tpl), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        return reader.format("csv").schema(ddl_c).options(**opts)
    return reader.format(tpl.file_format).schema(schema).options(**tpl.options)


def file_columns() -> list[Column]:
    """Source file (decoded like a listing path) and split start of each row."""
    return [_decoded_path(F.col("_metadata.file_path")).alias("_file"),
            F.col("_metadata.file_block_start").alias("_block")]


def literal_path(path: str) -> str:
    """``path`` as a reader pattern that matches this very name only."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def parse_staged(spark: SparkSession, paths: list[str] | str, tpl: LoadTemplate) -> DataFrame:
    """One row per line (record): _file, _block, _mid, _blank, _bad, _row (typed
    struct) and, for bad rows, _err (message, column, position).

    ``paths`` is an explicit file list, or one prefix read recursively."""
    schema = schema_of(spark, tpl.schema_ddl)
    prefix = _read_options(paths)
    paths = literal_path(paths) if isinstance(paths, str) else [literal_path(p) for p in paths]
    if reads_lines(tpl):
        reader = spark.read.options(**prefix)
        if "lineSep" in tpl.options:
            reader = reader.option("lineSep", tpl.options["lineSep"])
        lines = (reader.text(paths)
                 .select("value", *file_columns(), F.monotonically_increasing_id().alias("_mid")))
        return parse_lines(lines, tpl, schema)
    df = record_reader(spark.read.options(**prefix), tpl, schema).load(paths)
    records = df.select("*", *file_columns(), F.monotonically_increasing_id().alias("_mid"))
    return parse_records(records, tpl, schema)


def parse_records(records: DataFrame, tpl: LoadTemplate, schema: T.StructType | None = None) -> DataFrame:
    """Rows of a record reader (data columns, _file, _block, _mid) in the shape
    of ``parse_lines``: CSV keeps its corrupt records; columnar formats have none."""
    schema = schema or schema_of(records.sparkSession, tpl.schema_ddl)
    keys = [F.col("_file"), F.col("_block"), F.col("_mid")]
    if tpl.file_format != "csv":
        row = F.struct(*[F.col(f.name) for f in schema.fields], F.lit(None).cast("string").alias(CORRUPT))
        return records.select(*keys, row.alias("_row"), F.lit(False).alias("_blank"), F.lit(False).alias("_bad"),
                              F.lit(None).cast("struct<message:string,col_name:string,position:bigint>")
                              .alias("_err"))
    bad = F.col(CORRUPT).isNotNull()
    row = F.struct(*[F.col(f.name) for f in schema.fields], F.col(CORRUPT))
    rows = records.select(*keys, row.alias("_row"), F.lit(False).alias("_blank"), bad.alias("_bad"),
                          F.col(CORRUPT).alias("value"))
    if _flag(tpl, "multiLine"):
        msg, col, pos = F.lit("Malformed record"), F.lit(None).cast("string"), F.lit(None).cast("long")
    else:
        # One record per line: the record text gives the same details as the line reader.
        rows = rows.withColumn("_raw", F.when(F.col("_bad"), _raw_fields(tpl, schema)))
        msg, col, pos = _error_details(tpl, schema)
    err = F.when(F.col("_bad"), F.struct(msg.alias("message"), col.alias("col_name"), pos.alias("position")))
    return rows.withColumn("_err", err).drop("_raw")


def _flag(tpl: LoadTemplate, name: str) -> bool:
    value = tpl.options.get(name, tpl.options.get(name.lower(), "false"))
    return str(value).lower() == "true"


def _read_options(paths) -> dict[str, str]:
    """A file that is gone or broken must fail a read, whatever the session says: it is never taken for an empty one."""
    strict = {"ignoreMissingFiles": "false", "ignoreCorruptFiles": "false"}
    return {**strict, "recursiveFileLookup": "true"} if isinstance(paths, str) else strict


def parse_lines(lines: DataFrame, tpl: LoadTemplate, schema: T.StructType | None = None) -> DataFrame:
    """Parse text lines (value, _file, _block, _mid) of a CSV or JSON-lines template."""
    schema = schema or schema_of(lines.sparkSession, tpl.schema_ddl)
    fmt = tpl.file_format
    ddl_c = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    opts = _csv_options(tpl) if fmt == "csv" else {k: v for k, v in tpl.options.items() if k != "lineSep"}
    opts.update({"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = (F.from_csv(F.col("value"), tpl.schema_ddl + f", {CORRUPT} string", opts) if fmt == "csv"
              else F.from_json(F.col("value"), ddl_c, opts))
    blank = F.trim(F.col("value")) == ""
    rows = lines.select("*", parsed.alias("_row"), blank.alias("_blank"))
    bad = (~F.col("_blank")) & F.col(f"_row.{CORRUPT}").isNotNull()
    rows = rows.withColumn("_bad", bad)
    if fmt == "csv":
        # Text fields of bad lines only, computed once and then referenced.
        rows = rows.withColumn("_raw", F.when(F.col("_bad"), _raw_fields(tpl, schema)))
        msg, col, pos = _error_details(tpl, schema)
    else:
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        rows = rows.withColumn("_raw", F.when(F.col("_bad"), F.from_json(F.when(F.col("_bad"), F.col("value")), texts, {**opts, "mode": "PERMISSIVE"})))
        msg, col, pos = json_error(F.col("value"), F.col("_row"), F.col("_raw"), schema)
    err = F.when(F.col("_bad"), F.struct(msg.alias("message"), col.alias("col_name"), pos.alias("position")))
    return rows.withColumn("_err", err).drop("_raw")


def file_statistics(lines: DataFrame, with_line_numbers: bool = True, line_offset: int = 0) -> DataFrame:
    """Per file: rows parsed, rejected, and the first error with its line number.

    Lines are counted per (file, split); a split's lines are contiguous in
    one task, so a line's number is the lines of earlier splits plus its
    offset in its own split. Only per-split rows are windowed (a handful per
    file), never the lines themselves.
    """
    # A least struct is found by sorting: of bad lines only, while all lines are counted by hash.
    first_bad = (lines.where("_bad").groupBy("_file", "_block")
                 .agg(F.min(F.struct(F.col("_mid"), F.col("_err"))).alias("_fb")))
    blocks = (lines.groupBy("_file", "_block")
              .agg(F.count(F.lit(1)).alias("_lines"),
                   F.sum(F.when(~F.col("_blank"), 1).otherwise(0)).alias("_parsed"),
                   F.sum(F.when(F.col("_bad"), 1).otherwise(0)).alias("_errors"),
                   F.min("_mid").alias("_first_mid"))
              .join(first_bad, ["_file", "_block"], "left"))
    w = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_lines").over(w), F.lit(0))
    line_no = (before + F.col("_fb._mid") - F.col("_first_mid") + F.lit(1 + line_offset)) if with_line_numbers \
        else F.lit(None).cast("long")
    blocks = blocks.withColumn("_bad_line", F.when(F.col("_fb").isNotNull(), line_no))
    first = F.min(F.when(F.col("_fb").isNotNull(),
                         F.struct(F.col("_block"), F.col("_bad_line").alias("line"), F.col("_fb._err").alias("err"))))
    return (blocks.groupBy("_file")
            .agg(F.sum("_parsed").cast("long").alias("row_parsed"),
                 F.sum("_errors").cast("long").alias("error_count"),
                 first.alias("_first")))


# Kinds of landed lines (partition ``_kind`` of a target).
KIND_LOADED = "loaded"
KIND_REJECTED = "rejected"
KIND_SKIPPED = "skipped"      # good rows of files (or batches) an on_error rule rejected
KIND_BLANK = "blank"


#: Error of files that Spark's readers pass over: they are reported, never taken for empty ones.
HIDDEN_FILE = "Name begins with '_' or '.': Spark's file readers pass it over"


def load_files(spark: SparkSession, paths: list[str], tpl: LoadTemplate, target_path: str,
               load_id: str) -> DataFrame:
    """Load ``paths`` with ``tpl`` into ``target_path`` (partition ``_load_id=load_id``).

    Returns one load-history row per requested file (files with no rows
    included; missing, unreadable and hidden-named files are LOAD_FAILED with
    their error, and the others load). A repeated call with the same ``load_id`` replaces that
    partition, so a retried batch never adds rows twice.
    """
    if not paths:
        return spark.createDataFrame([], LOAD_HISTORY_SCHEMA)
    schema_of(spark, tpl.schema_ddl)  # a template that cannot be read is no file's fault
    failed = {p: HIDDEN_FILE for p in paths if is_hidden(p)}
    while True:
        good = [p for p in paths if p not in failed]
        if not good:
            return failed_history(spark, failed, tpl.target, load_id)
        # One array literal exploded on the JVM: no Python workers for the list.
        requested = spark.range(1).select(F.explode(F.lit(good).cast("array<string>")).alias("file_name"))
        try:
            history = load_parsed(parse_staged(spark, good, tpl), requested, tpl, target_path, load_id)
            return history.unionByName(failed_history(spark, failed, tpl.target, load_id)) if failed else history
        except Exception as e:
            # Nothing was committed. Leave out the files that cannot be read; any other error is the caller's.
            unreadable = unreadable_files(spark, good, tpl)
            if not unreadable:
                raise e
            failed.update(unreadable)


def unreadable_files(spark: SparkSession, paths: list[str], tpl: LoadTemplate) -> dict[str, str]:
    """Files that are missing or cannot be read to their end, with the error's first line.

    Only called after a failed load. One job reads each file by itself on the
    executors (``sources.probe``); if it finds none, or cannot judge these
    files, missing ones are looked for by name and the rest by halving.
    """
    default_fs = default_file_system(spark)
    named = {_with_file_system(p, default_fs): p for p in paths}
    found = {named[r["path"]]: r["error"] for r in failing_files(spark, list(named), tpl.file_format).collect()}
    if found:
        return found
    missing = {p: MISSING for p in paths if not can_probe(_with_file_system(p, default_fs), tpl.file_format) and not path_exists(spark, p)}
    return missing or _halved(spark, paths, tpl)


def _with_file_system(path: str, default_fs: str) -> str:
    return default_fs + path if path.startswith("/") else path


def _halved(spark: SparkSession, paths: list[str], tpl: LoadTemplate) -> dict[str, str]:
    """Halves the list until the bad files are alone: few jobs for few bad files."""
    try:
        parse_staged(spark, paths, tpl).agg(F.count("_row"), F.sum(F.col("_bad").cast("int"))).collect()
        return {}
    except Exception as e:  # noqa: BLE001 - any error of a single file is that file's error
        if len(paths) == 1:
            lines = [x.strip() for x in str(e).splitlines() if x.strip()]
            return {paths[0]: lines[0] if lines else type(e).__name__}
    half = len(paths) // 2
    return {**_halved(spark, paths[:half], tpl), **_halved(spark, paths[half:], tpl)}


def failed_history(spark: SparkSession, failed: dict[str, str], target: str | None, load_id: str) -> DataFrame:
    """History rows of files that no load has read, with their errors."""
    rows = [(p, LOAD_FAILED, 0, 0, message, None, None, None, 0, load_id, target) for p, message in failed.items()]
    return literal_rows(spark, rows, LOAD_HISTORY_SCHEMA)


def load_stage(spark: SparkSession, prefix: str, tpl: LoadTemplate, target_path: str,
               load_id: str) -> DataFrame:
    """Load every file below ``prefix``. The files to report come from the
    stage listing as a DataFrame: no file list passes through the driver."""
    from .stage import list_stage
    # Written before the load starts: the report and the load see the same files.
    listed = materialize(list_stage(spark, prefix).select(F.col("path").alias("file_name")), f"load-list-{tpl.name}")
    history = load_parsed(parse_staged(spark, prefix, tpl), listed.where(~hidden_name("file_name")), tpl, target_path, load_id)
    values = {"file_name": F.col("file_name"), "status": F.lit(LOAD_FAILED), "first_error_message": F.lit(HIDDEN_FILE),
              "load_id": F.lit(load_id), "target": F.lit(tpl.target)}
    hidden = listed.where(hidden_name("file_name")).select([
        values.get(f.name, F.lit(0 if f.name in ("row_count", "row_parsed", "error_count") else None)).cast(f.dataType).alias(f.name)
        for f in LOAD_HISTORY_SCHEMA.fields])
    return history.unionByName(hidden)


def _landing(parsed: DataFrame, schema: T.StructType, load_id: str, kind: Column) -> DataFrame:
    """Every line as one row: typed columns (set for loaded rows), lineage
    (source file, split, line key), the error and raw text of rejected lines."""
    loaded = kind == F.lit(KIND_LOADED)
    skipped = kind == F.lit(KIND_SKIPPED)
    values = [F.when(loaded | skipped, F.col(f"_row.{f.name}")).alias(f.name) for f in schema.fields]
    raw = F.col("value") if "value" in parsed.columns else F.lit(None).cast("string")
    return parsed.select(*values,
                         F.col("_file").alias("_source_file"), F.col("_block").alias("_split_start"),
                         F.col("_mid").alias("_line_key"), F.col("_err").alias("_error"),
                         F.when(kind == F.lit(KIND_REJECTED), raw).alias("_raw_line"),
                         F.lit(load_id).alias("_load_id"), kind.alias("_kind"))


# Partition writers that one task keeps open at a time (one for each kind of
# line): with it, landing a load needs no sort of its rows by partition.
OPEN_WRITERS = "16"


_landing_lock = threading.Lock()
_landing_writes = 0


@contextmanager
def _open_writers(spark: SparkSession):
    """Several open writers a task while any landing write of this process runs.

    Loads run side by side, and a write must not see the setting change under
    it, so the last one to end puts it back.
    """
    global _landing_writes
    name = "spark.sql.maxConcurrentOutputFileWriters"
    with _landing_lock:
        if not _landing_writes and spark.conf.get(name, "0") != "0":
            own = False  # the session has a setting of its own
        else:
            own, _landing_writes = True, _landing_writes + 1
            spark.conf.set(name, OPEN_WRITERS)
    try:
        yield
    finally:
        if own:
            with _landing_lock:
                _landing_writes -= 1
                if not _landing_writes:
                    spark.conf.unset(name)


def _write_landing(df: DataFrame, target_path: str) -> None:
    with _open_writers(df.sparkSession):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_load_id", "_kind").parquet(target_path))


def landing_schema(schema: T.StructType) -> T.StructType:
    """Columns of a target: the template's, the lineage and the two partition columns."""
    error = T.StructType([T.StructField("message", T.StringType()), T.StructField("col_name", T.StringType()),
                          T.StructField("position", T.LongType())])
    return T.StructType([*schema.fields, T.StructField("_source_file", T.StringType()),
                         T.StructField("_split_start", T.LongType()), T.StructField("_line_key", T.LongType()),
                         T.StructField("_error", error), T.StructField("_raw_line", T.StringType()),
                         T.StructField("_load_id", T.StringType()), T.StructField("_kind", T.StringType())])


def _target(spark: SparkSession, target_path: str, schema: T.StructType, folder: str = "") -> DataFrame:
    """A target (or one load's folder of it); without rows if nothing has landed there."""
    columns = landing_schema(schema)
    path = f"{target_path}/{folder}" if folder else target_path
    if not path_exists(spark, path):
        return spark.createDataFrame([], columns)
    return spark.read.schema(columns).option("basePath", target_path).parquet(literal_path(path) if folder else path)


def _landed_lines(spark: SparkSession, target_path: str, load_id: str, schema: T.StructType) -> DataFrame:
    """The lines of one load, read back narrowly (lineage columns only)."""
    part = _target(spark, target_path, schema, partition_folder("_load_id", load_id))
    return part.select(F.col("_source_file").alias("_file"), F.col("_split_start").alias("_block"),
                       F.col("_line_key").alias("_mid"), (F.col("_kind") == KIND_BLANK).alias("_blank"),
                       (F.col("_kind") == KIND_REJECTED).alias("_bad"), F.col("_error").alias("_err"))


def load_parsed(parsed: DataFrame, requested: DataFrame | None, tpl: LoadTemplate, target_path: str,
                load_id: str) -> DataFrame:
    """Land parsed lines in the target and report per requested file.

    With ``on_error=continue`` this is one pass over the input: every line is
    written once (loaded rows, rejected lines with their error and text, blank
    lines as markers) to ``_load_id=<id>/_kind=<kind>``, and the per-file
    figures are then computed from a narrow columnar read of what was written.
    ``skip_file`` and ``abort_statement`` must know every file's errors before
    deciding what is loaded: their lines land in a folder of this load first, are
    counted there, and go to the target from there. The text is parsed once.
    ``requested`` lists the files to report (None: the files that had lines).
    """
    spark = parsed.sparkSession
    schema = schema_of(spark, tpl.schema_ddl)
    multiline = tpl.file_format == "csv" and _flag(tpl, "multiLine")
    # A skipped header line comes before the first counted line of a file.
    offset = 1 if tpl.file_format == "csv" and _flag(tpl, "header") else 0
    mode = tpl.on_error
    kind = (F.when(F.col("_blank"), F.lit(KIND_BLANK)).when(F.col("_bad"), F.lit(KIND_REJECTED))
            .otherwise(F.lit(KIND_LOADED)))
    abort = False
    if mode == "continue":
        _write_landing(_landing(parsed, schema, load_id, kind), target_path)
        stats = materialize(file_statistics(_landed_lines(spark, target_path, load_id, schema),
                                            with_line_numbers=not multiline, line_offset=offset),
                            f"load-stats-{tpl.name}")
    else:
        first_path = work_dir(spark, f"landing-{tpl.name}")
        _write_landing(_landing(parsed, schema, load_id, kind), first_path)
        stats = materialize(file_statistics(_landed_lines(spark, first_path, load_id, schema),
                                            with_line_numbers=not multiline, line_offset=offset),
                            f"load-stats-{tpl.name}")
        landed, good = _target(spark, first_path, schema), F.col("_kind") == KIND_LOADED
        if mode == "skip_file":
            failed = stats.where(F.col("error_count") > 0).select(F.col("_file").alias("_failed"))
            landed = landed.join(failed, landed["_source_file"] == failed["_failed"], "left")
            good = good & F.col("_failed").isNull()
        else:
            abort = stats.where(F.col("error_count") > 0).limit(1).count() > 0
            good = good & F.lit(not abort)
        settled = F.when((F.col("_kind") == KIND_LOADED) & ~good, F.lit(KIND_SKIPPED)).otherwise(F.col("_kind"))
        _write_landing(landed.select(*[settled.alias(c) if c == "_kind" else F.lit(load_id).alias(c) if c == "_load_id" else F.col(c)
                                       for c in landing_schema(schema).fieldNames()]), target_path)
        remove_path(spark, first_path)

    if requested is None:
        requested = stats.select(F.col("_file").alias("file_name"))
    default_fs = default_file_system(spark)
    keyed = stats.withColumn("_key", path_key("_file", default_fs))
    j = requested.withColumn("_name", path_key("file_name", default_fs))
    j = j.join(keyed, j["_name"] == keyed["_key"], "left")
    n_parsed = F.coalesce(F.col("row_parsed"), F.lit(0))
    errors = F.coalesce(F.col("error_count"), F.lit(0))
    if abort:
        status, loaded = F.lit(LOAD_FAILED), F.lit(0)
    elif mode == "skip_file":
        status = F.when(errors > 0, F.lit(LOAD_FAILED)).otherwise(F.lit(LOADED))
        loaded = F.when(errors > 0, F.lit(0)).otherwise(n_parsed)
    else:
        status = (F.when(errors == 0, F.lit(LOADED)).when(errors < n_parsed, F.lit(PARTIALLY_LOADED))
                  .otherwise(F.lit(LOAD_FAILED)))
        loaded = n_parsed - errors
    message = F.col("_first.err.message")
    if abort:
        message = F.coalesce(message, F.lit("Load aborted: another file of the batch has errors"))
    return j.select(
        F.col("file_name"), status.alias("status"), loaded.cast("long").alias("row_count"),
        n_parsed.cast("long").alias("row_parsed"), message.alias("first_error_message"),
        F.col("_first.line").cast("long").alias("first_error_line_number"),
        F.col("_first.err.position").cast("long").alias("first_error_character_position"),
        F.col("_first.err.col_name").alias("first_error_col_name"),
        errors.cast("long").alias("error_count"),
        F.lit(load_id).alias("load_id"), F.lit(tpl.target).alias("target"))


def load_results(history_rows: DataFrame) -> DataFrame:
    """(file, status, first_error) view of load-history rows."""
    return history_rows.select(F.col("file_name").alias("file"), "status",
                               F.col("first_error_message").alias("first_error"))


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    """Load-history rows below ``history_path`` (partitioned by load id); none if nothing was loaded yet."""
    if not path_exists(spark, history_path):
        return spark.createDataFrame([], LOAD_HISTORY_SCHEMA)
    names = [f.name for f in LOAD_HISTORY_SCHEMA.fields]
    return spark.read.schema(LOAD_HISTORY_SCHEMA).parquet(history_path).select(*names)


def surplus_loads(history: DataFrame, default_fs: str) -> DataFrame:
    """(_again, _key): loads of a file into a target beside the one that counts, which is the one with most rows
    (of those, with the least id)."""
    loads = history.where("row_count > 0").select("target", path_key("file_name", default_fs).alias("_key"), F.col("load_id").alias("_again"), "row_count")
    kept = (loads.groupBy("target", "_key").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(-F.col("row_count"), F.col("_again"))).alias("_best"))
            .where("_n > 1").select("target", "_key", F.col("_best._again").alias("_kept")))
    # Only files with several loads are kept, so the join has few rows to look for.
    return (loads.join(kept, ["target", "_key"]).where(F.col("_again") != F.col("_kept")).select("_again", "_key").distinct())


def write_history(rows: DataFrame, history_path: str) -> None:
    """Record loads: their rows count as committed from here on.

    One partition a load id, replaced as a whole: a repeated write adds
    nothing, and runs that write at the same time do not touch each other.
    """
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_id").parquet(history_path))


def read_target(spark: SparkSession, target_path: str, schema_ddl: str | None = None,
                history: DataFrame | None = None) -> DataFrame:
    """Rows loaded into a target. ``_kind`` is a partition column, so the other
    kinds of lines are never read. With ``history``, committed loads only:
    what a load that failed later has left behind is not seen, and of a file
    that several loads hold (two runs had claimed it) one load counts."""
    if schema_ddl:
        schema = schema_of(spark, schema_ddl)
        df = _target(spark, target_path, schema)
    else:
        df = spark.read.parquet(target_path)
    df = df.where(F.col("_kind") == KIND_LOADED)
    if history is not None:
        committed = history.select(F.col("load_id").alias("_load_id")).distinct()
        df = df.withColumn("_load_id", F.col("_load_id").cast("string")).join(committed, "_load_id", "left_semi")
        default_fs = default_file_system(spark)
        again = surplus_loads(history, default_fs)  # none, or few: no row is shuffled for the planner's choice then
        df = df.join(again, (df["_load_id"] == again["_again"]) & (path_key("_source_file", default_fs) == again["_key"]), "left_anti")
    if schema_ddl:
        df = df.select(*[f.name for f in schema.fields])
    return df


def read_rejects(spark: SparkSession, target_path: str) -> DataFrame:
    """Rejected lines of a target: source file, error and raw text, per load."""
    return (spark.read.parquet(target_path).where(F.col("_kind") == KIND_REJECTED)
            .select("_load_id", "_source_file", "_split_start", "_line_key", "_error", "_raw_line"))
