"""Table shapes: manifest (control table), load templates, load results,
load history and the run summary."""

from __future__ import annotations

from pyspark.sql import types as T

# Manifest statuses. WAITING/LOADING/LOADED/SUSPENDED are the control states;
# PARTIALLY_LOADED and LOAD_FAILED are the per-file outcomes of a load.
WAITING = "WAITING"
LOADING = "LOADING"
LOADED = "LOADED"
PARTIALLY_LOADED = "PARTIALLY_LOADED"
LOAD_FAILED = "LOAD_FAILED"
SUSPENDED = "SUSPENDED"

CONTROL_COLUMNS = [
    "file_path", "copy_into_name", "ingestion_order", "ingestion_status",
    "owner_session", "exec_uuid", "try_count", "start_time", "end_time",
    "file_size", "error_msg",
]


def control_schema(order_type: T.DataType = T.TimestampNTZType()) -> T.StructType:
    """One row per staged file. ``ingestion_order`` may be any orderable type."""
    return T.StructType([
        T.StructField("file_path", T.StringType()),
        T.StructField("copy_into_name", T.StringType()),
        T.StructField("ingestion_order", order_type),
        T.StructField("ingestion_status", T.StringType()),
        T.StructField("owner_session", T.LongType()),
        T.StructField("exec_uuid", T.StringType()),
        T.StructField("try_count", T.IntegerType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("error_msg", T.StringType()),
    ])


# A load template: where rows go and how files are read. Validity-dated:
# effective inclusive, superseded exclusive, null superseded = open ended.
TEMPLATE_SCHEMA = T.StructType([
    T.StructField("statement_name", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("file_format", T.StringType()),
    T.StructField("schema_ddl", T.StringType()),
    T.StructField("options", T.MapType(T.StringType(), T.StringType())),
    T.StructField("on_error", T.StringType()),
    T.StructField("effective", T.TimestampNTZType()),
    T.StructField("superseded", T.TimestampNTZType()),
])

LOAD_RESULT_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("first_error", T.StringType()),
])

LOAD_HISTORY_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("row_parsed", T.LongType()),
    T.StructField("first_error_message", T.StringType()),
    T.StructField("first_error_line_number", T.LongType()),
    T.StructField("first_error_character_position", T.LongType()),
    T.StructField("first_error_col_name", T.StringType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("target", T.StringType()),
])

RUN_SUMMARY_SCHEMA = T.StructType([
    T.StructField("Parameter_Error", T.StringType()),
    T.StructField("Duplicate_Files_Error", T.StringType()),
    T.StructField("Session_ID", T.LongType()),
    T.StructField("Start_Time", T.StringType()),
    T.StructField("Termination_Reason", T.StringType()),
    T.StructField("Files_Processed", T.LongType()),
    T.StructField("End_Time", T.StringType()),
    T.StructField("UUID", T.StringType()),
])
