"""Sizing advice from the manifest: batch size per worker and file size profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.warehouse import CORES_PER_NODE, nodes_per_warehouse
from ..session import literal_rows

# Fixed values of the advice rules.
TARGET_MB_PER_CORE_ROUND = 512          # megabytes a full round of cores should take
ADVICE_MB_DIVISOR = 2_000_000           # bytes per "MB" in the advice (as the rule has it)
MAX_FILES_AT_ONCE = 1000
SMALL_FILE_RATIO = 0.50                 # size / average below this: abnormally small
LARGE_FILE_RATIO = 2.00                 # size / average above this: abnormally large


def recommend_batch(control: DataFrame, sizes: DataFrame, size_col: str = "warehouse_size",
                    workers_col: str = "number_of_warehouses",
                    mb_divisor: int = ADVICE_MB_DIVISOR) -> DataFrame:
    """Files to process and files per batch for each (size, workers) row of ``sizes``.

    The manifest figures are two scalar subqueries (count, average size);
    each advice row is then plain arithmetic. ``mb_divisor`` is the bytes per
    "MB" of the rule (2,000,000 as the rule has it; 1,000,000 elsewhere).
    """
    files = control.select(F.count(F.lit(1))).scalar()
    avg_mb = control.select(F.avg("file_size") / F.lit(mb_divisor)).scalar()
    cores = nodes_per_warehouse(size_col) * F.lit(CORES_PER_NODE)
    w = F.col(workers_col).cast("double")
    per8 = F.ceil((F.lit(float(TARGET_MB_PER_CORE_ROUND)) / avg_mb) / cores) * cores
    # "::integer" of the worker factor rounds half away from zero.
    factor = F.round(F.ceil(F.lit(8.0) / w) * w / F.lit(8.0)).cast("long")
    at_once = per8 * factor
    advice = (F.when(at_once > MAX_FILES_AT_ONCE, F.lit(MAX_FILES_AT_ONCE))
              .when(at_once < cores, cores).otherwise(at_once))
    return sizes.select(F.col(size_col), F.col(workers_col),
                        files.alias("files_to_process"),
                        advice.cast("long").alias("files_at_once"))


def size_profile(control: DataFrame) -> DataFrame:
    """Share of abnormally small / large / average files and the largest
    worker size advised for that spread."""
    avg_size = control.select(F.avg("file_size")).scalar()
    ratio = F.col("file_size") / avg_size
    n = F.count(F.lit(1))
    small = F.sum(F.when(ratio < SMALL_FILE_RATIO, 1).otherwise(0)) / n * F.lit(100.0)
    large = F.sum(F.when(ratio > LARGE_FILE_RATIO, 1).otherwise(0)) / n * F.lit(100.0)
    prof = control.agg(small.alias("percent_abnormally_small_files"),
                       large.alias("percent_abnormally_large_files"))
    normal = (F.lit(100.0) - F.col("percent_abnormally_small_files")) - F.col("percent_abnormally_large_files")
    prof = prof.withColumn("percent_average_size_files", normal)
    large_c, normal_c = F.col("percent_abnormally_large_files"), F.col("percent_average_size_files")
    return prof.withColumn(
        "max_recommended_warehouse_size",
        F.when((normal_c >= 95) & (large_c < 0.5), F.lit("Medium"))
         .when((normal_c >= 90) & (large_c < 1.0), F.lit("Small"))
         .otherwise(F.lit("X-Small")))


def size_advice_rows(spark, rows) -> DataFrame:
    """A small (size, workers) table for ``recommend_batch``."""
    schema = T.StructType([T.StructField("warehouse_size", T.StringType()),
                           T.StructField("number_of_warehouses", T.IntegerType())])
    return literal_rows(spark, rows, schema)
