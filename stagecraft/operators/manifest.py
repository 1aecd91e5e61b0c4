"""Manifest building: route files to templates, build the control table,
check for duplicate paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.paths import last_modified_to_timestamp
from ..schemas import WAITING, control_schema


def route_expr(path: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """First rule whose LIKE pattern matches names the template; none -> null.

    Rules are a short, user-written list; a CASE keeps routing inside the scan
    stage (no join, no shuffle).
    """
    c = F.col(path) if isinstance(path, str) else path
    expr = None
    for pattern, name in rules:
        expr = (F.when(c.like(pattern), F.lit(name)) if expr is None
                else expr.when(c.like(pattern), F.lit(name)))
    return expr if expr is not None else F.lit(None).cast("string")


def route_files(files: DataFrame, rules: Sequence[tuple[str, str]], path_col: str = "file_path",
                out_col: str = "copy_into_name") -> DataFrame:
    return files.withColumn(out_col, route_expr(path_col, rules))


def build_manifest(listing: DataFrame, rules: Sequence[tuple[str, str]], *, path_col: str = "name",
                   modified_col: str = "last_modified", size_col: str = "size",
                   order_col: Column | None = None) -> DataFrame:
    """Listing -> control table: route, order, size and the defaults (WAITING, 0 tries).

    ``modified_col`` may hold listing text ("Wed, 8 Sep 2021 15:22:01 GMT") or
    a timestamp. ``order_col`` overrides the ingestion order (any orderable).
    """
    modified = F.col(modified_col)
    if order_col is None:
        if isinstance(listing.schema[modified_col].dataType, T.StringType):
            order_col = last_modified_to_timestamp(modified)
        else:
            order_col = modified.cast("timestamp_ntz")
    schema = control_schema()
    out = listing.select(
        F.col(path_col).cast("string").alias("file_path"),
        route_expr(path_col, rules).alias("copy_into_name"),
        order_col.alias("ingestion_order"),
        F.lit(WAITING).alias("ingestion_status"),
        F.lit(None).cast("long").alias("owner_session"),
        F.lit(None).cast("string").alias("exec_uuid"),
        F.lit(0).cast("int").alias("try_count"),
        F.lit(None).cast("timestamp_ntz").alias("start_time"),
        F.lit(None).cast("timestamp_ntz").alias("end_time"),
        F.col(size_col).cast("long").alias("file_size"),
        F.lit(None).cast("string").alias("error_msg"),
    )
    return out.select([F.col(f.name) if f.name == "ingestion_order" else F.col(f.name).cast(f.dataType)
                       for f in schema.fields])


def listing_from_stage(stage_listing: DataFrame) -> DataFrame:
    """``binaryFile`` listing columns -> listing columns (name, last_modified, size)."""
    return stage_listing.select(
        F.col("path").alias("name"),
        F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
        F.col("length").alias("size"))


def duplicate_summary(manifest: DataFrame, path_col: str = "file_path") -> DataFrame:
    """One row: paths counted, distinct paths, and the difference. Nulls are not counted."""
    return (manifest.agg(F.count(path_col).alias("files_count"),
                         F.count_distinct(path_col).alias("files_distinct"))
            .withColumn("duplicates", F.col("files_count") - F.col("files_distinct")))


def duplicate_files(manifest: DataFrame, path_col: str = "file_path") -> DataFrame:
    """Every path listed more than once, with its number of copies."""
    return (manifest.where(F.col(path_col).isNotNull())
            .groupBy(path_col).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def count_duplicates(manifest: DataFrame, path_col: str = "file_path") -> int:
    """Driver-side guard value: number of surplus copies (0 when clean)."""
    return int(duplicate_summary(manifest, path_col).first()["duplicates"])
