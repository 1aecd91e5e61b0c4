"""Manifest, history and known paths stored in buckets: joins that shuffle the new rows only.

A table of this kind is dealt into ``buckets`` by the hash of one column when
rows come in. Two of them with the same number of buckets join bucket by bucket,
and rows that come later are dealt once, to the stored layout; what is stored is
never shuffled again.

A bucket is read by one task, so no key may fill it: rows of a key that comes
more than ``HOT_ROWS`` times in one append are kept apart (folder ``hot=true``)
and joined by an ordinary join, which AQE may split.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.paths import stage_path_shorten
from ..operators.monitor import log_columns
from ..session import partition_folder, path_exists

HOT_ROWS = 10_000
KEY, PART, HOT = "_key", "_part", "_hot"


class BucketTable:
    """Rows below ``root``, bucketed by the text column ``_key`` and foldered by append (``_part``) and ``_hot``."""

    def __init__(self, spark: SparkSession, root: str, schema: str, buckets: int):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        # The name is this session's; the rows belong to the folder.
        self.name = f"buckets_{uuid.uuid4().hex[:12]}"
        place = self.root.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {self.name} ({schema}, {KEY} string, {PART} string, {HOT} boolean) USING parquet "
                  f"PARTITIONED BY ({PART}, {HOT}) CLUSTERED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{place}'")
        if path_exists(spark, self.root):
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def append(self, rows: DataFrame, part: str, hot_rows: int = HOT_ROWS) -> None:
        """Add rows (with ``_key``) as ``part``; a part written again replaces itself. Rows without key stay out.

        Counts of keys are added up before they are shuffled, and the few that
        are hot decide which rows are kept apart.
        """
        rows = rows.where(F.col(KEY).isNotNull())
        hot = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(KEY, F.lit(True).alias(HOT))
        marked = rows.join(hot, KEY, "left").withColumn(HOT, F.coalesce(HOT, F.lit(False)))
        columns = [c for c in self.spark.table(self.name).columns if c != PART]
        # Hot rows keep a bucket a row key and some of their columns, so that no task writes a hot key alone.
        spread = F.when(F.col(HOT), F.xxhash64(*[c for c in columns if c != HOT]).cast("string")).otherwise(F.col(KEY))
        dealt = marked.withColumn("_to", spread).repartition(self.buckets, "_to").select(*columns)
        # The part is named in the statement, so only its own folder is replaced.
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({PART} = :part, {HOT}) SELECT * FROM {{dealt}}",
                       args={"part": part}, dealt=dealt)

    def cold(self) -> DataFrame:
        return self.spark.table(self.name).where(~F.col(HOT))

    def hot(self) -> DataFrame | None:
        """Rows of hot keys, or None if there are none (seen from the folders alone)."""
        parts = self.spark.sql(f"SHOW PARTITIONS {self.name}")
        if parts.where(F.col("partition").endswith("/" + partition_folder(HOT, "true"))).isEmpty():
            return None
        return self.spark.table(self.name).where(F.col(HOT))

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forget this session's name of the table; the rows stay in their folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _ddl(df: DataFrame, leave: tuple[str, ...] = (KEY,)) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in leave)


def keyed_rows(rows: DataFrame, path_col: str) -> DataFrame:
    """Rows with their path key; paths without "/" have none."""
    return rows.where(F.col(path_col).contains("/")).withColumn(KEY, stage_path_shorten(path_col))


def path_table(spark: SparkSession, root: str, like: DataFrame, buckets: int) -> BucketTable:
    """A table for rows like ``like`` by path key (see ``keyed_rows``); opens what ``root`` holds already."""
    return BucketTable(spark, root, _ddl(like), buckets)


def bucketed_load_log(manifest: BucketTable, history: BucketTable) -> DataFrame:
    """``load_log`` of stored tables, bucket by bucket; only rows of hot keys are shuffled."""
    def joined(c: DataFrame, h: DataFrame) -> DataFrame:
        return log_columns(c.alias("C").join(h.alias("L"), KEY, "inner"), h.columns)

    out = joined(manifest.cold(), history.cold())
    hot_c, hot_h = manifest.hot(), history.hot()
    if hot_h is not None:
        out = out.unionByName(joined(manifest.rows(), hot_h))
    if hot_c is not None:
        out = out.unionByName(joined(hot_c, history.cold()))
    return out


class KnownPaths:
    """Every path listed so far with its number of copies, bucketed by the path.

    Copies are added up before they are stored, so a path that is listed a
    million times is one row an append.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        self.table = BucketTable(spark, root, "copies bigint", buckets)

    @staticmethod
    def _counted(files: DataFrame, path_col: str) -> DataFrame:
        return (files.where(F.col(path_col).isNotNull()).groupBy(F.col(path_col).alias(KEY))
                .agg(F.count(F.lit(1)).alias("copies")))

    def duplicates(self, files: DataFrame, path_col: str = "file_path") -> DataFrame:
        """(file_path, copies) of the new files that come more than once, the stored listings included."""
        # Dealt to the stored layout by name: whatever the shuffle setting, the stored side stays where it is.
        new = self._counted(files, path_col).withColumnRenamed("copies", "_new").repartition(self.table.buckets, KEY)
        stored = self.table.rows().groupBy(KEY).agg(F.sum("copies").alias("_old"))
        return (new.join(stored, KEY, "left")
                .select(F.col(KEY).alias(path_col), (F.col("_new") + F.coalesce("_old", F.lit(0))).alias("copies"))
                .where(F.col("copies") > 1))

    def add(self, files: DataFrame, part: str, path_col: str = "file_path") -> None:
        self.table.append(self._counted(files, path_col), part)
