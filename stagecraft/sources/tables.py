"""Tables kept by the library: the manifest store, load templates, empty clones.

The manifest is written as a base snapshot plus append-only change records.
A run writes only the rows it touches (claimed files, then their results),
never rewrites the whole manifest per batch, and never overwrites a
directory it is reading. The current state is the base with, for every file,
its latest change applied; ``compact`` folds the changes into a new base.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import CONTROL_COLUMNS, TEMPLATE_SCHEMA, control_schema
from ..session import literal_rows, path_exists


class ManifestStore:
    """Versioned manifest below ``root`` (a folder on shared storage)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.epoch = 0
        self.seq = 0

    # -- layout
    def _base(self, epoch: int) -> str:
        return f"{self.root}/base/epoch={epoch}"

    def _changes(self, epoch: int) -> str:
        return f"{self.root}/changes/epoch={epoch}"

    def _point(self, epoch: int) -> None:
        """Name the current base; written after the base is complete."""
        self.spark.range(1).select(F.lit(epoch).alias("epoch")).write.mode("append").parquet(f"{self.root}/current")

    @classmethod
    def create(cls, spark: SparkSession, root: str, control: DataFrame) -> ManifestStore:
        """New store whose base is ``control`` (written once)."""
        store = cls(spark, root)
        control.select(*CONTROL_COLUMNS).write.mode("errorifexists").parquet(store._base(1))
        store._point(1)
        store.epoch, store.seq = 1, 0
        return store

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> ManifestStore:
        """Reopen an existing store at its current base and latest change record."""
        return cls(spark, root).refresh()

    def refresh(self) -> ManifestStore:
        """Take notice of what other handles of the store have recorded."""
        self.epoch = int(self.spark.read.parquet(f"{self.root}/current").agg(F.max("epoch")).first()[0])
        path, self.seq = self._changes(self.epoch), 0
        if path_exists(self.spark, path):
            self.seq = int(self.spark.read.parquet(path).agg(F.max("seq")).first()[0] or 0)
        return self

    def base(self) -> DataFrame:
        return self.spark.read.parquet(self._base(self.epoch))

    def changes(self, after: int = 0) -> DataFrame | None:
        """Change records later than number ``after``."""
        if self.seq <= after:
            return None
        return (self.spark.read.parquet(self._changes(self.epoch))
                .where((F.col("seq") <= self.seq) & (F.col("seq") > after)))

    def latest(self, after: int = 0) -> DataFrame | None:
        """(_f, _c): each file's latest change later than number ``after``."""
        changes = self.changes(after)
        if changes is None:
            return None
        return (changes.groupBy("file_path")
                .agg(F.max_by(F.struct(*[c for c in CONTROL_COLUMNS if c != "file_path"]), "seq").alias("_c"))
                .select(F.col("file_path").alias("_f"), "_c"))

    def read(self) -> DataFrame:
        """Current manifest: base rows with each file's latest change applied."""
        base, latest = self.base(), self.latest()
        if latest is None:
            return base.select(*CONTROL_COLUMNS)
        joined = base.join(latest, base["file_path"] == latest["_f"], "left")
        hit = F.col("_f").isNotNull()
        cols = [F.col("file_path")] + [
            F.when(hit, F.col(f"_c.{c}")).otherwise(F.col(c)).alias(c)
            for c in CONTROL_COLUMNS if c != "file_path"]
        return joined.select(*cols)

    def append_changes(self, rows: DataFrame) -> int:
        """Record new versions of some manifest rows; returns the change number.

        Numbers follow the clock (microseconds), so handles that record at the
        same time use folders of their own and later records win. Each write
        replaces its folder only: a repeated write adds nothing.
        """
        seq = max(self.seq + 1, time.time_ns() // 1000)
        (rows.select(*CONTROL_COLUMNS).withColumn("seq", F.lit(seq)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("seq").parquet(self._changes(self.epoch)))
        self.seq = seq
        return seq

    def update(self, transform: Callable[[DataFrame], DataFrame]) -> int:
        """Apply a status change (suspend, resume, reset_stuck, requeue_failed) to the
        current manifest and record the changed rows only."""
        old = self.refresh().read()
        new = transform(old)
        before = old.select(F.col("file_path").alias("_f"), F.col("ingestion_status").alias("_before"))
        changed = (new.join(before, new["file_path"] == before["_f"])
                   .where(~F.col("ingestion_status").eqNullSafe(F.col("_before"))))
        return self.append_changes(changed)

    def replace(self, control: DataFrame) -> int:
        """Write ``control`` (a whole manifest) as the next base; returns its epoch.

        ``control`` may be computed from this store: the new base goes to a new
        folder, so nothing being read is overwritten. Not for use while a run
        is active: that run's records belong to the base it has opened.
        """
        epoch = self.epoch + 1
        control.select(*CONTROL_COLUMNS).write.mode("errorifexists").parquet(self._base(epoch))
        self._point(epoch)
        self.epoch, self.seq = epoch, 0
        return epoch

    def compact(self) -> int:
        """Fold the change records into a new base."""
        return self.replace(self.read())


def templates_table(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """Load templates from plain rows; ``effective`` defaults to now.

    Each row: statement_name, target, file_format, schema_ddl, options,
    on_error, effective, superseded.
    """
    data = []
    for r in rows:
        data.append((r["statement_name"], r.get("target", r["statement_name"]),
                     r.get("file_format", "csv"), r["schema_ddl"], dict(r.get("options") or {}),
                     r.get("on_error", "continue"), r.get("effective"), r.get("superseded")))
    df = literal_rows(spark, data, TEMPLATE_SCHEMA)
    return df.withColumn("effective", F.coalesce(F.col("effective"),
                                                 F.current_timestamp().cast("timestamp_ntz")))


def write_templates(templates: DataFrame, path: str) -> None:
    """Replace the template table (truncate + insert)."""
    templates.select([f.name for f in TEMPLATE_SCHEMA.fields]).write.mode("overwrite").parquet(path)


def clone_schema(spark: SparkSession, source: DataFrame) -> DataFrame:
    """Empty table with the columns of ``source``."""
    return spark.createDataFrame([], source.schema)


def empty_manifest(spark: SparkSession, order_type: T.DataType = T.TimestampNTZType()) -> DataFrame:
    """A manifest with no rows (the reset state)."""
    return spark.createDataFrame([], control_schema(order_type))
