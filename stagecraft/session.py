"""Session settings and the shared work folder.

Everything this library writes on its own behalf (staged test files, plan
tables, manifest versions, stream checkpoints) goes below the folder the
cluster names in ``spark.checkpoint.dir``. That folder is shared by all
executors, so a lost executor never takes written state with it. A folder
of our own is set only when the session has none (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

def build_session(master: str | None = None, app: str = "stagecraft",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench: UI off, UTC, AQE on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a fresh one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - no SparkContext (Connect)
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="stagecraft-")
        spark.conf.set("spark.checkpoint.dir", root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # pragma: no cover
            pass
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared root for one piece of work."""
    return f"{shared_root(spark)}/stagecraft/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage (so values computed with non-deterministic expressions
    are frozen) and survives executor loss, unlike a local checkpoint. With
    ``partition_by`` the rows are range-partitioned on that column and written
    one folder per value, so a later filter on it reads only its folder.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.repartitionByRange(partition_by).write.mode("overwrite").partitionBy(partition_by)
    writer.parquet(path)
    # The schema is known: no inference (an empty partitioned write has no files).
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path object of ``path`` and its file system (driver-side metadata calls only)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = hadoop_path(spark, path)
    return bool(fs.exists(jpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    jpath, fs = hadoop_path(spark, path)
    fs.delete(jpath, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it a query's shuffle files go when the query has ended, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_prefix(spark: SparkSession, source: str, target: str, share: float = 0.5) -> None:
    """Copy the first part of a file: staged input that is cut off."""
    jpath, fs = hadoop_path(spark, source)
    out_path, out_fs = hadoop_path(spark, target)
    size = int(fs.getFileStatus(jpath).getLen() * share)
    reader, writer = fs.open(jpath), out_fs.create(out_path)
    spark._jvm.org.apache.commons.io.IOUtils.copyLarge(reader, writer, 0, size)
    reader.close()
    writer.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file with a name of its own, empty or not."""
    jpath, fs = hadoop_path(spark, path)
    writer = fs.create(jpath)
    if text:
        writer.write(bytearray(text.encode()))
    writer.close()


def default_file_system(spark: SparkSession) -> str:
    """Prefix of paths that name no file system, such as ``file://``."""
    return spark._jsparkSession.sessionState().newHadoopConf().get("fs.defaultFS", "file:///").rstrip("/")


def partition_folder(column: str, value: str) -> str:
    """Folder name of a partition value, escaped as Spark's writers do (fixed set of characters)."""
    special = set("\"#%'*/:=?\\\x7f{[]^") | {chr(i) for i in range(1, 32)}
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in special else c for c in value)


def literal_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A DataFrame of a few literal rows (configuration), built on the JVM.

    ``createDataFrame`` from a Python list is a Python-backed RDD whose every
    use starts Python workers; a handful of configuration rows does not need that.
    """
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], schema)

    def lit(value, dtype):
        if value is None:
            return F.lit(None).cast(dtype)
        if isinstance(dtype, T.MapType):
            if not value:
                return F.create_map().cast(dtype)
            kv = [c for k, v in value.items() for c in (F.lit(k), F.lit(v))]
            return F.create_map(*kv).cast(dtype)
        if isinstance(dtype, T.TimestampNTZType):
            return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(dtype)
        return F.lit(value).cast(dtype)

    structs = [F.struct(*[lit(v, f.dataType).alias(f.name) for v, f in zip(r, schema.fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs a plain local path (tests)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
