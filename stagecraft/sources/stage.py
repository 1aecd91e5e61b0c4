"""Stage access: list staged files, unload a table to a stage prefix."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import hadoop_path
from .listing import LISTABLE, StageListing


def _listable(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """(prefix as the caller names it, prefix to list) of a stage prefix; None where only Spark's JVM reads it."""
    named = ":" in path.partition("/")[0]
    if named and path.partition(":")[0] in LISTABLE:
        return path, path
    jpath, fs = hadoop_path(spark, path)
    if not fs.exists(jpath):
        raise FileNotFoundError(f"no such stage prefix: {path}")
    real = fs.resolvePath(jpath).toString()  # names and mounts (viewfs) lead to the store itself
    return (path if named else real, real) if real.partition(":")[0] in LISTABLE else None


def listed_as(spark: SparkSession, path: str, new: bool = False) -> str:
    """The prefix as a listing source opens it; ``new``: a folder that may not exist yet."""
    if new:
        jpath, fs = hadoop_path(spark, path)
        fs.mkdirs(jpath)
    found = _listable(spark, path)
    if not found:
        raise ValueError(f"{path}: only Spark's JVM reads this store; use streaming.start_stream_ingest for it")
    return found[1]


def list_stage(spark: SparkSession, stage_path: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Recursive listing of one or more stage prefixes: path, modificationTime, length.

    Every file is listed, empty ones and names with ``_`` or ``.`` first too;
    only job markers (``_SUCCESS``) and local checksum files are not. Folders
    are listed on the executors (``sources.listing``) and no file is opened.
    ``glob`` applies to file names. A store that only Spark's JVM can read is
    listed by Spark's file scan, which leaves out empty and hidden-named files.
    """
    paths = list(dict.fromkeys([stage_path] if isinstance(stage_path, str) else stage_path))
    found = {p: _listable(spark, p) for p in paths}
    parts = []
    plain = [p for p in paths if found[p] and found[p][0] == found[p][1]]
    groups = ([plain] if plain else []) + [[p] for p in paths if found[p] and p not in plain]
    for group in groups:
        spark.dataSource.register(StageListing)
        tasks = 4 * int(spark.conf.get("spark.default.parallelism", None) or spark.sparkContext.defaultParallelism)
        rows = (spark.read.format("stage_listing").option("paths", json.dumps([found[p][1] for p in group]))
                .option("tasks", tasks).load())
        given, real = found[group[0]]
        if given != real:  # the names that the caller knows
            real = re.sub("^([a-z0-9]+):/+", lambda m: f"{m[1]}:/" if m[1] == "file" else m[0], real).rstrip("/")
            rows = rows.withColumn("path", F.concat(F.lit(given.rstrip("/")), F.substring("path", len(real) + 1, 1 << 30)))
        parts.append(rows)
    rest = [p for p in paths if not found[p]]
    if rest:
        parts.append(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(rest)
                     .select("path", "modificationTime", "length"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.where(F.regexp_extract("path", "[^/]*$", 0).rlike(_name_pattern(glob))) if glob else rows


def _name_pattern(glob: str) -> str:
    """A whole-name pattern of a glob with ``* ? [...] {a,b}``."""
    out, depth = "", 0
    for part in re.findall(r"\[[^\]]+\]|.", glob):
        if part in "{}" and (part == "{" or depth):
            depth += 1 if part == "{" else -1
            out += "(?:" if part == "{" else ")"
        elif part.startswith("[") and len(part) > 1:
            out += "[" + part[1:-1].replace("\\", "\\\\").replace("!", "^", 1 if part[1] == "!" else 0) + "]"
        else:
            out += {"*": ".*", "?": "."}.get(part, "|" if part == "," and depth else re.escape(part))
    return f"^(?:{out})$"


def unload(df: DataFrame, stage_path: str, file_format: str = "csv",
           options: Mapping[str, str] | None = None, partition_by: Sequence[str] = (),
           mode: str = "overwrite", target_bytes: int | None = None) -> None:
    """Write a table to a stage prefix, one file per task (the unload is parallel).

    CSV is written without a header; timestamps keep microseconds. With
    ``target_bytes`` (CSV and JSON) the rows are dealt over as many writers as
    make files of about that size, whatever the splits of the input: one pass
    adds up the bytes of all lines, and a round-robin shuffle shares the rows
    out evenly. Sizes are those before compression; one row is never split.
    """
    opts = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"} if file_format == "csv" else {}
    opts.update(options or {})
    if target_bytes is not None:
        if partition_by:
            raise ValueError("target_bytes is for unloads without partition_by")
        df = df.repartition(writers_for(df, file_format, opts, target_bytes))
    writer = df.write.mode(mode).format(file_format).options(**opts)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(stage_path)


def writers_for(df: DataFrame, file_format: str, options: Mapping[str, str], target_bytes: int) -> int:
    """Files of ``target_bytes`` that the rows fill as lines of text, at least one."""
    if file_format not in ("csv", "json"):
        raise ValueError("target_bytes is for csv and json")
    if int(target_bytes) < 1:
        raise ValueError("target_bytes must be positive")
    line = (F.to_csv if file_format == "csv" else F.to_json)(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]), dict(options))
    total = df.select((F.octet_length(line) + 1).cast("long").alias("bytes")).agg(F.sum("bytes")).first()[0]
    return max(1, math.ceil((total or 0) / int(target_bytes)))
