"""The template in force at each file's own time: a merge of validity starts and file times.

Joining every file with all versions of its template and keeping one makes a
product of files and versions, and a template that a third of the files use
is one hot key. Here both tables are put in one order (template, time), and
each file takes the last version before it. The order is cut into ranges of
like size, so a hot template is spread over many tasks; a range gets the last
version of the ranges before it from a table of ranges + templates rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize


def validity_steps(templates: DataFrame) -> DataFrame:
    """(statement_name, at, version): from ``at`` on that version is in force (null: none), until the next step.

    Where validity ranges overlap, the latest ``effective`` wins, and when it
    ends an earlier one may be in force again; of one ``effective`` the greatest
    row as JSON text wins. Works on the template table
    only: each change of a name is held against that name's versions.
    """
    versions = templates.where(F.col("effective").isNotNull() & F.col("statement_name").isNotNull())
    versions = versions.where(F.col("superseded").isNull() | (F.col("superseded") > F.col("effective")))
    whole = F.struct(*[F.col(c) for c in templates.columns])
    changes = (versions.select("statement_name", F.explode(F.array("effective", "superseded")).alias("at"))
               .where("at IS NOT NULL").distinct())
    v = versions.select(F.col("statement_name").alias("_name"), F.col("effective").alias("_from"),
                        F.col("superseded").alias("_to"), whole.alias("_version"))
    inside = ((F.col("statement_name") == F.col("_name")) & (F.col("_from") <= F.col("at"))
              & (F.col("_to").isNull() | (F.col("_to") > F.col("at"))))
    return (changes.join(v, inside, "left").groupBy("statement_name", "at")
            .agg(F.max_by("_version", F.when(F.col("_name").isNotNull(), F.struct("_from", F.to_json("_version")))).alias("version")))


def template_at(files: DataFrame, templates: DataFrame, time_col: str = "start_time",
                name_col: str = "copy_into_name", path_col: str = "file_path") -> DataFrame:
    """``files`` with ``version``: the template row in force at each file's ``time_col``.

    Every file stays; ``version`` is null without a route, a time or a
    template in force. A template that starts at a file's time is in force.
    """
    steps = validity_steps(templates)
    kind = steps.schema["version"].dataType
    row = F.struct(*[F.col(c) for c in files.columns])
    marks = steps.select(F.col("statement_name").alias("_name"), F.col("at").alias("_at"), F.lit(0).alias("_file"),
                         F.lit(None).cast("string").alias("_path"), F.struct("version").alias("_step"),
                         F.lit(None).cast(files.select(row.alias("r")).schema["r"].dataType).alias("_row"))
    asked = files.select(F.col(name_col).alias("_name"), F.col(time_col).alias("_at"), F.lit(1).alias("_file"),
                         F.col(path_col).cast("string").alias("_path"), F.lit(None).cast(f"struct<version:{kind.simpleString()}>").alias("_step"),
                         row.alias("_row"))
    order = [F.col("_name").asc_nulls_first(), F.col("_at").asc_nulls_first(), F.col("_file"), F.col("_path")]
    # Frozen: a range that is computed again must not get other rows.
    merged = materialize(asked.unionByName(marks).repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), "asof")

    ends = (merged.where("_file = 0").groupBy("_pid", "_name")
            .agg(F.max_by("_step", "_at").alias("_last")))
    # A range may hold files only: the ranges of a name that have files ask, too.
    asking = merged.where("_file = 1").select("_pid", "_name").distinct().withColumn("_last", F.lit(None).cast(ends.schema["_last"].dataType))
    known = ends.unionByName(asking).groupBy("_pid", "_name").agg(F.max_by("_last", F.col("_last").isNotNull()).alias("_last"))
    before = Window.partitionBy("_name").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = known.select("_pid", "_name", F.last("_last", ignorenulls=True).over(before).alias("_carried"))

    inside = Window.partitionBy("_pid", "_name").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = merged.withColumn("_seen", F.last("_step", ignorenulls=True).over(inside)).where("_file = 1")
    m, c = local.alias("m"), carried.alias("c")
    found = m.join(c, (F.col("m._pid") == F.col("c._pid")) & F.col("m._name").eqNullSafe(F.col("c._name")), "left")
    return found.select("m._row.*", F.coalesce("m._seen", "c._carried")["version"].alias("version"))
