"""Row numbers within groups without sending a group to a single task.

``row_number() over (partition by g order by o)`` hash-partitions on ``g``:
with a handful of templates, or one template holding a third of the files,
a few tasks number everything. Here the rows are range-partitioned on
``(g, o)`` instead (so a hot group is split across many tasks), numbered
locally in sorted order, and shifted by the counts of the same group in
earlier partitions. The per-(partition, group) table that carries the
offsets has at most partitions + groups rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize


def number_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                  out_col: str, name: str = "numbered") -> DataFrame:
    """Add ``out_col``: 1-based position of each row inside its group, in ``order_cols`` order.

    Ties in ``order_cols`` must be broken by the caller (give a unique last key).
    Rows with null group values form their own group. There is one form for
    every input size. The offsets join carries no hint: the planner broadcasts
    the table if its bytes are few, and else shuffles on (partition, group),
    which no hot group can fill.
    """
    group_cols = list(group_cols)
    sort_keys = [F.col(g).asc_nulls_first() for g in group_cols] + list(order_cols)
    keyed = (df.orderBy(*sort_keys)
             .withColumn("_pid", F.spark_partition_id())
             .withColumn("_mid", F.monotonically_increasing_id()))
    # Freeze partition ids and local ids: a recomputation must not renumber.
    keyed = materialize(keyed, name)

    stats = keyed.groupBy("_pid", *group_cols).agg(F.min("_mid").alias("_first"),
                                                   F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    if group_cols:
        w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")

    k, o = keyed.alias("k"), offsets.alias("o")
    cond = F.col("k._pid") == F.col("o._pid")
    for g in group_cols:
        cond = cond & F.col(f"k.{g}").eqNullSafe(F.col(f"o.{g}"))
    joined = k.join(o, cond, "inner")
    position = F.col("o._before") + (F.col("k._mid") - F.col("o._first")) + F.lit(1)
    return joined.select([F.col(f"k.{c}") for c in df.columns] + [position.cast("long").alias(out_col)])
