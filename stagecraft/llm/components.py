"""Connected components by least labels, one stored table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, root) for every id in ``edges`` (a, b): the least id that it is linked with.

    In each round every id takes the least label around it, then that label's
    own label, so long chains shorten by half at least. Labels and edges stay
    distributed; a round's table is written to the shared folder.
    """
    both = stored(edges.select("a", "b").where("a <> b").union(edges.selectExpr("b", "a").where("a <> b")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "labels")
    for _ in range(rounds):
        least = both.join(labels.withColumnsRenamed({"id": "b"}), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        # A root learns from its members too: labels flow up as well as down.
        up = least.join(labels, "id").groupBy(F.col("root").alias("id")).agg(F.min("near").alias("up"))
        step = (labels.join(least, "id").join(up, "id", "left")
                .select("id", F.col("root").alias("old"), F.least("root", "near", F.coalesce("up", "root")).alias("mid")))
        jump = labels.select(F.col("id").alias("mid"), F.col("root").alias("far"))
        new = stored(step.join(jump, "mid", "left").select("id", "old", F.least("mid", F.coalesce("far", "mid")).alias("root")), "labels")
        labels = new.select("id", "root")
        if new.where("old <> root").isEmpty():
            break
    else:
        raise RuntimeError(f"components: not finished after {rounds} rounds")
    return labels
