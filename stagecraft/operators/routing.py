"""Routing by a table of many rules: which LIKE pattern with the least number matches a path.

A list of rules is a CASE (``manifest.route_files``); ten thousand branches for
each of millions of files are not. Here each rule is filed under one piece of
its text, the piece that the fewest rules have, and a path is looked up by its
own pieces: an equi-join, then the exact LIKE on the pairs that meet, and the
least rule number of those that hold. Rules of wildcards only say no more than a
length, and are filed under that. No product of files and rules is made.

A path has hundreds of pieces, and rules have few of them: a bitmap of the rules'
pieces (32 MB at most) goes to all tasks, and pieces that it rules out are never
shuffled. What is left meets by its whole hash and paths follow by theirs; the
exact LIKE drops pairs that met by chance.

Many files go slice by slice (dealt by the hash of the path): what a slice
shuffles is dropped when its rows are stored, so the disk holds the listing, its
result and one slice's shuffles.

The planner takes exploded rows for as few as their source, so joins whose sides
grow with files or rules are told not to broadcast; only the table of lengths is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize, path_exists, remove_path, shuffles_dropped, work_dir
from .pieces import ANY, FIRST, LAST, bitmap, windows, with_keys

#: Letters of a piece; a shorter text between two "%" is one piece.
PIECE = 12
#: Files of a slice, and slices at most.
SLICE, SLICES = 4_000_000, 64
RULES_SCHEMA = "rule_no long, pattern string, copy_into_name string"


def _texts(pattern: Column) -> Column:
    """What a LIKE pattern holds between "%", its begin and end marked: escapes resolved, "_" as ANY."""
    plain = F.regexp_replace(pattern, f"[{ANY}{FIRST}{LAST}]", "_")  # letters that are marks here say nothing
    cut = F.regexp_extract_all(F.concat(F.lit(FIRST), plain, F.lit(LAST)), F.lit(r"(?s)(?:[^%\\]|\\.)++"), F.lit(0))
    return F.transform(cut, lambda t: F.regexp_replace(F.regexp_replace(t, r"(?s)((?:[^_\\]|\\.)*+)_", f"$1{ANY}"), r"(?s)\\(.)", "$1"))


def _pieces(text: Column) -> Column:
    """All windows of PIECE letters (of a shorter text, itself) with at most one gap; where there are none, those of the runs between gaps."""
    def cut(t):
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - PIECE + 1, F.lit(1))), lambda i: F.substring(t, i, PIECE))

    def kept(array):
        trimmed = F.transform(array, lambda w: F.regexp_replace(w, f"^{ANY}+|{ANY}+$", ""))
        return F.filter(trimmed, lambda w: w.rlike(f"[^{ANY}{FIRST}{LAST}]") & ~w.rlike(f"(?s){ANY}[^{ANY}]+{ANY}"))
    whole = kept(cut(text))
    return F.when(F.size(whole) > 0, whole).otherwise(kept(F.flatten(F.transform(F.split(text, f"{ANY}+"), cut))))


def rule_index(rules: DataFrame) -> DataFrame:
    """(piece, shape, rule_no, pattern, copy_into_name): each rule under its rarest piece; null where it has no literal text."""
    runs = rules.where("pattern IS NOT NULL").select("rule_no", "pattern", "copy_into_name", F.flatten(F.transform(_texts(F.col("pattern")), _pieces)).alias("pieces"))
    # Literal text of marks alone: the begin, which all paths have.
    pieces = F.when(F.size("pieces") > 0, F.array_distinct("pieces")).when(F.col("pattern").rlike("(?s)[^%_]"), F.array(F.lit(FIRST)))
    cut = runs.select("rule_no", "pattern", "copy_into_name", F.explode_outer(pieces).alias("piece"))
    often = cut.where("piece IS NOT NULL").groupBy("piece").agg(F.count("*").alias("n"))
    letters = F.length(F.replace("piece", F.lit(ANY), F.lit("")))
    shape = F.translate(F.regexp_replace("piece", f"(?s)[^{ANY}{FIRST}{LAST}]", "x"), f"{ANY}{FIRST}{LAST}", "_^$")
    return (cut.hint("merge").join(often, "piece", "left").groupBy("rule_no", "pattern", "copy_into_name")
            .agg(F.min(F.struct("n", (-letters).alias("letters"), "piece")).alias("rarest"))
            .select("rule_no", "pattern", "copy_into_name", F.col("rarest.piece").alias("piece"))
            .select("*", shape.alias("shape")))


def _route(files: DataFrame, index: DataFrame, look, path_col: str, out_col: str) -> DataFrame:
    """``files`` with the answer; ``look`` finds the pieces of paths."""
    paths = files.select(F.col(path_col).alias("_path")).where("_path IS NOT NULL").distinct()
    cut = look(paths.select(F.xxhash64("_path").alias("_id"), F.concat(F.lit(FIRST), "_path", F.lit(LAST)).alias("text")))
    filed = index.where("key IS NOT NULL").select(F.col("key").alias("_piece"), "rule_no", "pattern", "copy_into_name")
    near = cut.join(filed.hint("shuffle_hash"), "_piece")
    met = near.hint("merge").join(paths.withColumn("_id", F.xxhash64("_path")), "_id").where(F.expr("_path LIKE pattern"))
    best = met.groupBy("_path").agg(F.min(F.struct("rule_no", "pattern", "copy_into_name")).alias("_rule"))

    # Wildcards only: "%" among them asks for a least length, else for one length.
    loose = (index.where("key IS NULL").select("rule_no", "pattern", "copy_into_name", F.col("pattern").contains("%").alias("open"),
                                               F.length(F.regexp_replace("pattern", "[^_]", "")).alias("n"))
             .groupBy("open", "n").agg(F.min(F.struct("rule_no", "pattern", "copy_into_name")).alias("r")))
    top = files.agg(F.max(F.length(path_col)).alias("top"))
    fits = loose.crossJoin(F.broadcast(top)).where("n <= top").select(  # one row; then one row a length
        F.explode(F.when(F.col("open"), F.sequence("n", "top")).otherwise(F.array("n"))).alias("_size"), "r").groupBy("_size").agg(F.min("r").alias("_loose"))
    return (files.hint("merge").join(best, files[path_col] == best["_path"], "left")
            .join(F.broadcast(fits), F.length(files[path_col]) == fits["_size"], "left")
            .select(*[files[c] for c in files.columns if c != out_col], F.least("_rule", "_loose")["copy_into_name"].alias(out_col)))


def route_by_rules(files: DataFrame, rules: DataFrame, path_col: str = "file_path", out_col: str = "copy_into_name") -> DataFrame:
    """``files`` with the template of the least rule number whose pattern matches the path (none: null).

    ``rules``: ``rule_no, pattern, copy_into_name``; of equal numbers the least pattern goes first.
    """
    spark = files.sparkSession
    # Of rules with one pattern the first alone can be the answer.
    first = rules.groupBy("pattern").agg(F.min(F.struct("rule_no", "copy_into_name")).alias("r")).select("r.rule_no", "pattern", "r.copy_into_name")
    with shuffles_dropped(spark):
        index = materialize(with_keys(rule_index(first)).drop("piece"), "rule-index")
        filed = index.where("key IS NOT NULL")
        shapes = sorted(r[0] for r in filed.select("shape").distinct().collect())
        data, top = bitmap(filed.select("key").distinct())
        slices = min(-(-files.count() // SLICE), SLICES)
    bits = spark.sparkContext.broadcast(data)

    def look(texts):
        return windows(texts, shapes, bits, top)
    if slices <= 1:
        return _route(files, index, look, path_col, out_col)
    listed, done = work_dir(spark, "route-files"), work_dir(spark, "routed")
    kept = files.drop(out_col)
    with shuffles_dropped(spark):
        kept.withColumn("_slice", F.pmod(F.xxhash64(path_col), F.lit(slices))).write.partitionBy("_slice").parquet(listed)
        for i in range(slices):
            if path_exists(spark, folder := f"{listed}/_slice={i}"):
                routed = _route(spark.read.schema(kept.schema).parquet(folder), index, look, path_col, out_col)
                routed.write.mode("append").parquet(done)
                remove_path(spark, folder)
    remove_path(spark, listed)
    return spark.read.schema(routed.schema).parquet(done)


__all__ = ["RULES_SCHEMA", "route_by_rules", "rule_index"]
