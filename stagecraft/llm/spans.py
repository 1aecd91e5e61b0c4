"""Places of regular-expression matches, with SQL functions only.

Spark gives the matches of a pattern and the pieces between them; the running
sum of both lengths gives each match's place in code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Matches whose spans are put together at a time: appending to an array copies it.
RUN = 256

SPAN = "array<struct<start:long,ord:int,end:long,kind:string,value:string>>"


def none() -> Column:
    return F.array().cast(SPAN)


def runs_of(items: Column) -> Column:
    """The array cut into runs of at most ``RUN``."""
    return F.element_at(F.transform(F.array(items), lambda x: F.when(F.size(x) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(x) - 1) / RUN).cast("int")), lambda i: F.slice(x, i * RUN + 1, RUN))).otherwise(F.array())), 1)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def find(text: Column, pattern: str, kind: str, order: int, group: int = 0, hit: Column | None = None,
         keep: Callable[[Column, Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches as spans (end exclusive); ``value`` is group ``group``.

    ``hit``: a cheap condition that all texts with matches meet.
    ``keep(value, match)``: matches that fail it are dropped, not tried again.
    """
    regex = F.lit(pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    value = F.regexp_extract_all(text, regex, F.lit(group)) if group else whole
    pieces = F.split(text, pattern, -1)
    each = F.zip_with(F.zip_with(pieces, whole, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m"))), value,
                      lambda x, v: F.struct(F.length(x["gap"]).cast("long").alias("gap"), x["m"].alias("m"), v.alias("v")))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(kind).alias("kind"), x["v"].alias("value"))
        good = keep(x["v"], x["m"]) if keep else F.lit(True)
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).cast(SPAN).alias("found"))

    def run(acc: Column, part: Column) -> Column:
        inside = F.aggregate(part, F.struct(acc["at"].alias("at"), none().alias("found")), step)
        return once(inside, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["runs"], F.array(x["found"])).alias("runs")))

    # The piece behind the last match has no match.
    found = F.aggregate(runs_of(F.filter(each, lambda x: x["m"].isNotNull())),
                        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("runs")),
                        run, lambda acc: F.flatten(acc["runs"]))
    return F.when(hit if hit is not None else text.rlike(pattern), found).otherwise(none())


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """``text`` with each span of sorted ``spans`` replaced; a span that begins inside an earlier one goes with it."""
    def step(region: Column, begin: Column):
        def one(acc: Column, s: Column) -> Column:
            gap = F.substring(region, (acc["at"] - begin + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                            F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, mark(s))).otherwise(acc["out"]).alias("out"))
        return one

    def run(acc: Column, r: Column) -> Column:
        # A run's own part of the text is cut out once; what follows its last span goes with it.
        region = F.substring(text, (r["begin"] + 1).cast("int"), (r["stop"] - r["begin"]).cast("int"))
        inside = once(region, lambda part: once(
            F.aggregate(r["part"], F.struct(acc["at"].alias("at"), F.lit("").alias("out")), step(part, r["begin"])),
            lambda x: F.struct(F.greatest(x["at"], r["stop"]).alias("at"), F.concat(x["out"], F.substring(
                part, (x["at"] - r["begin"] + 1).cast("int"), F.greatest(r["stop"] - x["at"], F.lit(0)).cast("int"))).alias("out"))))
        return once(inside, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["outs"], F.array(x["out"])).alias("outs")))

    def with_ends(runs: Column) -> Column:
        return F.transform(runs, lambda part, i: F.struct(
            part.alias("part"), F.when(i == 0, F.lit(0).cast("long")).otherwise(F.element_at(part, 1)["start"]).alias("begin"),
            F.coalesce(F.element_at(F.get(runs, i + 1), 1)["start"], F.length(text).cast("long")).alias("stop")))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("outs"))
    whole = F.aggregate(once(runs_of(spans), with_ends), start, run, lambda acc: F.array_join(acc["outs"], ""))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
