"""Operator 3 [native]: secret scans by two character Markov models.

Patterns find assignments, access keys and long hexadecimal strings. Beyond
them, any run of ``LEAST`` or more key characters with a letter is a candidate
(numbers are no keys). Two first-order Markov models over key characters, one of random
strings and one of ordinary identifiers, give the candidate's log-likelihood
ratio; above ``RATIO`` in all and ``RATIO_PER_CHAR`` a character it is a
secret too ("markov"), unless it touches a pattern's span, which always stays.

Labelled samples: random strings are the values that the patterns matched, in
all texts; identifiers are the words of ``ORDINARY_TEXTS`` labelled texts (a
bounded sample, least hashes first) outside of the patterns' matches and of long
runs of letters and digits.

SQL functions only. The models are a table of at most 66 x 66 numbers, which
is that small by its alphabet and enters the scan as a constant.

Cases: a null or empty text has no spans. Repeated rows each give a row.
A pair that a model has not seen has its second character's probability;
without random strings or identifiers all characters are equally likely in
that model. Other columns are not read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from . import spans
from .common import stored

#: The fixed patterns of the three kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 or more: the run is whole either way
HEX = "[0-9a-f]{24,}"         # [0-9a-f]+ of 24 or more
ASSIGN_HIT = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"

KEY = "A-Za-z0-9+/_=-"
LEAST, RATIO, RATIO_PER_CHAR = 12, 12.0, 0.5
CANDIDATE = rf"(?<![{KEY}])(?=[0-9+/_=-]*+[A-Za-z])[{KEY}]{{{LEAST},}}+"
#: Runs that are no sample of identifiers: long ones with letters and digits.
MIXED = rf"(?<![{KEY}])(?=[0-9+/_=-]*[A-Za-z])(?=[A-Za-z+/_=-]*[0-9])[{KEY}]{{16,}}+"
ORDINARY_TEXTS = 2000
#: Added to each character's count, and the weight of single characters in a pair's probability.
SMOOTH, BACKOFF = 0.5, 20.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def base_spans(text: Column) -> Column:
    return F.array_sort(F.concat(
        spans.find(text, ASSIGN, "assign", 0, 2, text.rlike(ASSIGN_HIT), lambda v, m: F.length(v) >= 6),
        spans.find(text, ACCESS, "access", 1, 0, text.contains("AKIA")),
        spans.find(text, HEX, "hex", 2)))


def _neighbours(value: Column, make) -> Column:
    """``make(x, y)`` for neighbouring characters; the string is cut into characters once."""
    return spans.once(F.split(value, ""), lambda c: F.zip_with(
        F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), make))


def _pairs(strings: DataFrame) -> DataFrame:
    """(pair, n): neighbouring key characters of the strings of column ``s``."""
    return (strings.where(F.length("s") > 1).select(F.explode(_neighbours(F.col("s"), lambda x, y: F.concat(x, y))).alias("pair"))
            .where(F.col("pair").rlike(f"^[{KEY}]{{2}}$")).groupBy("pair").agg(F.count("*").alias("n")))


def markov(counts: dict[str, int]) -> dict[str, float]:
    """Log-probability of each character after another: pair counts, backed off to counts of the second alone."""
    size = len(ALPHABET)
    single = {y: sum(counts.get(x + y, 0) for x in ALPHABET) for y in ALPHABET}
    total = sum(single.values())
    alone = {y: (single[y] + SMOOTH) / (total + SMOOTH * size) for y in ALPHABET}
    after = {x: sum(counts.get(x + y, 0) for y in ALPHABET) for x in ALPHABET}
    return {x + y: math.log((counts.get(x + y, 0) + BACKOFF * alone[y]) / (after[x] + BACKOFF)) for x in ALPHABET for y in ALPHABET}


def train(found: DataFrame, docs: DataFrame, labels: DataFrame) -> list[float]:
    """Log-ratios of all pairs of key characters, row by row of the alphabet.

    ``found``: base spans of all texts.
    """
    secret = _pairs(found.select(F.explode("base").alias("s")).select(F.col("s.value").alias("s")))
    ids = (labels.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(ORDINARY_TEXTS))
    plain = docs.join(F.broadcast(ids), "doc_id", "left_semi").select(_text().alias("text"))  # at most ORDINARY_TEXTS ids
    for pattern in (ASSIGN, ACCESS, HEX, MIXED):
        plain = plain.withColumn("text", F.regexp_replace("text", pattern, " "))
    ordinary = _pairs(plain.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z_][A-Za-z0-9_-]{3,}"), F.lit(0))).alias("s")))
    rows = secret.withColumnRenamed("n", "a").join(ordinary.withColumnRenamed("n", "b"), "pair", "full").fillna(0).collect()  # 66 x 66 at most
    random, plain_words = (markov({r["pair"]: r[k] for r in rows}) for k in ("a", "b"))
    return [round(random[x + y] - plain_words[x + y], 6) for x in ALPHABET for y in ALPHABET]


def log_ratio(value: Column, model: list[float]) -> Column:
    """Sum over neighbouring characters of the log of random over ordinary."""
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")

    def place(c: Column) -> Column:
        return F.instr(F.lit(ALPHABET), c)

    cells = _neighbours(value, lambda x, y: (place(x) - 1) * len(ALPHABET) + place(y))
    return F.aggregate(cells, F.lit(0.0), lambda acc, i: acc + F.element_at(table, i.cast("int")))


def scan(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``spans`` (all, sorted) and ``base`` (of the patterns)."""
    rows = docs.select("doc_id", _text().alias("text"))
    found = rows.select("doc_id", F.xxhash64("text").alias("sign"), base_spans(F.col("text")).alias("base"),
                        spans.find(F.col("text"), CANDIDATE, "markov", 3).alias("more"))
    found = stored(found, "secret-spans")
    model = train(found.select("base"), docs, labels)

    def apart(s: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    def likely(s: Column) -> Column:
        ratio = log_ratio(s["value"], model)
        return (ratio >= RATIO) & (ratio >= RATIO_PER_CHAR * F.length(s["value"]))

    more = F.filter("more", lambda s: apart(s) & likely(s))
    return (found.withColumn("more", F.when(F.size("more") > 0, more).otherwise(spans.none()))
            .withColumn("spans", F.array_sort(F.concat("base", "more"))).drop("more"))


def report(found: DataFrame) -> DataFrame:
    """The digest columns of ``scan``."""
    return found.select("doc_id", *[spans.count(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
                        F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"), spans.joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; rows, ids and other columns stay."""
    some = (scan(docs, labels).where(F.size("spans") > 0)
            .groupBy(F.col("doc_id").alias("_id"), F.col("sign").alias("_of")).agg(F.first("spans").alias("_spans")))
    text = _text()
    changed = spans.replaced(text, F.coalesce("_spans", spans.none()), lambda s: F.concat(F.lit("["), s["kind"], F.lit("]")))
    out = docs.withColumn("_sign", F.xxhash64(text))
    out = out.join(some, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sign") == F.col("_of")), "left")
    return out.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(changed)).select(*docs.columns)
