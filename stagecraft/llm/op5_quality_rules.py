"""Operator 5: quality rules with risk-controlled thresholds.

One pass measures every text. Each rule is a share of the text, higher is
worse, and a stratum is a language. The labelled texts of quality 1 are the
holdout: they fit nothing, they only test cutoffs. For every stratum, rule and
cutoff of a fixed grid, the exact (Clopper-Pearson) upper bound of the share
of good texts beyond the cutoff is computed at level ``DELTA`` divided by the
number of strata x rules (Bonferroni). The cutoffs of one rule are tested in a
fixed sequence from the loosest on, up to the first whose bound exceeds
``RISK``; such a sequence needs no further division. The last one accepted is
taken; a rule without one rejects nothing in that stratum. So with probability
1 - DELTA at least, no stratum loses more than RISK x (number of rules) of its
good texts: 10% is the guarantee, not what is to be expected.

A stratum needs log(DELTA / (strata x rules)) / log(1 - RISK) good labels for
any cutoff, even if none of its good texts lies beyond it: 297 with four
languages, 229 with one. Smaller strata keep all that the base rule keeps.

Counts are aggregated by stratum, rule and grid step before they meet.

Cases: a null or empty text has no words and fails the base rule. A null
language is the stratum ''. A stratum with too few labelled good texts (above)
rejects nothing beyond the base rule. Repeated ids each give a row. Other columns are
not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import stored
from .postings import blocks

RISK, DELTA, GRID = 0.02, 0.05, 100
#: Rules: a share of the text in 0..1, higher is worse.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
}
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_lines")


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def window_hash(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each window of ``size`` numbers."""
    h = np.zeros(max(len(codes) - size + 1, 0), np.uint64)
    for k in range(size):
        h = (h + codes[k:len(codes) - size + 1 + k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def repeat_words(words: list[list[bytes]], size: int = 5) -> np.ndarray:
    """Words of each text within windows of ``size`` words that the text has twice or more."""
    numbers = _Numbers()
    of = numbers.__getitem__
    codes = np.concatenate([np.fromiter(map(of, w), np.int64) for w in words] or [np.zeros(0, np.int64)])
    doc = np.repeat(np.arange(len(words)), [len(w) for w in words])
    if len(codes) < size:
        return np.zeros(len(words), np.int64)
    inside = np.flatnonzero(doc[:len(doc) - size + 1] == doc[size - 1:])
    h = window_hash(codes, size)[inside] ^ (doc[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, inside[twice], 1)
    np.add.at(edge, inside[twice] + size, -1)
    return np.bincount(doc[np.cumsum(edge)[:-1] > 0], minlength=len(words))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the measures of every whole text."""
    def run(batches):
        for batch in (b for big in batches for b in blocks([big])):
            texts = batch.column(1).to_pylist()
            words = [t.encode("utf-8").split() for t in texts]
            rows = []
            for t in texts:
                lines = [x for x in t.split("\n") if x.strip(SPACES)]
                codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
                capitals = int(np.count_nonzero((codes - 65 < 26) | ((codes - 192 < 31) & (codes != 215))))
                rows.append((len(t) - sum(map(t.count, SPACES)), sum(map(t.count, SYMBOLS)), len(lines) - len(set(lines)),
                             capitals, t.count("!") + t.count("?"), len(lines)))
            chars, symbols, dups, capitals, marks, lines = zip(*rows)
            columns = ([len(w) for w in words], chars, symbols, dups, repeat_words(words), capitals, marks, lines)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(c, type=pa.int64()) for c in columns)],
                                             names=["doc_id", "lang", *_COLUMNS])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
    ).mapInArrow(run, "doc_id long, lang string, " + ", ".join(f"{c} long" for c in _COLUMNS))


def upper_bound(k: int, n: int, level: float) -> float:
    """Clopper-Pearson: the largest p under which k or fewer of n still have probability ``level``."""
    if n == 0 or k >= n:
        return 1.0
    steps = np.arange(k + 1)
    choose = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in steps])
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        logs = choose + steps * math.log(p) + (n - steps) * math.log1p(-p) if p < 1 else np.array([-np.inf])
        top = logs.max()
        tail = top + math.log(np.exp(logs - top).sum()) if np.isfinite(top) else -np.inf
        low, high = (p, high) if tail > math.log(level) else (low, p)
    return high


def cutoffs(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, rule, cutoff): the accepted cutoffs only."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    holdout = measured.join(good, "doc_id", "left_semi")
    strata = holdout.groupBy("lang").agg(F.count("*").alias("n"))
    tests = F.col("strata") * len(RULES)  # the grid is a fixed sequence
    # A text lies beyond cutoff j / GRID for all j below its step.
    steps = holdout.select("lang", F.explode(F.map_from_arrays(
        F.array(*map(F.lit, RULES)), F.array(*[F.ceil(F.expr(r) * GRID).cast("int") for r in RULES.values()]))).alias("rule", "step"))
    counts = steps.groupBy("lang", "rule", "step").agg(F.count("*").alias("m"))
    grid = (strata.select("lang", "n", F.explode(F.array(*map(F.lit, RULES))).alias("rule"))
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(GRID - 1))).alias("j")))
    at = F.coalesce("m", F.lit(0))
    beyond = Window.partitionBy("lang", "rule").orderBy(F.desc("j")).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    @F.pandas_udf("double")
    def bounded(k, n, number):
        return pd.Series([upper_bound(int(a), int(b), DELTA / m) for a, b, m in zip(k, n, number)], dtype=float)

    # A window here has GRID rows.
    tested = (grid.join(counts.withColumn("j", F.col("step") - 1).drop("step"), ["lang", "rule", "j"], "left")
              .withColumn("k", F.sum(at).over(beyond)).crossJoin(F.broadcast(strata.agg(F.count("*").alias("strata"))))
              .withColumn("ok", bounded("k", "n", tests) <= RISK)
              .withColumn("all_ok", F.min("ok").over(beyond)))
    return tested.where("all_ok").groupBy("lang", "rule").agg((F.min("j") / GRID).alias("cutoff"))


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The measures of every text, base_failed, kept, and the rules that it broke."""
    measured = stored(measures(docs), "rules-measures")
    taken = stored(cutoffs(measured, labels), "rules-cutoffs").groupBy("lang").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    broken = F.array_compact(F.array(*[F.when(F.expr(r) > F.col(f"`{name}`"), F.lit(name)) for name, r in RULES.items()]))
    return (measured.join(taken, "lang", "left")
            .withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))
            .withColumn("broken", broken)
            .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
            .drop(*RULES))
