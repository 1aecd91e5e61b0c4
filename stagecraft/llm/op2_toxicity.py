"""Operator 2: toxicity by two class-conditional Kneser-Ney models.

A word (a run of letters, in lower case) is the 2-gram of its stem (the first
``STEM`` letters) and its ending (what follows). Each class, toxic and
ordinary, has its own discounted counts of stems and of endings after a stem.
What discounting leaves goes to distributions that both classes share: stems
by their number of different endings, endings after a stem by the counts of
both classes together. So a rare word is judged by its stem, and a word with a
stem never seen says nothing.

Both log-likelihoods are sums over words, so a word's difference of the two is
one number. Words seen in training have theirs in a table; for other words the
shared factor is the same in both classes and cancels, leaving one number a
stem. The corpus's postings (see ``postings``) are joined with these tables.

Labels: rows whose crc32(doc_id as text) mod 4 is 0 or 1 give the counts, rows
with 3 fit three weights on features of texts that the counts have not seen
(a bounded sample, ``FIT_ROWS``), rows with 2 are held out. Features: the
length-normalised difference, the clear evidence (what words have beyond
``CLEAR``) in all and a word. Labels, language, source and id enter no feature.

Cases: a null or empty text has no words and the score of no evidence.
Repeated ids each give a row; contradicting labels count as toxic. Without
labels of both classes every score is 0. Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored
from .postings import block_postings, doc_sums, index_rows, marked_counts, marks

STEM = 4
CLEAR = 2.5
FIT_ROWS = 50_000
CUTOFF = 0.3
#: Most words are rare: larger blocks have them in fewer rows.
BLOCK_BYTES = 24 << 20
_WORD = re.compile(r"[^\W\d_]+")


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def words(texts: list[str]):
    """Occurrences (number, text) of lower-case words."""
    numbers = _Numbers()
    of = numbers.__getitem__
    found = [np.fromiter(map(of, _WORD.findall(t.lower())), np.int64) for t in texts]
    names = list(numbers)
    doc = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    return (np.concatenate(found) if found else np.zeros(0, np.int64)), doc, lambda number: [names[i] for i in number]


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def evidence(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Log-likelihood differences: by word, and by stem for other words.

    ``counts``: (unit, a, b), occurrences in toxic and in ordinary texts.
    """
    stem = F.substring("unit", 1, STEM)
    sums = [F.count("*").cast("double").alias("types")]
    for x in ("a", "b"):
        sums += [F.sum(x).cast("double").alias(f"{x}_stem"), F.sum((F.col(x) > 0).cast("int")).cast("double").alias(f"{x}_types"),
                 F.sum((F.col(x) == 1).cast("int")).alias(f"{x}_once"), F.sum((F.col(x) == 2).cast("int")).alias(f"{x}_twice")]
    stems = stored(counts.groupBy(stem.alias("stem")).agg(*sums), "toxic-stems")
    # One row of totals, used as constants.
    whole = stems.agg(F.sum("types").alias("types"), *[f for x in ("a", "b") for f in (
        F.sum(f"{x}_stem").alias(f"{x}_all"), F.sum((F.col(f"{x}_stem") > 0).cast("int")).alias(f"{x}_stems"),
        F.sum(f"{x}_once").alias(f"{x}_once"), F.sum(f"{x}_twice").alias(f"{x}_twice"))]).first().asDict()
    cut, spare, total = {}, {}, {}
    for x in ("a", "b"):
        once, twice = whole[f"{x}_once"] or 0, whole[f"{x}_twice"] or 0
        cut[x] = min(max(once / (once + 2 * twice), 0.1), 0.9) if once + twice else 0.5
        total[x] = whole[f"{x}_all"] or 0.0
        spare[x] = cut[x] * (whole[f"{x}_stems"] or 0) / total[x] if total[x] else 1.0  # what discounting leaves of all

    def stem_share(x: str) -> Column:
        own = F.greatest(F.col(f"{x}_stem") - cut[x], F.lit(0.0)) / max(total[x], 1.0)
        return own + spare[x] * F.col("types") / float(whole["types"] or 1)

    def left(x: str) -> Column:
        return F.when(F.col(f"{x}_stem") > 0, cut[x] * F.col(f"{x}_types") / F.col(f"{x}_stem")).otherwise(F.lit(1.0))

    stems = stems.select("stem", "a_stem", "b_stem", F.log(stem_share("a") / stem_share("b")).alias("of_stem"),
                         left("a").alias("a_left"), left("b").alias("b_left"))
    rows = counts.join(stems, stem == F.col("stem"))

    def ending_share(x: str) -> Column:
        own = F.when(F.col(f"{x}_stem") > 0, F.greatest(F.col(x) - cut[x], F.lit(0.0)) / F.col(f"{x}_stem")).otherwise(F.lit(0.0))
        return own + F.col(f"{x}_left") * (F.col("a") + F.col("b")) / (F.col("a_stem") + F.col("b_stem"))

    by_word = rows.select("unit", (F.col("of_stem") + F.log(ending_share("a") / ending_share("b"))).cast("float").alias("llr"))
    by_stem = stems.select("stem", (F.col("of_stem") + F.log(F.col("a_left") / F.col("b_left"))).cast("float").alias("llr"))
    return by_word, by_stem


def features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n, llr and clear (sums over the words) of every row of ``docs``."""
    postings = stored(block_postings(docs, "string", words, BLOCK_BYTES), "toxic-postings")
    group = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(fold(F.col("doc_id")).isin(0, 1))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
             .select("doc_id", F.when(F.col("toxic") == 1, "a").otherwise("b").alias("group")))
    bitmaps = stored(marks(index_rows(postings).join(group, "doc_id").select("block", "pos", "group")), "toxic-marks")
    counts = stored(marked_counts(postings, bitmaps, "string"), "toxic-counts")
    by_word, by_stem = evidence(counts)
    # Both joins read one shuffle of the postings; only words that training has not seen move on to their stems.
    rows = postings.where("ids IS NULL AND unit IS NOT NULL").select("block", "unit", "post")
    by_word = stored(by_word, "toxic-words").where("unit IS NOT NULL")
    known = rows.join(by_word, "unit").select("block", "post", "llr")
    rest = (rows.join(by_word, "unit", "left_anti").select("block", "post", F.substring("unit", 1, STEM).alias("stem"))
            .join(by_stem, "stem", "left").select("block", "post", "llr"))  # a stem never seen speaks for neither class: 0
    scored = known.unionByName(rest).withColumn("llr", F.coalesce("llr", F.lit(0.0)))
    scored = scored.withColumn("clear", F.greatest(F.col("llr") - CLEAR, F.lit(0.0)))
    return doc_sums(postings, scored, ["llr", "clear"])


#: Of n, llr and clear: what the weights apply to.
FEATURES = ("llr / greatest(n, 1)", "ln(1 + clear)", "ln(1 + 100 * clear / greatest(n, 1))")


def fit(rows: list[tuple]) -> np.ndarray:
    """Weights of a logistic model (bias last), by Newton steps with a small ridge."""
    data = np.array(rows, float).reshape(-1, len(FEATURES) + 1)
    x, y = np.c_[data[:, :-1], np.ones(len(data))], data[:, -1]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
    return w


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_words and the length-normalised difference."""
    rows = stored(features(docs, labels), "toxic-features")
    rows = rows.selectExpr("doc_id", "n", *[f"{f} AS f{i}" for i, f in enumerate(FEATURES)])
    known = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(fold(F.col("doc_id")) == 3)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")))
    columns = [f"f{i}" for i in range(len(FEATURES))]
    sample = (rows.join(known, "doc_id").select(*columns, "toxic", F.xxhash64("doc_id").alias("h"))
              .orderBy("h", *columns).limit(FIT_ROWS).select(*columns, "toxic").collect())
    both = {r[-1] for r in sample} >= {0, 1}
    w = fit([tuple(r) for r in sample]) if both else None
    z = sum((F.col(c) * float(v) for c, v in zip(columns, w)), F.lit(float(w[-1]))) if both else None
    value = F.round(1 / (1 + F.exp(-z)), 9) if both else F.lit(0.0)
    return (rows.withColumn("score", value)
            .select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "score",
                    (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
                    F.col("n").alias("n_words"), F.col("f0").alias("mean_difference")))
