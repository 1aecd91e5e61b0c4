"""Operator 9: quality classifier by an interpolated modified Kneser-Ney model.

Units are characters, with order 3: runs of white space are one space, and two
start signs and an end sign frame each text. The trusted text is every text
whose label says quality 1. Counts are kept as sharded tables keyed by n-gram;
joins on n-grams give each n-gram of the corpus its log-probability, and a
join with the corpus's postings (see ``postings``) gives every text's sum.
Nothing is broadcast by request and no table is capped: all of them grow with
the input.

Discounts (three an order) come from the counts of counts. The lowest order is
interpolated with a uniform distribution over the corpus's characters and one
more, so that an unseen character has a probability.

A text's score is its log-perplexity, drawn towards its language's mean by
``PRIOR`` characters so that a short text needs strong evidence. A text is
rejected if that exceeds its language's limit: the ``QUANTILE`` of the trusted
texts plus ``SLACK`` times the distance of that quantile from their median.
A language without trusted texts takes the limits of all trusted texts.

Cases: a null or empty text has only its frame, hence a score near the mean
and is kept. A null language is ''. Repeated ids: each row gets its own row;
labels that contradict each other count as trusted. Without trusted texts
there is no limit and all are kept. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored
from .postings import block_postings, doc_sums, index_rows, marked_counts, marks

QUANTILE = 0.99
SLACK = 1.5
PRIOR = 200
START, END = 2, 3
_BITS = 21  # of a code point


def trigrams(texts: list[str]):
    """Occurrences (number, text) of character 3-grams; numbers are dense in this block."""
    framed = [chr(START) * 2 + " ".join(t.split()) + chr(END) for t in texts]
    codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(f) for f in framed])
    letters = np.flatnonzero(np.bincount(codes, minlength=1)).astype(np.int64)
    small = np.zeros(int(letters[-1]) + 1, np.int32)
    small[letters] = np.arange(len(letters))
    k, x = len(letters), small[codes]
    del codes
    doc = np.repeat(np.arange(len(texts), dtype=np.int16), size)
    inside = doc[:-2] == doc[2:]
    unit = x[:-2].astype(np.int64)
    for next_ in (x[1:-1], x[2:]):
        unit *= k
        unit += next_
    del x

    def name(number):
        return (letters[number // (k * k)] << 2 * _BITS) | (letters[number // k % k] << _BITS) | letters[number % k]
    return unit[inside], doc[:-2][inside], name


def _discounts(order: int) -> list[str]:
    """The three discounts of one order, from its counts of counts (columns n<order><1 to 4>)."""
    n1, n2, n3, n4 = (f"n{order}{i}" for i in (1, 2, 3, 4))
    y = f"{n1} / nullif({n1} + 2 * {n2}, 0)"

    def discount(i: int, n: str, more: str) -> str:
        raw = f"{i} - {i + 1} * ({y}) * {more} / nullif({n}, 0)"  # null: too few counts to tell
        return f"CASE WHEN ({raw}) IS NULL THEN 0.5 ELSE least(greatest({raw}, 0.05), {i} - 0.05) END AS d{order}{i}"

    return [discount(1, n1, n2), discount(2, n2, n3), discount(3, n3, n4)]


def _share(count: str, total: str, order: int) -> Column:
    """The discounted share of an n-gram among those of its history; null if it was never seen."""
    n, d = F.col(count), [F.col(f"d{order}{i}") for i in (1, 2, 3)]
    return (n - F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])) / F.col(total)


def _left(order: int) -> Column:
    """The mass that a history leaves to the order below; null for a history never seen."""
    return sum(F.col(f"{k}{order}") * F.col(f"d{order}{i}") for i, k in ((1, "ones"), (2, "twos"), (3, "more"))) / F.col(f"total{order}")


def _sums(order: int, n: Column) -> list[Column]:
    """Sum of the counts ``n`` of one order, and how many are 1, 2 and more; nulls are left out."""
    return [F.sum(n).alias(f"total{order}"), F.count(F.when(n == 1, 1)).alias(f"ones{order}"),
            F.count(F.when(n == 2, 1)).alias(f"twos{order}"), F.count(F.when(n > 2, 1)).alias(f"more{order}")]


def log_probabilities(corpus: DataFrame, counts: DataFrame) -> DataFrame:
    """(unit, nll) of every n-gram of ``corpus`` (unit) under the model of ``counts`` (unit, a).

    The lower orders and what the whole model shares (one row: discounts, the
    lowest order's sums, the number of characters) are stored first: in one
    plan each would be counted again wherever it is used, and the driver would
    hold some forty shuffles and broadcasts at once.
    """
    mask = (1 << 2 * _BITS) - 1
    parts = {"ab": F.shiftright("unit", _BITS), "bc": F.col("unit").bitwiseAND(F.lit(mask)),
             "b": F.shiftright("unit", _BITS).bitwiseAND(F.lit((1 << _BITS) - 1)), "c": F.col("unit").bitwiseAND(F.lit((1 << _BITS) - 1))}
    tri = counts.where("a > 0").select("unit", F.col("a").alias("n")).withColumns(parts)
    # Lower orders count the different n-grams that continue them.
    two = stored(tri.groupBy("bc", "b", "c").agg(F.count("*").alias("n")), "quality-two")
    one = stored(two.groupBy("c").agg(F.count("*").alias("n")), "quality-one")
    units = corpus.withColumns(parts)
    every = (tri.select(F.lit(3).alias("order"), "n").unionByName(two.select(F.lit(2).alias("order"), "n"))
             .unionByName(one.select(F.lit(1).alias("order"), "n")))
    sizes = every.agg(*[F.sum(F.when((F.col("order") == k) & (F.col("n") == i), 1).otherwise(0)).cast("double").alias(f"n{k}{i}")
                        for k in (1, 2, 3) for i in (1, 2, 3, 4)], *_sums(1, F.when(F.col("order") == 1, F.col("n"))))
    letters = units.agg((F.count_distinct("c") + 1).alias("letters"))
    fixed = sizes.where("total1 IS NOT NULL").selectExpr("total1", "ones1", "twos1", "more1", *(d for k in (1, 2, 3) for d in _discounts(k)))
    fixed = F.broadcast(stored(fixed.crossJoin(F.broadcast(letters)), "quality-fixed"))  # one row; none without trusted text
    low = F.coalesce(_share("n1", "total1", 1), F.lit(0.0)) + _left(1) / F.col("letters")
    mid = F.coalesce(_share("n2", "total2", 2), F.lit(0.0)) + F.coalesce(_left(2), F.lit(1.0)) * low
    lower = (units.select("bc", "b", "c").distinct().join(two.select("bc", F.col("n").alias("n2")), "bc", "left")
             .join(two.groupBy("b").agg(*_sums(2, F.col("n"))), "b", "left")
             .join(one.select("c", F.col("n").alias("n1")), "c", "left").crossJoin(fixed))
    lower = stored(lower.select("bc", mid.alias("mid")), "quality-lower")
    top = F.coalesce(_share("n3", "total3", 3), F.lit(0.0)) + F.coalesce(_left(3), F.lit(1.0)) * F.col("mid")
    rows = (units.select("unit", "ab", "bc").join(tri.select("unit", F.col("n").alias("n3")), "unit", "left")
            .join(tri.groupBy("ab").agg(*_sums(3, F.col("n"))), "ab", "left").join(lower, "bc").crossJoin(fixed))
    return rows.select("unit", (-F.log(top)).alias("nll"))


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, lang, n, nll (sum) and trusted, for every row of ``docs``; ``trusted`` has the ids of trusted texts."""
    postings = stored(block_postings(docs, "long", trigrams), "quality-postings")
    good = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    chosen = index_rows(postings).join(good, "doc_id").select("block", "pos", F.lit("a").alias("group"))
    bitmaps = stored(marks(chosen), "quality-trusted")
    counts = stored(marked_counts(postings, bitmaps, "long"), "quality-counts")
    grams = postings.where("ids IS NULL").select("unit").distinct()
    model = stored(log_probabilities(grams, counts), "quality-model")
    scored = postings.where("ids IS NULL").select("block", "unit", "post").join(model, "unit")
    sums = doc_sums(postings, scored, ["nll"])
    return sums.join(good.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_chars, perplexity, score (log-perplexity, drawn to the mean), limit and kept."""
    trusted = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    rows = stored(perplexities(docs, trusted), "quality-sums")
    good = rows.where("trusted")
    # A row a language, written first: the planner then knows that it is small and no text moves to its language's task.
    center = stored(good.groupBy("lang").agg((F.sum("nll") / F.sum("n")).alias("mean")), "quality-means")
    center_all = good.agg((F.sum("nll") / F.sum("n")).alias("mean_all"))
    drawn = (rows.join(center, "lang", "left").crossJoin(F.broadcast(center_all))
             .withColumn("mean", F.coalesce("mean", "mean_all"))
             .withColumn("score", (F.col("nll") + PRIOR * F.col("mean")) / (F.col("n") + PRIOR)))

    def limit(name: str) -> Column:
        q = F.percentile_approx("score", F.array(F.lit(0.5), F.lit(QUANTILE)), 10_000)
        return (q[1] + SLACK * (q[1] - q[0])).alias(name)

    limits = stored(drawn.where("trusted").groupBy("lang").agg(limit("limit")), "quality-limits")
    limit_all = drawn.where("trusted").agg(limit("limit_all"))
    return (drawn.join(limits, "lang", "left").crossJoin(F.broadcast(limit_all))
            .select("doc_id", "lang", F.col("n").alias("n_units"), F.exp(F.col("nll") / F.col("n")).alias("perplexity"), "score",
                    F.coalesce("limit", "limit_all").alias("limit"))
            .withColumn("kept", F.coalesce(F.col("score") <= F.col("limit"), F.lit(True))))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps; each row is judged by its id, text and language, null ids too."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "lang")]))
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    good = keyed.select("_key", F.col("doc_id").cast("long").alias("doc_id")).join(trusted, "doc_id", "left_semi")
    rows = classify(keyed.withColumn("doc_id", F.col("_key")).select(*docs.columns), good.select(F.col("_key").alias("doc_id"), F.lit(1).alias("quality")))
    gone = rows.where("NOT kept").select(F.col("doc_id").alias("_key")).distinct()
    return keyed.join(gone, "_key", "left_anti").select(*docs.columns)
