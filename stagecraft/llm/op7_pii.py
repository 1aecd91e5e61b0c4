"""Operator 7 [native]: personal data, with information-theoretic sanitisation.

Patterns find e-mail and IP addresses, card and phone numbers. Each value is a
protected entity. Terms (words of three letters or more, outside the patterns'
matches) are counted with it over the whole corpus, text by text: a term t
reveals an entity e by PMI(e; t) = log2(N n(e, t) / (n(e) n(t))), at most the
entity's information IC(e) = log2(N / n(e)), which t reaches if it occurs with e
only. A term is a disclosure if PMI >= ``SHARE`` x IC(e), it shares
``LEAST_TEXTS`` different texts with e at least (copies are one text), and IC(e)
is not 0. All mentions of such terms, in all texts, become spans: "term", to be
removed if nothing else is known of the word, "name" (to be generalised) if it
is capitalised.

SQL functions only. Counts are over all rows and added up before they are
shuffled; only texts of entities that several texts hold give pairs.

Cases: a null or empty text has no spans. Repeated rows each give a row; spans
follow the text alone, so rows with a null id have theirs too. An entity of one
text is protected but has no disclosing terms. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import spans
from .common import stored

LOCAL = "A-Za-z0-9._%+-"
# Each starts where its run of characters starts (or where the last match ended):
# later starts in a run cannot match if the first does not, so long runs cost one try.
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
KINDS = ("email", "ip", "card", "phone")
#: As mentions are marked wherever they stand, a term must say nearly all: 0.95 is n(e, t) / n(t) >= (n(e) / N) ** 0.05.
SHARE, LEAST_TEXTS = 0.95, 3
#: Rows of an entity that are counted in one group; an entity of more is split by text.
SPLIT_ROWS = 2000
TERM = r"\p{L}{3,}"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def base_spans(text: Column) -> Column:
    def digits(v: Column) -> Column:
        return F.regexp_replace(v, "[^0-9]", "")

    return F.array_sort(F.concat(
        spans.find(text, EMAIL, "email", 0, 0, text.contains("@")),
        spans.find(text, IP, "ip", 1, 0, text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), lambda v, m: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        spans.find(text, CARD, "card", 2, 0, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
                   lambda v, m: F.length(digits(v)).between(12, 19) & F.call_function("luhn_check", digits(v))),
        spans.find(text, PHONE, "phone", 3, 0, text.contains("+"), lambda v, m: F.length(digits(v)).between(9, 15))))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))


def _rows_and_texts(rows: DataFrame, *key: str) -> DataFrame:
    """Rows and different texts of each key; ``rows`` of a text are added up first."""
    return (rows.groupBy(*key, "sign").agg(F.sum("n").alias("n"))
            .groupBy(*key).agg(F.sum("n").alias("rows"), F.count("*").alias("texts")))


def disclosures(found: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term, share) of the terms that reveal an entity.

    ``found``: rows with spans, their ``sign``, ``text`` and ``base``.
    """
    total = docs.agg(F.count("*").cast("double").alias("total"))
    names = F.array_distinct(F.transform("base", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))))
    mentions = found.select("sign", F.explode(names).alias("entity"), F.lit(1).alias("n"))
    entities = stored(_rows_and_texts(mentions, "entity").where(F.col("texts") >= LEAST_TEXTS)
                      .select("entity", F.col("rows").alias("n_entity")), "pii-entities")
    # Only texts of such an entity are cut into terms, and they travel as one row a text and entity.
    # An entity of many rows is split by text, so all copies of a text stay together.
    around = found.select("sign", "text", "base", F.explode(names).alias("entity")).join(entities, "entity")
    around = around.select("entity", "sign", F.pmod(F.col("sign"), F.ceil(F.col("n_entity") / SPLIT_ROWS)).alias("part"),
                           (F.col("n_entity") <= SPLIT_ROWS).alias("alone"),
                           _terms(spans.replaced(F.col("text"), F.col("base"), lambda s: F.lit(" "))).alias("terms"))
    pairs = around.repartition("entity", "part").select("entity", "part", "alone", "sign", F.explode("terms").alias("term"), F.lit(1).alias("n"))
    parts = _rows_and_texts(pairs, "entity", "part", "alone", "term").where(F.col("texts") >= F.when(F.col("alone"), LEAST_TEXTS).otherwise(1))
    together = (parts.groupBy("entity", "term").agg(F.sum("rows").alias("n_both"), F.sum("texts").alias("texts"))
                .where(F.col("texts") >= LEAST_TEXTS).drop("texts"))
    terms = docs.select(F.explode(_terms(_text())).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))  # joined below as one row a term
    rows = together.join(entities, "entity").join(terms, "term").crossJoin(F.broadcast(total))
    information = F.log2(F.col("total") / F.col("n_entity"))
    pmi = F.log2(F.col("total") * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    return (rows.withColumn("share", F.when(information > 0, F.least(pmi / information, F.lit(1.0))))
            .where(F.col("share") >= SHARE).select("entity", "term", "share"))


def _mentions_of(known: DataFrame, docs: DataFrame) -> DataFrame:
    """(sign, more): the spans of disclosing terms in every text that holds one."""
    rows = docs.select(_text().alias("text"), F.xxhash64(_text()).alias("sign"))
    listed = stored(known.select("term").distinct(), "pii-listed")
    hits = stored(rows.select("sign", F.explode(_terms(F.col("text"))).alias("term")).join(listed, "term", "left_semi")
                  .groupBy("sign").agg(F.collect_set("term").alias("terms")), "pii-hits")
    found = spans.find(F.col("text"), TERM, "term", 4, keep=lambda v, m: F.array_contains("terms", F.lower(v)))
    named = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end"),
                                                  F.when(s["value"].rlike(r"^\p{Lu}"), "name").otherwise("term").alias("kind"), s["value"].alias("value")))
    return rows.join(hits, "sign").select("sign", named.cast(spans.SPAN).alias("more")).groupBy("sign").agg(F.first("more").alias("more"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sign (of the text), base (the patterns' spans) and spans (all, sorted) of every row."""
    rows = docs.select("doc_id", _text().alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("sign"), "text", base_spans(F.col("text")).alias("base"))
    base = stored(rows.select("doc_id", "sign", "base", F.when(F.size("base") > 0, F.col("text")).alias("text")), "pii-spans")
    known = stored(disclosures(base.where(F.size("base") > 0), docs), "pii-disclosures")
    extra = stored(_mentions_of(known, docs), "pii-terms")
    clear = F.filter("more", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return (base.drop("text").join(extra, "sign", "left")
            .withColumn("spans", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", clear)))).drop("more"))


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", *[spans.count(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"), spans.joined(F.col("spans")).alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities and names generalised to their kind in brackets, and other disclosing terms removed."""
    some = scan(docs).where(F.size("spans") > 0).groupBy(F.col("sign").alias("_sign")).agg(F.first("spans").alias("_spans"))
    text = _text()
    changed = spans.replaced(text, F.coalesce("_spans", spans.none()),
                             lambda s: F.when(s["kind"] == "term", F.lit("")).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]"))))
    out = docs.withColumn("_sign", F.xxhash64(text)).join(some, "_sign", "left")
    return out.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(changed)).select(*docs.columns)
