"""Small tables for the operators' tests: every odd case in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def docs_of(spark: SparkSession, texts: list, lang: str = "en", first: int = 0) -> DataFrame:
    return spark.createDataFrame([(first + i, t, lang, "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def labels_of(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, LABELS)


def by_id(df: DataFrame, *columns: str) -> dict:
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def odd_docs(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and long texts, repeated rows, extra columns with clashing names."""
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a " * 40_000, None, "s", 80_000),
            (3, "same text here", "en", None, 14), (3, "same text here", "en", None, 14), (4, None, "en", "s", None),
            (5, "\U0001f600 é ñ\n\n\t x", "es", "s", 9), (6, "x" * 50_000, "en", "s", 50_000)]
    extra = [(*r, 7, "u", "k", 1.0, "z") for r in rows]
    return spark.createDataFrame(extra, DOCS + ", block long, unit string, spans string, base double, sign string")


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)
