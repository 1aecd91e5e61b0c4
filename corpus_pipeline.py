"""From raw documents to tokens: each stage calls one of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns the columns of ``documents``; the last one returns tokens.
``run`` writes each stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stagecraft.llm import op1_bpe, op3_secrets, op8_jaccard_join, op9_quality, op10_decontaminate
from stagecraft.llm.common import read_table, stored
from stagecraft.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's limit (operator 9)."""
    return op9_quality.keep(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (operator 8)."""
    return op8_jaccard_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item (operator 10)."""
    return op10_decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind (operator 3); ``n_chars`` follows the new text."""
    redacted = op3_secrets.redact(docs, read_table(spark, sf_dir, "labels"))
    return redacted.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document (operator 1): their number, and digests of ids and of what they decode to."""
    coded = op1_bpe.bpe_encode_decode(docs, TOKENIZER)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("secrets", secrets), ("tokens", tokens)]

#: SQL expresses neither the models nor the merges; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
