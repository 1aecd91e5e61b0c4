"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import op1_bpe, op10_decontaminate, op11_repair, op12_simhash, op13_whitening, op2_toxicity, op3_secrets, op4_suffix_dedup, op5_quality_rules, op6_token_counts, op7_pii, op8_jaccard_join, op9_quality
from .common import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = op1_bpe.bpe_encode_decode(read_table(spark, sf_dir, "documents"), TOKENIZER)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op5_quality_rules.apply_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken")


def op6_token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_token_counts.token_report(read_table(spark, sf_dir, "documents"), TOKENIZER, TOKEN_LIMIT)


def op3_secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_secrets.report(op3_secrets.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")))


def op4_suffix_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = op4_suffix_dedup.dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_pii.report(op7_pii.scan(read_table(spark, sf_dir, "documents")))


def op8_jaccard_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_jaccard_join.join(read_table(spark, sf_dir, "documents"))


def op9_quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_repair.repair(op11_repair.damage(read_table(spark, sf_dir, "conversations")))


def op12_simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_simhash.report(op12_simhash.near_duplicates(read_table(spark, sf_dir, "documents")))


def op13_whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_whitening.report(op13_whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=4))


QUERIES = {
    "op1_bpe_codec": op1_bpe_codec,
    "op2_toxicity": op2_toxicity_query,
    "op3_secrets": op3_secrets_query,
    "op4_suffix_dedup": op4_suffix_dedup_query,
    "op5_quality_rules": op5_quality_rules_query,
    "op6_token_counts": op6_token_counts_query,
    "op7_pii": op7_pii_query,
    "op8_jaccard_join": op8_jaccard_join_query,
    "op9_quality": op9_quality_query,
    "op10_decontaminate": op10_decontaminate_query,
    "op11_repair": op11_repair_query,
    "op12_simhash": op12_simhash_query,
    "op13_whitening": op13_whitening_query,
}

#: DuckDB SQL for the queries that SQL can express; the others have brute-force tests.
ORACLES: dict[str, str] = {"op8_jaccard_join": op8_jaccard_join.ORACLE}
