"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, conversations, decontamination, importance, line_dedup, mixture, ngram_join, quality_classifier, quality_rules, substring_dedup, suffix_dedup, token_counts, warc
from .common import read

VOCAB = "word_bpe_49k.json"


def vocab_path(name: str = VOCAB) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), vocab_path())


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.train(docs, read(spark, sf_dir, "labels")))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_components(read(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_duplicates(read(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"), length=400, keep_first=False, digests=True, report_length=240)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(read(spark, sf_dir, "documents"), vocab_path())


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, read(spark, sf_dir, "pages"))


def op11_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.words_taken(read(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_and_audit(read(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in sorted(globals().items()) if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op3_ngram_join": ngram_join.ORACLE, "op5_line_dedup": line_dedup.ORACLE, "op4_quality_rules": quality_rules.ORACLE, "op6_suffix_dedup": suffix_dedup.ORACLE, "op8_decontamination": decontamination.ORACLE, "op10_warc": warc.ORACLE, "op11_mixture": mixture.ORACLE, "op12_importance": importance.ORACLE, "op13_conversations": conversations.ORACLE}
