"""A corpus pipeline of five stages, each a step of florispark.llm over all that the one before kept.

Stages but the last return the columns of documents.  run() writes what each stage returns as
Parquet into the folder that driver and executors share, and reads it again as the next one's
input, which also cuts the lineage.
"""

from __future__ import annotations

import contextlib
import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florispark.llm import bpe, common, decontamination, line_dedup, ngram_join, quality_classifier
from florispark.llm.common import cut, read, work_dir
from florispark.llm.queries import vocab_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds of low quality or toxic go; it is fitted on the labelled ones of these.

    Null and empty texts are of low quality.  Rows without id and repeated rows are judged like all.
    Without enough labels, and of an empty table, nothing else goes.
    """
    return quality_classifier.keep_good(docs, quality_classifier.train(docs, read(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are in an earlier document, or one word away from one, go, and documents left without a word; n_chars follows.

    Rows without id come first in order; rows alike in id and text are one document, and all of
    them stay or go.  Null and empty texts stay as they are.
    """
    out = line_dedup.remove_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


ROW = "__near_copies_row"


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, Jaccard similarity of 0.8), one document stays: that with the smallest id.

    Rows are numbered in order of id and text, those without id after all others, so that these are
    compared as well; rows alike in id and text have one number and are one document.  Texts
    without a word stay.
    """
    th = F.xxhash64("text")
    by_id = docs.groupBy("doc_id").agg(F.min(th).alias("low"), F.max(th).alias("high"))
    if by_id.where("doc_id is null or low <> high").isEmpty():  # ids tell all rows apart
        first = ngram_join.ngram_jaccard_components(docs, k=5, percent=80).where("component_id = doc_id").select("doc_id").distinct()
        return docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(docs.columns)
    named = docs.withColumn(ROW, F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), th.alias("th")))
    numbers = cut(common.numbered(named.select(ROW).distinct(), ROW, "__near_copies_number"))
    told = named.join(numbers, ROW).withColumnRenamed("__near_copies_number", "__n")
    first = ngram_join.ngram_jaccard_components(told, k=5, percent=80, id_col="__n").where("component_id = doc_id").select(F.col("doc_id").alias("__n")).distinct()
    return told.join(first, "__n", "left_semi").dropDuplicates(["__n"]).select(docs.columns)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go, each row by its own text, with or without id; repeated rows and texts without words stay."""
    return decontamination.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each document, and digests of its ids and of their decoding.

    A row for each row, repeated ones and those without id too; null and empty texts have no tokens.
    """
    return bpe.encoding_digests(docs, vocab_path())


#: Whole texts go to Python in batches of so many rows and bytes, of which a worker and the executor hold copies.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def in_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with batches of BATCH at most.  What it returns runs later, so the session keeps the setting, which run() sets back."""

    @functools.wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, most in BATCH.items():
            now = _bytes(spark.conf.get(key))
            if now <= 0 or now > most:
                spark.conf.set(key, str(most))
        return stage(spark, docs, sf_dir)

    return bounded


def _bytes(value: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", value.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit[:1]]


STAGES = [
    (name, in_batches(stage))
    for name, stage in (
        ("quality classifier", quality),
        ("line dedup", lines),
        ("n-gram Jaccard join", near_copies),
        ("benchmark decontamination", clean_of_benchmarks),
        ("BPE encoding and decoding", tokens),
    )
]

#: A fitted model and a tokenizer can't be said in SQL; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = work_dir(spark, "pipeline")
    with contextlib.ExitStack() as after:
        for key in BATCH:
            after.enter_context(common.setting(spark, key, spark.conf.get(key)))
        for i, (_, stage) in enumerate(STAGES):
            with common.setting(spark, common.FREE, "true"):
                stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
            if i:
                common.drop(spark, f"{folder}/{i - 1}")  # what it was made into is stored
    return docs
