"""A session with the settings that the operators are written for."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, shuffle_partitions: int = 200, name: str = "florispark") -> SparkSession:
    """AQE, ANSI mode and UTC; shuffle_partitions is where AQE begins, so set it for the largest input."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }.items():
        b = b.config(key, value)
    return b.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, in spark.checkpoint.dir; where that is unset, of this machine, on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "florispark-checkpoints")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Rows from reliable storage, without their lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "cut"))
    return df.checkpoint(eager=True)


FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table_cut(df: DataFrame, free: bool = False) -> DataFrame:
    """Rows from a table in the shared folder.

    Its sizes are those of its files.  A checkpoint keeps those that were estimated for what made it, and what is known of its
    columns; over rounds of joins both grow without bound, and with them the driver's plans.
    With `free` the files of the shuffles that made it go once it is there, where they would stay until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path, before = shared_folder(spark, "table"), spark.conf.get(FREE, None)
    try:
        if free:
            spark.conf.set(FREE, "true")
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.unset(FREE) if before is None else spark.conf.set(FREE, before)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows: int, *keys: str, most: int = 500_000) -> DataFrame:
    """df dealt by keys, so that a task gets about `most` of its rows at most, however small they are when packed.

    Adaptive execution puts partitions together by packed bytes; narrow rows are many then, and their sorts and hash tables large.
    Up to four times `most` rows df is left as it is: one task holds them.
    """
    if rows <= 4 * most:
        return df
    return df.repartition(max(-(-rows // most), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))), *keys)
