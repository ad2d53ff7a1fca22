"""Writers: deterministic JSON, chunked documents, CSV, reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florispark.functions.text import chunk_key


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, order: Sequence[str], files: int = 1) -> None:
    """A CSV with header in one order; one file is meant for people's tables, raise files for more."""
    (df.orderBy(*order).coalesce(1) if files == 1 else df.repartitionByRange(files, *order).sortWithinPartitions(*order)).write.mode("overwrite").csv(path, header=True)


def json_documents(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, json): compact documents without null fields."""
    return df.select(F.col(key), F.to_json(F.struct(*columns), {"ignoreNullFields": "true"}).alias("json"))


def write_chunks(df: DataFrame, key: str, columns: Sequence[str], path: str, letters: int = 2) -> None:
    """JSON documents in one folder for each key prefix, keys in order within it."""
    docs = json_documents(df, key, columns).withColumn("chunk", chunk_key(F.col(key), letters))
    docs.repartition("chunk").sortWithinPartitions("chunk", key).write.mode("overwrite").partitionBy("chunk").json(path)


def write_json_cache(df: DataFrame, key: str, columns: Sequence[str], path: str, letters: int = 2) -> None:
    """A dictionary cache as readers.json_cache() reads it: in a folder for each key prefix, an object of one key a line."""
    name = F.col(key).cast("string")
    line = F.to_json(F.create_map(name, F.struct(*columns)), {"ignoreNullFields": "false"})
    df.where(name.isNotNull()).select(chunk_key(name, letters).alias("_chunk"), name.alias("_key"), line.alias("value")).repartitionByRange("_chunk", "_key").sortWithinPartitions("_chunk", "_key").drop("_key").write.mode("overwrite").partitionBy("_chunk").text(path)


def write_indexed(df: DataFrame, path: str, key: str, buckets: int, group_bytes: int = 8 << 20) -> DataFrame:
    """A table that finds a key fast: hashed into buckets, sorted within, small row groups with least and largest keys and Bloom filters.

    A filter on the key reads one bucket, and in it the row groups that may have the key; a join or grouping by the
    key of tables with as many buckets has no exchange.  The table is in the session's catalog, its files at path.
    """
    name = "indexed_" + uuid.uuid4().hex
    out = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).option("parquet.block.size", group_bytes)
    out.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.page.row.count.limit", 1000).saveAsTable(name)
    return df.sparkSession.table(name)


def finding(title: str, df: DataFrame, limit: int = 50, note: str = "") -> str:
    """A titled Markdown table of at most `limit` rows of a sorted result."""
    rows, names = df.limit(limit).collect(), df.columns
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|")
    lines = [f"## {title}", "", "| " + " | ".join(names) + " |", "|" + " --- |" * len(names), *("| " + " | ".join(map(cell, r)) + " |" for r in rows)]
    return "\n".join([*lines, *(["", note] if note else [])]) + "\n"
