import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from florispark.session import shared_folder
from florispark.sources import readers, sinks
from florispark.sources.versions import Conflict, VersionedTable


def made(spark, n=1000):
    t = VersionedTable(spark, shared_folder(spark, "t"))
    t.replace(spark.range(n).selectExpr("id as k", "concat('v', id) as v"), ["k"])
    return t


def test_only_hit_files_are_rewritten_and_old_readers_go_on(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = made(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files, old = set(t.files()), t.read()
    assert len(files) >= 4
    keys = spark.createDataFrame([(3, "x"), (5, "y"), (None, "z"), (10**6, "w")], "k long, n string")
    got = t.update(keys, "k", {"v": F.concat("v", "_new_n")})
    assert got["rewritten"] == 1 and got["kept"] == len(files) - 1 and len(files & set(t.files())) == len(files) - 1
    assert {r.k: r.v for r in t.read().where("k < 7").collect()} == {0: "v0", 1: "v1", 2: "v2", 3: "v3x", 4: "v4", 5: "v5y", 6: "v6"}
    assert t.read().count() == 1000 and old.where("v = 'v3'").count() == 1 and t.read(0).where("v = 'v3'").count() == 1
    assert t.update(keys.where("k > 1000"), "k", {"v": F.lit("no")}) == {"version": 1, "rewritten": 0, "kept": len(files)}
    assert t.delete(spark.createDataFrame([(3,), (3,), (999,)], "k long"), "k")["rewritten"] == 2 and t.read().count() == 998
    assert t.upsert(spark.createDataFrame([(4, "four"), (3, "three")], "k long, v string"), "k")["version"] == 3
    assert {r.k: r.v for r in t.read().where("k in (3, 4)").collect()} == {3: "three", 4: "four"} and t.read().count() == 999
    assert t.vacuum(keep=1) == 3 and sorted(t.versions()) == [3] and t.read().count() == 999


def test_a_failed_change_leaves_the_table_as_it_was(spark):
    t = made(spark, 50)
    with pytest.raises(Exception, match="broke off"):
        t.update(spark.createDataFrame([(3,)], "k long"), "k", {"v": F.raise_error(F.lit("broke off"))})
    assert t.version() == 0 and t.read().count() == 50
    with pytest.raises(Conflict):
        t._commit(-1, [], t.read().schema)  # as two writers do that began at the same version
    empty = VersionedTable(spark, shared_folder(spark, "t"))
    with pytest.raises(FileNotFoundError):
        empty.read()
    empty.replace(t.read().where("false"))
    assert empty.read().count() == 0 and empty.upsert(t.read(), "k")["version"] == 1 and empty.read().count() == 50


def test_a_fetch_that_breaks_off_gives_the_old_rows(spark):
    path = shared_folder(spark, "snapshot")
    readers.snapshot(spark, path, lambda: spark.createDataFrame([(1,)], "n int"))
    got = readers.snapshot(spark, path, lambda: spark.range(100).select(F.when(F.col("id") < 99, F.col("id").cast("int")).otherwise(F.raise_error(F.lit("broke off"))).alias("n")), days=-1)
    assert [r.n for r in got.collect()] == [1]
    with pytest.raises(Exception, match="broke off"):
        readers.snapshot(spark, path + "-new", lambda: spark.range(1).select(F.raise_error(F.lit("broke off")).cast("int").alias("n")))


def test_an_index_is_used(spark):
    rows = spark.range(200_000).selectExpr("id * 7 as k", "cast(id as string) as v")
    path = shared_folder(spark, "index")
    t = sinks.write_indexed(rows, path, "k", 16, group_bytes=1 << 16)
    hit = t.where("k = 77777")
    assert [r.v for r in hit.collect()] == ["11111"] and t.where("k = 77778").count() == 0
    scan = hit._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 0 < scan.metrics().apply("numOutputRows").value() < 200_000 / 16  # of one bucket, and not all of that
    # row groups that may hold the key, in the bucket that is read, of all
    held = {}
    for f in pq.ParquetDataset(re.sub("^file:(//)?", "", path)).files:
        meta = pq.ParquetFile(f).metadata
        groups = [meta.row_group(g).column(0) for g in range(meta.num_row_groups)]
        held[f] = (len(groups), sum(g.statistics.min <= 77777 <= g.statistics.max for g in groups))
        assert all(g.has_bloom_filter if hasattr(g, "has_bloom_filter") else True for g in groups)
    total = sum(n for n, _ in held.values())
    bucket = spark.sql("select pmod(hash(cast(77777 as bigint)), 16) as b").first().b
    read = sum(may for f, (_, may) in held.items() if int(f.split("_")[-1].split(".")[0]) == bucket)
    assert 1 <= read < total / 10
    other = sinks.write_indexed(spark.range(1000).selectExpr("id * 70 as k", "id as w"), shared_folder(spark, "index"), "k", 16)
    plan = t.hint("merge").join(other, "k")
    assert plan.count() == 1000 and "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
