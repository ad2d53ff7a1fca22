"""Incremental loads with keyed state: new files are read once, and what is known of a key is in the state store, not in the target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from florispark.sources.versions import VersionedTable


def _source(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def _kept(rows: DataFrame, key: str, order: str | None, human: str | None, first: bool) -> DataFrame:
    """Of each key, the row of a batch that changes what is known of it, if there is one.

    first: the first row of a key stays.  Else a later one takes its place, unless a person has
    decided and it is the machine's.  Rows of a batch go by order, then by all their columns.  The state is a grouped
    least or greatest row, kept by Spark's own aggregation; current_timestamp() is one value for a batch, the same when it is tried again.
    """
    names, batch = rows.columns, F.current_timestamp()
    at = F.col(order).cast("long") if order else F.lit(0).cast("long")
    ties = [x for c in names for x in (F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit("")))]
    # an earlier batch's row is before those of a later one
    rank = F.struct(batch, at, *ties) if first else F.struct(F.coalesce(F.col(human), F.lit(False)), at, batch, *ties)
    told = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.struct(*names).alias("_row"), batch.alias("_batch"), rank.alias("_rank"))
    best = (F.min_by if first else F.max_by)(F.struct("_row", "_batch"), "_rank")
    out = told.groupBy("_key").agg(best.alias("r")).where(F.col("r._batch") == F.current_timestamp())
    return out.select("r._row.*")


def _run(rows: DataFrame, checkpoint: str, put) -> StreamingQuery:
    return rows.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_new(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, key: str, order: str | None = None) -> StreamingQuery:
    """Rows of new Parquet files whose key hasn't come before, appended to a versioned table; ends when what is there has been read.

    Of a batch's rows of one key the first by order stays.  The target isn't read.  A batch
    that is tried again after its version was made adds nothing.  Rows without key are left out.
    """
    table = VersionedTable(spark, target)

    def put(batch: DataFrame, epoch: int) -> None:
        table.append(batch, batch=(checkpoint, epoch))

    return _run(_kept(_source(spark, folder, schema), key, order, None, True), checkpoint, put)


def load_decisions(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, key: str, order: str, human: str) -> StreamingQuery:
    """Rows of new Parquet files put in place of those with their key; a row of the machine never replaces a person's (human is true).

    Only files with a changed key are rewritten; a batch that is tried again leaves the same rows.
    """
    table = VersionedTable(spark, target)

    def put(batch: DataFrame, epoch: int) -> None:
        held = batch.persist()
        try:
            if table.version() is None:
                table.replace(held, [key])
            elif not held.isEmpty():
                table.upsert(held, key)
        finally:
            held.unpersist()

    return _run(_kept(_source(spark, folder, schema), key, order, human, False), checkpoint, put)
