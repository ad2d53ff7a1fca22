"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Each source gets a share of the words of the mix by its weight, up to a multiple of what it has; what
is over goes to the others by weight, until none is above (each round is one aggregate of two numbers,
and is exact in the end).  Every document of a source is then expected in target / source_size
copies.  The documents of a source are laid in order of size, their expected copies are summed along it,
one random offset is added for the source, and a document is emitted once for each whole
number that its stretch of the sum crosses.  As neighbours in the order are alike in size, a source's words differ
from its target by about as much as its longest document has, however long the source is.

A source may hold most rows: documents are dealt by ranges of the order, ranges are counted, and a
document's place in its source is its place in its range and what the ranges before it hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import cut, in_order, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    """Runs of characters other than white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) of (source, source_size) rows, each source once.

    Sources in order of code points, null last, have the weights in turn.  A target is weight * rate,
    or `most` times the size where that is less; the rate is raised until the targets sum to
    `share` of all sizes.  Nothing is over where all sizes are 0, or share is not below most.
    """
    # null as an empty name behind a flag, so that the order has it last
    key = sizes.select(F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("key"), "source_size")
    turn = F.array(*(F.lit(float(w)) for w in weights))
    weighed = cut(common.numbered(key, "key", "at").select(F.when(~F.col("key.none"), F.col("key.name")).alias("source"), "source_size", F.get(turn, F.col("at") % len(weights)).alias("weight")))
    cap = F.col("source_size") * float(most)
    total, weight = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    rate, full = (share * total / weight if weight else 0.0), 0
    while True:
        above = F.col("weight") * F.lit(rate) >= cap
        n, caps, held = weighed.where(above).agg(F.count("*"), F.coalesce(F.sum(cap), F.lit(0.0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
        if n == full or held >= weight:  # each round has more sources at their limit than the one before
            break
        rate, full = (share * total - caps) / (weight - held), n
    return weighed.select("source", "source_size", F.least(F.col("weight") * F.lit(rate), cap).alias("target"))


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, text_hash) of each row: how often the mix takes it.

    size is the number of words; null and empty texts have none, and stay in the order.  copies is
    at most `most`.  Rows without source are a source of their own.  Repeated rows and rows without id are rows
    like others; they come first in the order of their size.  The result depends on rows and seed alone, not on how
    Spark deals them; rows that are equal in id and text are alike, and which of them is taken twice says
    nothing.  An empty table gives none.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    sized, _ = stored(rows.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")), "mixture-sizes")
    facts = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    ranged, pieces = in_order(sized, [F.col("source").asc_nulls_last(), *map(F.col, ("size", "doc_id", "text_hash"))], "mixture-order", ["source"])
    offset = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), "source"), 256), 1, 8), 16, 10).cast("double") / float(1 << 32)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    facts = facts.select("source", "source_size", "target", offset.alias("__offset"), copies.alias("__copies"))
    # a range of a source is one key, so no key has more rows than a task had before
    told = pieces.alias("p").join(facts.alias("f"), F.col("p.source").eqNullSafe(F.col("f.source"))).select("p.*", "source_size", "target", "__offset", "__copies")
    told = told.select(F.col("source").alias("__source"), F.col("__part").alias("__range"), "__shift", "source_size", "target", "__offset", "__copies")
    placed = ranged.join(told, (F.col("__part") == F.col("__range")) & F.col("source").eqNullSafe(F.col("__source")))
    place = F.col("__at") + F.col("__shift")
    crossed = lambda p: F.floor(F.col("__offset") + p * F.col("__copies"))
    # rounding of long sums could cross one boundary too many
    return placed.select("doc_id", "source", "size", "source_size", "target", F.least(crossed(place + 1) - crossed(place), F.lit(most)).cast("long").alias("copies"), "text_hash")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", copy_col: str = "copy", **options) -> DataFrame:
    """The rows of docs as often as the mix takes them, numbered from 1 in copy_col.

    Rows that are equal in id, source and text are one row here, which has the copies of all.
    Options are those of plan(); a column that is named as copy_col is an error.
    """
    if copy_col in docs.columns:
        raise ValueError(f"documents have a column {copy_col}")
    taken = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options).groupBy("doc_id", "source", "text_hash").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows")).where("__copies > 0")
    taken = cut(taken.toDF("__id", "__source", "__hash", "__copies", "__rows"))
    keyed = docs.withColumns({"__i": F.col(id_col).cast("long"), "__s": F.col(source_col).cast("string"), "__h": F.xxhash64(F.col(text_col).cast("string"))})
    if not taken.where("__rows > 1").isEmpty():
        keyed = keyed.dropDuplicates(["__i", "__s", "__h"])
    same = F.col("__i").eqNullSafe(F.col("__id")) & F.col("__s").eqNullSafe(F.col("__source")) & (F.col("__h") == F.col("__hash"))
    return keyed.join(taken, same).select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), "__copies")).alias(copy_col))


def words_taken(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of each row: taken is copies * size, the words that the mix has of it."""
    return plan(docs, **options).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(([5, 2, 1])[CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS BIGINT)] AS DOUBLE) AS weight FROM d GROUP BY source
), f AS (
  SELECT sum(2.0 * source_size) OVER r AS caps, sum(weight) OVER r AS held FROM s WINDOW r AS (ORDER BY source_size / weight, source IS NULL, source ROWS UNBOUNDED PRECEDING)
), a AS (SELECT CAST(1.5 * sum(source_size) AS DOUBLE) AS budget, sum(weight) AS weight FROM s
), g AS (
  -- the rate that fits is the largest that any set of sources at their limit leaves to the others
  SELECT max(x) AS rate FROM (SELECT budget / weight AS x FROM a UNION ALL SELECT (budget - CAST(caps AS DOUBLE)) / (weight - held) FROM f, a WHERE held < weight)
), t AS (
  SELECT source, source_size, least(weight * rate, CAST(2.0 * source_size AS DOUBLE)) AS target,
         CAST(('0x' || substr(sha256(CASE WHEN source IS NULL THEN '0' ELSE '0:' || source END), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS o FROM s, g
), p AS (
  SELECT d.doc_id, d.size, t.*, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS c, row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (SELECT *, CAST(least(floor(o + k * c) - floor(o + (k - 1) * c), 2) AS BIGINT) AS copies FROM p)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM q
"""
