"""A stored index of names and other texts: letters in threes point to blocks of rows in name order.

Built once, it answers scored searches and name-within-name matches from the postings of a request's
letters; the rows themselves are read only in the blocks where all of these occur.  Postings are sorted by their
letters, rows by their place in name order, both in small row groups, so that what isn't asked for is skipped by
least and largest values.  A search goes through the order in growing stretches and ends when it has as many hits as
the result is made from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import relational as R
from .serving import _if_known, grams

BLOCK = 256
GROUP_BYTES = 1 << 18
REQUEST_GRAMS = 10_000


def fold(c: Column) -> Column:
    """Texts that are equal in upper or in lower case are equal in this."""
    return F.lower(F.concat(F.upper(c), F.lit("")))  # lower(upper()) would be taken for lower()


def longest_grams(text: Column) -> Column:
    """The distinct stretches of three characters, or all of a shorter text."""
    return F.filter(grams(text), lambda g: F.length(g) == F.least(F.length(text), F.lit(3)))


class SearchIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def build(cls, items: DataFrame, fields: Sequence[str], path: str) -> "SearchIndex":
        """Of rows with name, ref_no and other columns; fields are those that are searched besides the name."""
        index = cls(items.sparkSession, path)
        ranked = R.ordered(items, [F.asc("name"), F.asc("ref_no")]).drop("_running").withColumn("_place", F.col("_rank") - 1).drop("_rank")
        write = lambda df, name, *by: df.repartitionByRange(*by).sortWithinPartitions(*by).write.option("parquet.block.size", GROUP_BYTES).parquet(f"{index.path}/{name}")
        write(ranked.withColumn("_block", F.floor(F.col("_place") / BLOCK)), "rows", "_place")
        rows = index.rows
        texts = F.array(*(fold(F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in ("name", *fields)))
        found = rows.select("_block", "_place", F.explode(F.array_distinct(F.flatten(F.transform(texts, grams)))).alias("gram"))
        # a block has BLOCK rows at most, so no list is longer
        write(found.groupBy("gram", "_block").agg(F.sort_array(F.collect_list("_place")).alias("places")), "postings", "gram", "_block")
        write(index.postings.groupBy("gram").agg(F.sum(F.size("places")).alias("n")), "counts", "gram")
        # the rarest letters of each name, by which it is found within longer texts
        own = rows.select("_place", "_block", fold(F.col("name")).alias("f")).where("f <> ''").select("_place", "_block", F.explode(longest_grams(F.col("f"))).alias("gram"))
        rare = own.join(index.counts, "gram").groupBy("_place", "_block").agg(F.min(F.struct("n", "gram")).alias("m"))
        write(rare.select("_place", "_block", F.col("m.gram").alias("gram")), "keys", "gram", "_place")
        return index

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    rows = property(lambda self: self._read("rows"))
    postings = property(lambda self: self._read("postings"))
    counts = property(lambda self: self._read("counts"))
    keys = property(lambda self: self._read("keys"))

    def _with_all(self, text: str, low: int, high: int) -> DataFrame:
        """(_block, _place) of rows that have all of a text's letters, in blocks of a stretch of the order."""
        q = self.spark.range(1).select(fold(F.lit(text))).first()[0]  # as Spark does it, not Python
        size = min(3, len(q))
        parts = sorted({q[i : i + size] for i in range(len(q) - size + 1)})
        some = self.postings.where(F.col("gram").isin(parts) & (F.col("_block") >= low) & (F.col("_block") < high))
        full = some.groupBy("_block").agg(F.count("*").alias("n")).where(F.col("n") == len(parts)).select("_block")
        each = some.join(full, "_block").select("_block", F.explode("places").alias("_place"))
        return each.groupBy("_block", "_place").agg(F.count("*").alias("n")).where(F.col("n") == len(parts)).select("_block", "_place")

    def search(self, text: str, fields: Sequence[str], keep: Column | None = None, limit: int = 20, function: str | None = None, family: str | None = None, restricted_only: bool = False) -> DataFrame:
        """The rows that serving.search() gives, with their score, from the index; an empty text scans."""
        q, low = text.strip().lower(), F.lower("name")
        items = self.rows
        if function is not None:
            items = _if_known(items, F.exists("functions", lambda x: F.upper(x) == function.upper()))
        if family is not None:
            items = _if_known(items, F.lower("family") == family.lower())
        if restricted_only:
            items = items.where(F.nullif("restriction", F.lit("")).isNotNull())
        other = F.lit(False)
        for f in fields:
            other |= F.contains(F.lower(F.coalesce(F.col(f).cast("string"), F.lit(""))), F.lit(q))
        score = F.when(low == q, 3).when(F.contains(low, F.lit(q)), 2).when(other, 1).otherwise(0)
        items = items.where(keep if keep is not None else F.lit(True)).withColumn("score", score.cast("bigint")).where("score > 0")
        total = (self.rows.agg(F.max("_block")).first()[0] or 0) + 1
        begin, step, found = 0, 64, None
        while begin < total:
            end = min(total, begin + step)
            at = self._with_all(q, begin, end) if q else None
            hits = items.where((F.col("_block") >= begin) & (F.col("_block") < end))
            hits = hits.join(at, ["_block", "_place"], "left_semi") if q else hits
            found = hits if found is None else found.unionByName(hits)
            # 5 * limit hits in name order are what the result is made from
            if end < total and found.limit(5 * limit).count() >= 5 * limit:
                break
            begin, step = end, step * 4
        found = found if found is not None else items
        return found.orderBy("_place").limit(5 * limit).orderBy(F.desc("score"), "name", "ref_no").limit(limit).drop("_block", "_place")

    def _asked(self, df: DataFrame, grams_: DataFrame) -> DataFrame:
        """Rows of an index table with one of the letters of a request; few letters are named in the scan."""
        wanted = grams_.select("gram").distinct()
        few = [r["gram"] for r in wanted.limit(REQUEST_GRAMS + 1).collect()]  # this many at most
        return df.where(F.col("gram").isin(few)) if len(few) <= REQUEST_GRAMS else df.join(wanted, "gram", "left_semi")

    def within(self, parts: DataFrame) -> DataFrame:
        """(part, name, ref_no) where one is within the other in upper case, of distinct upper-case strings `part`."""
        p = parts.select("part", fold(F.col("part")).alias("f")).where("f <> ''")
        full = lambda at: self.rows.join(at, ["_block", "_place"]).select("part", "name", "ref_no")
        # the part within a name: by the part's rarest letters
        own = p.select("part", F.explode(longest_grams(F.col("f"))).alias("gram"))
        counts = self._asked(self.counts, own)
        rare = own.join(counts, "gram").groupBy("part").agg(F.min(F.struct("n", "gram")).alias("m")).select("part", F.col("m.gram").alias("gram"))
        places = self._asked(self.postings, rare).join(rare, "gram").select("part", "_block", F.explode("places").alias("_place"))
        inside = full(places).where(F.contains(F.upper("name"), F.col("part")))
        # a name within the part: by the name's rarest letters, which the part has as well
        have = p.select("part", F.explode(grams(F.col("f"))).alias("gram"))
        around = full(self._asked(self.keys, have).join(have, "gram").select("part", "_block", "_place")).where(F.contains("part", F.upper("name")) & (F.col("name") != ""))
        return inside.union(around).distinct()

    def match_list(self, labels: DataFrame, label: str = "label", position: str = "position") -> DataFrame:
        """The rows that serving.match_list() gives: exact, without white space, one within the other; the last from the index."""
        q = labels.where(F.trim(label) != "").select(position, label).withColumn("_u", F.upper(F.trim(label)))
        squeeze = lambda c: F.regexp_replace(F.upper(c), r"\s+", "")
        names = self.rows.select("ref_no", "name")
        exact = q.join(names.groupBy(F.upper("name").alias("_u")).agg(F.max("ref_no").alias("ref_no")), "_u").select(position, "ref_no", F.lit(1).alias("tier"))
        rest = q.join(exact, position, "left_anti")
        loose = rest.withColumn("_s", squeeze("_u")).join(names.groupBy(squeeze(F.col("name")).alias("_s")).agg(F.min("ref_no").alias("ref_no")), "_s").select(position, "ref_no", F.lit(2).alias("tier"))
        rest = rest.join(loose, position, "left_anti")
        met = self.within(rest.select(F.col("_u").alias("part")).distinct())
        part = rest.join(met, F.col("_u") == F.col("part")).groupBy(position).agg(F.min(F.struct("name", "ref_no")).alias("m")).select(position, F.col("m.ref_no").alias("ref_no"), F.lit(3).alias("tier"))
        hits = exact.union(loose).union(part)
        return q.join(hits, position, "left").join(names, "ref_no", "left").select(position, label, "ref_no", "name", F.col("tier").cast("bigint").alias("tier"))
