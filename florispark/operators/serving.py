"""The lookup surface: keyed lookup, scored search, list matching, paging.  Requests are rows too, so many run as one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(requests: DataFrame, items: DataFrame, query: str = "query") -> DataFrame:
    """Each request's item (query, ref_no, name): by reference number, then registry number (first ref), then name in upper case (last ref)."""
    q = requests.select(query).distinct().withColumn("_q", F.trim(query))
    ref = q.join(items, F.col("_q") == F.col("ref_no").cast("string")).select(query, "ref_no", "name", F.lit(0).alias("_t"), F.col("ref_no").alias("_o"))
    cas = q.join(items, F.col("_q") == F.col("cas")).select(query, "ref_no", "name", F.lit(1).alias("_t"), F.col("ref_no").alias("_o"))
    inci = q.join(items, F.upper("_q") == F.upper("name")).select(query, "ref_no", "name", F.lit(2).alias("_t"), (-F.col("ref_no")).alias("_o"))
    best = Window.partitionBy(query).orderBy("_t", "_o")
    hits = ref.union(cas).union(inci).withColumn("_r", F.row_number().over(best)).where("_r = 1")
    return requests.select(query).distinct().join(hits, query, "left").select(query, "ref_no", "name")


def search(items: DataFrame, text: str, fields: Sequence[str], keep: Column | None = None, limit: int = 20, function: str | None = None, family: str | None = None, restricted_only: bool = False) -> DataFrame:
    """Hits by score (3 the name, 2 in the name, 1 in another field), then name and ref_no.

    A function or family that no item has is no filter, in any case of letters.  The scan ends after
    5 * limit hits in name order, which belongs to the result; a top-k in name order says the same
    without a global sort of all items.
    """
    q = text.strip().lower()
    low = F.lower("name")
    other = F.lit(False)
    for f in fields:
        other |= F.contains(F.lower(F.coalesce(F.col(f).cast("string"), F.lit(""))), F.lit(q))
    score = F.when(low == q, 3).when(F.contains(low, F.lit(q)), 2).when(other, 1).otherwise(0)
    if function is not None:
        has = F.exists("functions", lambda x: F.upper(x) == function.upper())
        items = _if_known(items, has)
    if family is not None:
        items = _if_known(items, F.lower("family") == family.lower())
    if restricted_only:
        items = items.where(F.nullif("restriction", F.lit("")).isNotNull())
    hits = items.where(keep if keep is not None else F.lit(True)).withColumn("score", score.cast("bigint")).where("score > 0")
    return hits.orderBy("name", "ref_no").limit(5 * limit).orderBy(F.desc("score"), "name", "ref_no").limit(limit)


def _if_known(items: DataFrame, condition: Column) -> DataFrame:
    some = items.where(condition)
    return items if some.isEmpty() else some


def grams(text: Column) -> Column:
    """The distinct stretches of one to three characters of a text."""
    of = lambda n: F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(of(1), of(2), of(3)))


def within(parts: DataFrame, wholes: DataFrame) -> DataFrame:
    """(part, whole) where a string is within another: they meet by the part's rarest three letters (all of it, if shorter), and are verified.

    Both frames have one column of distinct strings, `part` and `whole`.
    """
    inside = wholes.select("whole", F.explode(grams(F.col("whole"))).alias("gram"))
    longest = lambda: F.filter(grams(F.col("part")), lambda g: F.length(g) == F.least(F.length("part"), F.lit(3)))
    own = parts.select("part", F.explode(longest()).alias("gram"))
    often = inside.groupBy("gram").agg(F.count("*").alias("n"))
    rare = own.join(often, "gram", "left").groupBy("part").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("m")).select("part", F.col("m.gram").alias("gram"))
    return rare.join(inside, "gram").where(F.contains("whole", F.col("part"))).select("part", "whole").distinct()


def match_list(labels: DataFrame, items: DataFrame, label: str = "label", position: str = "position") -> DataFrame:
    """(position, label, ref_no, name, tier): exact in upper case (last ref), without white space (first), one within the other (first in name order).

    Only labels without an earlier hit reach the last tier, where labels and names meet by rare letters.
    """
    q = labels.where(F.trim(label) != "").select(position, label).withColumn("_u", F.upper(F.trim(label)))
    squeeze = lambda c: F.regexp_replace(F.upper(c), r"\s+", "")
    names = items.select("ref_no", "name")
    exact = q.join(names.groupBy(F.upper("name").alias("_u")).agg(F.max("ref_no").alias("ref_no")), "_u").select(position, "ref_no", F.lit(1).alias("tier"))
    rest = q.join(exact, position, "left_anti")
    loose = rest.withColumn("_s", squeeze("_u")).join(names.groupBy(squeeze(F.col("name")).alias("_s")).agg(F.min("ref_no").alias("ref_no")), "_s").select(position, "ref_no", F.lit(2).alias("tier"))
    rest = rest.join(loose, position, "left_anti")
    low, high = rest.select("_u").distinct(), names.select(F.upper("name").alias("_n")).where("_n <> ''").distinct()
    meet = within(low.toDF("part"), high.toDF("whole")).toDF("_u", "_n").union(within(high.toDF("part"), low.toDF("whole")).select("whole", "part"))
    part = rest.join(meet, "_u").join(names.withColumn("_n", F.upper("name")), "_n")
    part = part.groupBy(position).agg(F.min(F.struct("name", "ref_no")).alias("m")).select(position, F.col("m.ref_no").alias("ref_no"), F.lit(3).alias("tier"))
    hits = exact.union(loose).union(part)
    return q.join(hits, position, "left").join(names, "ref_no", "left").select(position, label, "ref_no", "name", F.col("tier").cast("bigint").alias("tier"))


def page(df: DataFrame, order: Sequence[Column | str], number: int, size: int = 24) -> DataFrame:
    return df.orderBy(*order).offset(number * size).limit(size)


def browse(compounds: DataFrame, ranges: dict[str, tuple[float, float]], order: Sequence[Column | str], text: str = "", size: int = 24) -> DataFrame:
    """Compounds within ranges (missing values fail), with a text in name or formula, sorted and paged."""
    df = compounds
    for c, (lo, hi) in ranges.items():
        df = df.where(F.col(c).between(lo, hi))
    if text:
        df = df.where(F.contains(F.lower("name"), F.lit(text.lower())) | F.contains(F.lower("formula"), F.lit(text.lower())))
    return df.orderBy(*order).limit(size)


def quota(first: DataFrame, second: DataFrame, total: int, reserved: int, order: Sequence[Column | str]) -> DataFrame:
    """Up to `reserved` rows of second, and of first what is left of `total`; rows have a 'kind'."""
    b = second.orderBy(*order).limit(reserved)
    a = first.orderBy(*order).limit(total).withColumn("_r", F.row_number().over(Window.orderBy(*order)))  # over `total` rows at most
    n = b.agg(F.count("*").alias("_n"))
    return a.crossJoin(F.broadcast(n)).where(F.col("_r") <= total - F.col("_n")).drop("_r", "_n").unionByName(b)


def localized(language: str, fallback: Sequence[str]) -> Column:
    """A name in a language, else in the fallbacks that it allows."""
    return F.coalesce(*(F.nullif(F.col(f"name_{x}"), F.lit("")) for x in (language, *fallback)))


def report_class(restriction: Column, species: Column) -> Column:
    return F.when(F.startswith(restriction, F.lit("II/")), "prohibited").when(restriction.isNotNull(), "restricted").when(species.isNotNull(), "botanical").otherwise("other")


def answer(hits: DataFrame, requests: DataFrame, key: str, message: str = "not found") -> DataFrame:
    """(key, json): each request's hits as one document, in order, or an error for a request without any."""
    fields = [c for c in hits.columns if c != key]
    found = hits.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*fields)))).alias("_json"))
    error = F.to_json(F.struct(F.concat(F.lit(f"{message}: "), F.col(key).cast("string")).alias("error")))
    return requests.select(key).distinct().join(found, key, "left").select(key, F.coalesce("_json", error).alias("json"))
