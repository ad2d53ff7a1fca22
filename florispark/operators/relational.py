"""Join, window and set shapes that need more than one call."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florispark.session import cut


def not_in(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """NOT IN (subquery), null-aware: with a null on the right nothing is left; a null on the left never is, unless the right is empty."""
    r = right.select(F.col(right_col).alias("_r"))
    facts = r.agg(F.count("*").alias("_n"), F.count_if(F.col("_r").isNull()).alias("_nulls"))
    keep = left.join(r.where("_r is not null").distinct(), F.col(left_col) == F.col("_r"), "left_anti")
    return keep.crossJoin(F.broadcast(facts)).where((F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(left_col).isNotNull())).drop("_n", "_nulls")


def prefix_exists(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """Rows of left for which some right value begins with 'left ': an equi-join on the first word, then the test."""
    a = left.withColumn("_k", F.substring_index(left_col, " ", 1))
    b = right.select(F.col(right_col).alias("_v"), F.substring_index(right_col, " ", 1).alias("_k2")).distinct()
    return a.join(b, (F.col("_k") == F.col("_k2")) & F.startswith(F.col("_v"), F.concat(F.col(left_col), F.lit(" "))), "left_semi").drop("_k")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank_in_group", F.row_number().over(w)).where(F.col("rank_in_group") <= k)


def max_rows(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """All rows that have their group's largest value: ties stay."""
    return df.join(df.groupBy(*keys).agg(F.max(value).alias("_m")), list(keys)).where(F.col(value) == F.col("_m")).drop("_m")


def ordered(df: DataFrame, order: Sequence[Column], value: str | None = None) -> DataFrame:
    """df with _rank, from 1 in an order, and _running, the running sum of a value (or of ones), without a task that gets all rows.

    Rows are dealt by ranges of the order; each range counts its own, and gets what the ranges before
    it hold, of which the driver sees one number for each range.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    own = F.col(value) if value else F.lit(1)
    dealt = cut(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()).withColumn("_own", own.cast("long")))
    before, ranks, sums = [], 0, 0
    for r in sorted(dealt.groupBy("_part").agg(F.count("*").alias("n"), F.sum("_own").alias("s")).collect()):
        before.append((r["_part"], ranks, sums))
        ranks, sums = ranks + r["n"], sums + r["s"]
    starts = F.broadcast(df.sparkSession.createDataFrame(before, "_part int, _r0 long, _s0 long"))  # a row for each range
    w = Window.partitionBy("_part").orderBy(*order)
    ranked = dealt.withColumn("_r", F.row_number().over(w)).withColumn("_s", F.sum("_own").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return ranked.join(starts, "_part").select(*df.columns, (F.col("_r") + F.col("_r0")).alias("_rank"), (F.col("_s") + F.col("_s0")).alias("_running"))


def dense_index(df: DataFrame, name: str) -> DataFrame:
    """(name, n, index): a dimension numbered by frequency, then name."""
    return ordered(df.groupBy(name).agg(F.count("*").alias("n")), [F.desc("n"), F.asc(name)]).select(name, "n", (F.col("_rank") - 1).alias("index"))


def share_of_total(df: DataFrame, key: str | Column, name: str) -> DataFrame:
    g = df.groupBy((F.col(key) if isinstance(key, str) else key).alias(name)).agg(F.count("*").alias("n"))
    return g.withColumn("pct", F.col("n").cast("double") * 100 / F.sum("n").over(Window.partitionBy()))


def ranked_union(paths: Sequence[tuple[str, DataFrame]], keys: Sequence[str], evidence: str, flag: str) -> DataFrame:
    """Rows of several paths as one per key: the best path's name, evidence counted once over all, flag if any.

    paths are (name, rows of keys + evidence + flag), best first.
    """
    names = F.array(*[F.lit(n) for n, _ in paths])
    rows = reduce(DataFrame.unionByName, [d.select(*keys, evidence, flag).withColumn("_rank", F.lit(i)) for i, (_, d) in enumerate(paths)])
    return rows.groupBy(*keys).agg(F.countDistinct(evidence).alias("n_references"), F.bool_or(flag).alias("validated"), F.min("_rank").alias("_rank")).withColumn("via", F.get(names, F.col("_rank"))).drop("_rank")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, name: str) -> DataFrame:
    """One row: keys in both, in one only, coverage of the old range, renames apart from case."""
    a = old.select(F.col(key).alias("_k"), F.col(name).alias("_a"), F.lit(True).alias("_old"))
    b = new.select(F.col(key).alias("_k"), F.col(name).alias("_b"), F.lit(True).alias("_new"))
    # old ids' range is two numbers
    span = old.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    j = a.join(b, "_k", "full").crossJoin(F.broadcast(span))
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    return j.agg(
        F.count_if(both).alias("in_both"),
        F.count_if(F.col("_new").isNull()).alias("only_old"),
        F.count_if(F.col("_old").isNull()).alias("only_new"),
        F.count_if(F.col("_old").isNull() & F.col("_k").between(F.col("lo"), F.col("hi"))).alias("new_in_old_range"),
        F.count_if(both & (F.lower("_a") != F.lower("_b"))).alias("renamed"),
    )


def update_from(df: DataFrame, other: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """UPDATE ... FROM: columns of the matching row; those without a match keep theirs, or get null where new."""
    o = other.select(key, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_hit"))
    j = df.join(o, key, "left")
    have = set(df.columns)
    return j.select(*(c for c in df.columns if c not in columns), *(F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c) if c in have else F.lit(None)).alias(c) for c in columns))


def never_clobber(made: DataFrame, human: DataFrame, key: str, column: str, owned: Column) -> DataFrame:
    """Freshly made values, save where a decision on file isn't one that the machine owns."""
    h = human.select(key, F.col(column).alias("_was"))
    return made.join(h, key, "left").withColumn(column, F.when(F.col("_was").isNull() | owned, F.col(column)).otherwise(F.col("_was"))).drop("_was")


def addon_delta(new: DataFrame, base: DataFrame, added: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in neither layer yet."""
    return new.join(base.select(key).union(added.select(key)).distinct(), key, "left_anti")


def two_layers(keys: DataFrame, base: DataFrame, added: DataFrame, key: str, value: str) -> DataFrame:
    """Lookup in the base layer, then in the added one."""
    b, a = base.select(key, F.col(value).alias("_b")), added.select(key, F.col(value).alias("_a"))
    return keys.join(b, key, "left").join(a, key, "left").withColumn(value, F.coalesce("_b", "_a")).drop("_a", "_b")


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows, blank, distinct, longest) of each column in one pass."""
    text = {c: F.col(c).cast("string") for c in columns}
    one = df.agg(F.count("*").alias("rows"), *(f.alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("blank", F.count_if(text[c].isNull() | (F.trim(text[c]) == ""))), ("distinct", F.countDistinct(c)), ("longest", F.max(F.length(text[c]))))))
    lines = ", ".join(f"'{c}', blank_{i}, distinct_{i}, cast(longest_{i} as bigint)" for i, c in enumerate(columns))
    return one.selectExpr("rows", f"stack({len(columns)}, {lines}) as (column, blank, distinct_values, longest)")


def sketches(df: DataFrame, columns: Sequence[str], by: Sequence[Column] = (), log_k: int = 14) -> DataFrame:
    """(by..., column, rows, blank, longest, distinct_sketch, length_sketch): one aggregate whose state is a few kilobytes a column, mergeable by merged()."""
    text = {c: F.col(c).cast("string") for c in columns}
    parts = (
        ("blank", lambda c: F.count_if(text[c].isNull() | (F.trim(text[c]) == ""))),
        ("longest", lambda c: F.max(F.length(text[c])).cast("long")),
        ("distinct_sketch", lambda c: F.hll_sketch_agg(F.concat(F.lit("="), text[c]), log_k)),  # it takes no empty texts
        ("length_sketch", lambda c: F.kll_sketch_agg_bigint(F.length(text[c]).cast("long"))),
    )
    one = df.groupBy(*by).agg(F.count("*").alias("rows"), *(f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in parts))
    each = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"{n}_{i}").alias(n) for n, _ in parts)) for i, c in enumerate(columns)))
    names = [c for c in one.columns if c == "rows" or not c.rsplit("_", 1)[-1].isdigit()]
    return one.select(*names, F.explode(each).alias("_c")).select(*names, "_c.*")


def merged(parts: DataFrame) -> DataFrame:
    """(column, rows, blank, longest, distinct_values, median_length) of sketches of parts of a table, by column.

    distinct_values is an estimate: with log_k of 14, 95 % of them are within 1.7 % (and all up to some thousands exact or nearly).
    median_length is an element whose rank is within 2 % of the middle; blanks that are null have no length.
    """
    g = parts.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("blank").alias("blank"), F.max("longest").alias("longest"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"), F.kll_merge_agg_bigint("length_sketch").alias("_k"))
    some = F.kll_sketch_get_n_bigint("_k") > 0
    return g.select("column", "rows", "blank", "longest", "distinct_values", F.when(some, F.kll_sketch_get_quantile_bigint("_k", F.lit(0.5))).alias("median_length"))


def checks(rows: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """(label, ok, observed): each a one-row frame with 'observed' and the test on it; checks of rows that are being written belong in VersionedTable.replace()."""
    return reduce(DataFrame.unionByName, [d.select(F.lit(label).alias("label"), test.alias("ok"), F.col("observed").cast("bigint").alias("observed")) for label, d, test in rows])


def upper_median(df: DataFrame, value: str) -> DataFrame:
    """(value): the element at n // 2 of the sorted values, from their counts; no task gets all of them."""
    g = ordered(df.groupBy(value).agg(F.count("*").alias("_n")), [F.asc(value)], "_n")
    half = df.agg(F.floor(F.count(value) / 2).alias("_half"))  # one row
    return g.where(F.col(value).isNotNull()).crossJoin(F.broadcast(half)).where((F.col("_running") > F.col("_half")) & (F.col("_running") - F.col("_n") <= F.col("_half"))).select(value)


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE: new values of some columns where a condition holds, from the row as it was."""
    return df.select(*(F.when(condition, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns))


def update_keys(df: DataFrame, key: str, keys: DataFrame, values: dict[str, Column]) -> DataFrame:
    """UPDATE ... WHERE key IN (keys), for any number of keys: a join, not batches of literals."""
    hit = keys.select(F.col(key)).distinct().withColumn("_hit", F.lit(True))
    return update_where(df.join(hit, key, "left"), F.col("_hit").isNotNull(), values).select(df.columns)
