"""Hierarchies and the ego graph."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florispark.session import dealt, table_cut


def ancestors(edges: DataFrame, child: str = "child", parent: str = "parent", most_rounds: int = 40) -> DataFrame:
    """(node, ancestor) of a directed graph, cycles and diamonds allowed.

    Path doubling over new pairs only: each round joins the pairs that the last one found with all
    pairs, on either side, so rounds grow with the logarithm of the depth and no two old pairs meet
    again.  Ends when a round finds nothing new.
    """
    new = pairs = table_cut(edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).where("node is not null and ancestor is not null").distinct())
    many = got = pairs.count()

    def over(low, n_low, high, n_high):
        low = dealt(low.select("node", F.col("ancestor").alias("_via")), n_low, "_via").hint("merge")
        return low.join(dealt(high.select(F.col("node").alias("_via"), "ancestor"), n_high, "_via"), "_via").select("node", "ancestor")

    for _ in range(most_rounds):
        # repeated pairs go where the new ones are told from the old
        both = table_cut(over(new, got, pairs, many).union(over(pairs, many, new, got)))
        rows = max(both.count(), many)
        found = dealt(both, rows, "node", "ancestor").distinct().hint("merge")
        new = table_cut(found.join(dealt(pairs, rows, "node", "ancestor"), ["node", "ancestor"], "left_anti"))
        got = new.count()
        if not got:
            return pairs
        pairs, many = table_cut(pairs.union(new)), many + got
    raise RuntimeError("the hierarchy is deeper than expected")


def descendants(edges: DataFrame, root, child: str = "child", parent: str = "parent", most_rounds: int = 200) -> DataFrame:
    """(node): what is below one root, level by level over the frontier only."""
    spark = edges.sparkSession
    e = table_cut(edges.select(F.col(parent).alias("p"), F.col(child).alias("c")).where("p is not null and c is not null"))
    seen = front = spark.range(1).select(F.lit(root).cast(dict(e.dtypes)["p"]).alias("node"))
    seen = seen.where("false")
    for _ in range(most_rounds):
        # all edges and all that was seen stay where they are; only joins that need no table on the driver
        next_ = front.join(e.hint("merge"), F.col("node") == F.col("p")).select(F.col("c").alias("node")).distinct()
        front = table_cut(next_.hint("merge").join(seen, "node", "left_anti"))
        if front.isEmpty():
            return seen
        seen = table_cut(seen.union(front))
    raise RuntimeError("the hierarchy is deeper than expected")


def inherited(attributes: DataFrame, closure: DataFrame, node: str, attribute: str) -> DataFrame:
    """(node, attribute): own attributes and those of all ancestors."""
    own = attributes.select(F.col(node).alias("node"), F.col(attribute).alias("attribute"))
    rows = closure.count()
    above = dealt(closure, rows, "ancestor").join(own.withColumnRenamed("node", "ancestor"), "ancestor").select("node", "attribute")
    return dealt(own.union(above), rows, "node").distinct()


def two_tier_match(keys: DataFrame, table: DataFrame, key: str, flat: Column, value: str) -> DataFrame:
    """(key, value, tier): exact matches, and for keys without one those whose flat form agrees."""
    t = table.select(F.col(key).alias("_k"), F.col(value))
    exact = keys.join(t, F.col(key) == F.col("_k")).select(key, value, F.lit(0).alias("tier"))
    rest = keys.join(t.select("_k").distinct(), F.col(key) == F.col("_k"), "left_anti").withColumn("_f", flat)
    flats = table.withColumn("_f2", flat).select("_f2", value)
    return exact.union(rest.join(flats, F.col("_f") == F.col("_f2")).select(key, value, F.lit(1).alias("tier"))).distinct()


def first_root(nodes: DataFrame, closure: DataFrame, roots: Sequence, node: str) -> DataFrame:
    """(node, category): index of the first of some roots that a node is or is below, else their number."""
    number = reduce(lambda acc, ir: acc.when(F.col("ancestor") == F.lit(ir[1]), F.lit(ir[0])), list(enumerate(roots)), F.when(F.lit(False), F.lit(0)))
    rows = closure.count()
    both = dealt(nodes.select(F.col(node).alias("node")), rows, "node").join(dealt(closure, rows, "node"), "node", "left").select("node", "ancestor").union(nodes.select(F.col(node).alias("node"), F.col(node).alias("ancestor")))
    return both.groupBy("node").agg(F.coalesce(F.min(number), F.lit(len(roots))).cast("bigint").alias("category"))


def ego(neighbours: Sequence[tuple[str, DataFrame, int]]) -> DataFrame:
    """(kind, id, weight, rank): of each kind of neighbour (rows of id, weight) the strongest, up to its cap."""
    w = Window.partitionBy("kind").orderBy(F.desc("weight"), "id")
    parts = [d.select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"), F.col("weight").cast("bigint").alias("weight"), F.lit(cap).alias("cap")) for kind, d, cap in neighbours]
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(w).cast("bigint"))
    return ranked.where(F.col("rank") <= F.col("cap")).drop("cap")
