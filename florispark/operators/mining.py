"""Mining: concentration, gaps, sharing, set similarity, neighbours."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from florispark.operators.relational import ordered
from florispark.session import dealt, table_cut


BLOCK = 128  # owners of an item that are held together
ROUND = 200_000_000  # meetings of two owners at an item that are on disk at a time
TASK = 2_000_000  # of these in a task


def _met(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(a, b, n_a, n_b): of the owners b that a meets, those with so many meetings that the sets may be alike.  Rows are sorted by a, which may go on in the next batch."""
    names = ["a", "b", "n_a", "n_b"]
    held: tuple[np.ndarray, ...] | None = None

    def counted(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(len(a), 1), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        c = np.add.reduceat(c[order], first) if len(first) else c[order]
        return a[first], n_a[order][first], b[first], n_b[order][first], c

    def enough(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        rest = np.ceil(np.maximum(n_a, n_b) * least) - 1  # beyond the prefix of the larger set
        ok = ((c + rest) * (1 + least) >= (n_a + n_b) * least - 1e-6) & (np.minimum(n_a, n_b) >= np.maximum(n_a, n_b) * least)
        return pa.RecordBatch.from_arrays([pa.array(x[ok]) for x in (a, b, n_a, n_b)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        a, n_a, b, n_b = batch.columns
        size = np.diff(b.offsets.to_numpy())
        rows = (np.repeat(a.to_numpy(), size), np.repeat(n_a.to_numpy(), size), b.flatten().to_numpy(), n_b.flatten().to_numpy(), np.ones(size.sum(), np.int64))
        rows = counted(*(np.concatenate(x) for x in zip(held, rows, strict=True)) if held else rows)
        last = int(np.searchsorted(rows[0], rows[0][-1]))
        held = tuple(x[last:] for x in rows)
        if last:
            yield enough(*(x[:last] for x in rows))
    if held:
        yield enough(*held)


def similar_pairs(edges: DataFrame, owner: str, item: str, min_members: int = 10, min_shared: int = 5, least: float = 0.15) -> DataFrame:
    """(a, b, shared, n_a, n_b, jaccard) for owners a < b with that overlap of item sets.

    An inverted index with a prefix filter: an owner is only looked up under those items, rare ones
    first, of which a similar owner must have one (n - ceil(least * n) + 1 of n).  Common items sort
    last and so seldom meet.  What two owners share beyond both their prefixes is in the rest of one
    of them, so a pair whose common items and the larger rest don't suffice goes; only the others
    are counted on full sets.

    Owners that meet are sent as lists, one for each owner and item, to where the owner's are counted; a row for each meeting
    would be many times as large.  These lists are quadratic in an item's owners, so they are made in rounds, each of some of the owners a,
    and what is on disk at a time is bounded: see ROUND.
    """
    own = edges.select(F.col(owner).cast("long").alias("o"), F.col(item).alias("i"))
    e = table_cut(dealt(own, edges.count(), "o", "i").distinct(), free=True)
    rows = e.count()
    full, e = e, dealt(e, rows, "o")
    sizes = e.groupBy("o").agg(F.count("*").alias("n")).where(F.col("n") >= min_members)
    e = e.join(sizes, "o")
    common = e.groupBy("i").agg(F.count("*").alias("df"))
    ranked = dealt(dealt(e, rows, "i").join(common, "i"), rows, "o").withColumn("r", F.row_number().over(Window.partitionBy("o").orderBy("df", "i")))
    first = F.col("n") - F.ceil(F.col("n") * least) + 1
    head = table_cut(ranked.where(F.col("r") <= first).select("o", "i", "n", F.ceil(F.col("df") / BLOCK).cast("int").alias("blocks")), free=True)
    # an item's owners are dealt into blocks, and two blocks meet at a time
    many = head.agg(F.sum("blocks")).first()[0] or 0
    other = head.withColumn("block", F.pmod(F.xxhash64("o"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = other.select("i", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), F.struct("o", "n", "block").alias("x"))
    lists = dealt(tiles, many, "i", "low", "high").groupBy("i", "low", "high").agg(F.sort_array(F.collect_list("x")).alias("all")).where(F.size("all") > 1)
    lists = table_cut(lists.select((F.col("low") == F.col("high")).alias("one"), "all"), free=True)
    met = lists.agg(F.sum(F.size("all").cast("long") * (F.size("all") - 1) / 2)).first()[0] or 0
    rounds = int(met // ROUND) + 1
    parts = max(int(met / rounds // TASK) + 1, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    found = []
    for at in range(rounds):
        each = lists.select("one", "all", F.posexplode("all").alias("at", "x")).where(F.pmod(F.xxhash64("x.o"), F.lit(rounds)) == at)
        later = F.when(F.col("one"), F.slice("all", F.col("at") + 2, F.size("all"))).otherwise(F.filter("all", lambda y: (y["o"] > F.col("x.o")) & (y["block"] != F.col("x.block"))))
        each = each.select("x.o", "x.n", later.alias("later")).where(F.size("later") > 0).select(F.col("o").alias("a"), F.col("n").alias("n_a"), F.col("later.o").alias("b"), F.col("later.n").alias("n_b"))
        found.append(table_cut(each.repartition(parts, "a").sortWithinPartitions("a").mapInArrow(lambda it: _met(it, least), "a long, b long, n_a long, n_b long"), free=True))
    pairs = reduce(DataFrame.union, found)
    x, y = (full.select(F.col("o").alias(c), F.col("i").alias("i")) for c in "ab")
    # a pair has a row for each item of its first owner; these are as many as the mean set times the pairs, or so
    many = max(rows, pairs.count() * rows // max(1, full.select("o").distinct().count()))
    both = dealt(dealt(pairs, rows, "a").join(dealt(x, rows, "a"), "a"), many, "b", "i").join(dealt(y, many, "b", "i"), ["b", "i"]).groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared"))
    both = both.withColumn("jaccard", F.col("shared").cast("double") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).where((F.col("shared") >= min_shared) & (F.col("jaccard") >= least))
    return table_cut(both.select("a", "b", "n_a", "n_b", "shared", "jaccard"), free=True)


def neighbour_coherence(pairs: DataFrame, group_of: DataFrame, owner: str, group: str, k: int = 5, min_members: int = 3) -> DataFrame:
    """(group, members, neighbours, same): of each group's k nearest neighbours, how many are of the group."""
    both = pairs.select("a", "b", "jaccard").union(pairs.select(F.col("b"), F.col("a"), "jaccard"))
    g = group_of.select(owner, F.col(group).alias("g"))
    named = both.join(g.withColumnsRenamed({owner: "a", "g": "ga"}), "a").join(g.withColumnsRenamed({owner: "b", "g": "gb"}), "b")
    near = named.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("jaccard"), F.desc("b"), F.desc("gb")))).where(F.col("r") <= k)
    return near.groupBy(F.col("ga").alias(group)).agg(F.countDistinct("a").alias("members"), F.count("*").alias("neighbours"), F.count_if(F.col("ga") == F.col("gb")).alias("same")).where(F.col("members") >= min_members)


def concentration(rows: DataFrame, category: str, group: str, member: str, least: int = 20, k: int = 3) -> DataFrame:
    """(category, total, group, n, pct, rank): the k groups with most distinct members; total sums distinct members by group."""
    per = rows.groupBy(category, group).agg(F.countDistinct(member).alias("n"))
    w = Window.partitionBy(category)
    per = per.withColumn("total", F.sum("n").over(w)).where(F.col("total") >= least)
    per = per.withColumn("rank", F.row_number().over(w.orderBy(F.desc("n"), group))).where(F.col("rank") <= k)
    return per.withColumn("pct", F.col("n").cast("double") * 100 / F.col("total"))


def gaps(used: DataFrame, known: DataFrame, category: str, group: str, member: str, genus: str, least: int = 5, candidates: int = 1) -> DataFrame:
    """(category, group, n_candidates): groups strong in a category, and known organisms of their genera that aren't used at all."""
    strong = used.groupBy(category, group).agg(F.countDistinct(member).alias("n_used")).where(F.col("n_used") >= least)
    bridge = used.select(genus, group).distinct()
    unused = known.join(used.select(member).distinct(), member, "left_anti").join(bridge, genus).groupBy(group).agg(F.countDistinct(member).alias("n_candidates")).where(F.col("n_candidates") >= candidates)
    return strong.join(unused, group).select(category, group, "n_used", "n_candidates")


def sharing(edges: DataFrame, group: str, owner: str, item: str, least: int = 50) -> DataFrame:
    """(group, total, shared, most): items of a group, those that two or more of its owners have, and the most owners of one."""
    per = edges.groupBy(group, item).agg(F.countDistinct(owner).alias("n"))
    return per.groupBy(group).agg(F.count("*").alias("total"), F.count_if(F.col("n") >= 2).alias("shared"), F.max("n").alias("most")).where(F.col("total") >= least)


def concentration_curve(df: DataFrame, key: str, ranks: list[int]) -> DataFrame:
    """(rank, key, n, running, pct) at some ranks and the last."""
    g = df.groupBy(key).agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n").alias("total"), F.count("*").alias("last"))  # one row
    g = ordered(g, [F.desc("n"), F.asc(key)], "n").withColumnsRenamed({"_rank": "rank", "_running": "running"}).crossJoin(F.broadcast(total))
    return g.where(F.col("rank").isin(*ranks) | (F.col("rank") == F.col("last"))).select("rank", key, "n", "running", (F.col("running").cast("double") * 100 / F.col("total")).alias("pct"))
