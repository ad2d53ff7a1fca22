"""Reachability from labels: what is below or above what, without a stored pair for each.

A spanning forest takes one parent of each node.  Nodes are numbered in the forest's order, so what is below a node in
it is a stretch of numbers; edges outside the forest are kept as links from a stretch to a number.  Labels
are one row a node, links one row an edge outside the forest, however deep the hierarchy is.  Answers
begin with stretches and follow links, so their rounds are the links on a path, not its length; rows of nodes are made at the end only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florispark.session import table_cut as cut

from .relational import ordered

BLOCK = 1024


class Labels(NamedTuple):
    """nodes (node, first, last): a node's number and the largest number below it; links (link, at, first, last): the stretch of a child and its parent's number."""

    nodes: DataFrame
    links: DataFrame


def _jumped(state: DataFrame, values: list, wanted: tuple[str, ...]) -> DataFrame:
    """state with each jump replaced by that of the node jumped to; values may use its columns with _ in front."""
    to = state.select(*(F.col(c).alias(f"_{c}") for c in ("node", "jump", *wanted)))
    return state.join(to.hint("merge"), F.col("jump") == F.col("_node"), "left").select("node", F.col("_jump").alias("jump"), *values)


def _without_cycles(tree: DataFrame, many: int) -> DataFrame:
    """tree (node, up) less the edge of the smallest node of each cycle."""
    state, steps = tree.select("node", F.col("up").alias("jump"), F.col("up").alias("low")), 1
    while steps <= many:
        # low is the smallest node among the next `steps`
        state, steps = cut(_jumped(state.where("jump is not null"), [F.least("low", "_low").alias("low")], ("low",))), 2 * steps
    top = state.where("jump is not null and low = node").select("node", F.lit(True).alias("_top"))
    return cut(tree.join(top, "node", "left").select("node", F.when(F.col("_top").isNull(), F.col("up")).alias("up")))


def _sizes(tree: DataFrame, many: int) -> DataFrame | None:
    """(node, up, size) with the number of nodes below each in the forest, itself included; rounds grow with the logarithm of the depth.  None of a tree with cycles."""
    state, steps = cut(tree.select("node", F.col("up").alias("jump"), F.lit(1).cast("long").alias("size"))), 1
    while not state.where("jump is not null").isEmpty():
        if steps > many:
            return None
        # size counts what is less than `steps` below; those exactly so far below bring what is less than `steps` below them
        more = state.where("jump is not null").groupBy(F.col("jump").alias("_at")).agg(F.sum("size").alias("_more"))
        grown = state.join(more.hint("merge"), F.col("node") == F.col("_at"), "left").select("node", "jump", (F.col("size") + F.coalesce("_more", F.lit(0))).alias("size"))
        state, steps = cut(_jumped(grown, ["size"], ())), 2 * steps
    return cut(tree.join(state.select("node", "size").hint("merge"), "node"))


def labels(edges: DataFrame, child: str = "child", parent: str = "parent") -> Labels:
    """Labels of a directed graph; diamonds, cycles, edges to oneself and several roots are allowed.

    Edges with a null end and repeated ones don't count; an empty table has empty labels.
    """
    e = cut(edges.select(F.col(child).alias("child"), F.col(parent).alias("parent")).where("child is not null and parent is not null").distinct())
    least = e.where("child <> parent").groupBy("child").agg(F.min("parent").alias("up"))
    every = e.select(F.col("child").alias("node")).union(e.select("parent")).distinct()
    tree = cut(every.join(least.hint("merge"), F.col("node") == F.col("child"), "left").select("node", "up"))
    many = tree.count()
    sized = _sizes(tree, many)
    if sized is None:
        tree = _without_cycles(tree, many)
        sized = _sizes(tree, many)
    # siblings stand in order; what a node's earlier siblings hold is a running sum over all, less that of its first sibling
    run = cut(ordered(sized, [F.asc_nulls_first("up"), F.asc("node")], "size").select("node", "up", "size", (F.col("_running") - F.col("size")).alias("start")))
    base = run.groupBy(F.col("up").alias("_up")).agg(F.min("start").alias("_base"))
    placed = run.join(base.hint("merge"), F.col("up").eqNullSafe(F.col("_up"))).withColumn("first", F.col("start") - F.col("_base") + F.when(F.col("up").isNull(), 0).otherwise(1))
    state = cut(placed.select("node", F.col("up").alias("jump"), "first"))
    while not state.where("jump is not null").isEmpty():
        state = cut(_jumped(state, [(F.col("first") + F.coalesce("_first", F.lit(0))).alias("first")], ("first",)))
    nodes = cut(state.join(sized.select("node", "size").hint("merge"), "node").select("node", "first", (F.col("first") + F.col("size") - 1).alias("last")))
    other = e.join(tree.where("up is not null").hint("merge"), (F.col("child") == F.col("node")) & (F.col("parent") == F.col("up")), "left_anti")
    low = nodes.select(F.col("node").alias("child"), "first", "last")
    links = other.join(low.hint("merge"), "child").join(nodes.select(F.col("node").alias("parent"), F.col("first").alias("at")).hint("merge"), "parent")
    return Labels(nodes, cut(links.select(F.xxhash64("at", "first").alias("link"), "at", "first", "last")))


def _in_blocks(stretches: DataFrame) -> DataFrame:
    """A row for each block of numbers that a stretch has a part in."""
    return stretches.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor(F.col("last") / BLOCK))))


def _covered(stretches: DataFrame) -> DataFrame:
    """Stretches of a mark that overlap or nest, as one; by running sums over all, so that no mark is one task's."""
    ends = stretches.select("mark", F.col("first").alias("pos"), F.lit(1).alias("step")).union(stretches.select("mark", F.col("last") + 1, F.lit(-1)))
    ends = ends.groupBy("mark", "pos").agg(F.sum("step").alias("step")).where("step <> 0")
    deep = ordered(ends, [F.asc("mark"), F.asc("pos")], "step").select("mark", "pos", F.col("_running").alias("deep"), (F.col("_running") - F.col("step")).alias("was"))
    edge = deep.where("deep = 0 or was = 0").withColumn("opens", (F.col("was") == 0).cast("long"))
    number = ordered(edge, [F.asc("mark"), F.asc("pos")], "opens")
    return number.groupBy("mark", "_running").agg(F.min("pos").alias("first"), (F.max("pos") - 1).alias("last")).select("mark", "first", "last")


def spread(marks: DataFrame, labels: Labels, own: bool = True, most_rounds: int = 10_000) -> DataFrame:
    """(node, mark): nodes that are below a marked node of (node, mark), and with `own` the marked ones as well.

    Without `own` a marked node is there if it is below one of the same mark, as on a cycle.  Marks of
    unknown nodes, and null nodes and marks, have no rows.  A link is followed once for each mark.
    """
    begin = marks.where("mark is not null").join(labels.nodes.hint("merge"), "node").select("mark", "first", "last").distinct()
    front = cut(begin)
    found = front if own else front.where("first < last").withColumn("first", F.col("first") + 1)
    links = labels.links.withColumn("block", F.floor(F.col("at") / BLOCK)).withColumnsRenamed({"first": "_first", "last": "_last"})
    seen = front.select("mark", F.lit(0).cast("long").alias("link"), "first", "last").where("false")
    for _ in range(most_rounds):
        met = _in_blocks(front).join(links.hint("merge"), "block").where("at between first and last")
        new = met.select("mark", "link", F.col("_first").alias("first"), F.col("_last").alias("last")).distinct()
        new = cut(new.join(seen.hint("merge"), ["mark", "link", "first", "last"], "left_anti"))
        if new.isEmpty():
            break
        seen = cut(seen.union(new))
        front = new.select("mark", "first", "last")
    else:
        raise RuntimeError("more links on a path than expected")
    stretches = _covered(found.union(seen.select("mark", "first", "last")).distinct())
    # the numbers of a stretch, a block at a time
    numbers = _in_blocks(stretches).select("mark", F.explode(F.sequence(F.greatest("first", F.col("block") * BLOCK), F.least("last", F.col("block") * BLOCK + (BLOCK - 1)))).alias("first"))
    return numbers.join(labels.nodes.hint("merge"), "first").select("node", "mark")


def below(root, labels: Labels) -> DataFrame:
    """(node): what is below one root."""
    one = labels.nodes.where(F.col("node") == F.lit(root)).select("node", F.lit(1).alias("mark"))
    return spread(one, labels, own=False).select("node")


def inherited(attributes: DataFrame, labels: Labels, node: str, attribute: str) -> DataFrame:
    """(node, attribute): own attributes and those of all ancestors; nodes outside the hierarchy keep their own."""
    own = attributes.select(F.col(node).alias("node"), F.col(attribute).alias("mark")).where("node is not null and mark is not null").distinct()
    alone = own.join(labels.nodes.select("node").hint("merge"), "node", "left_anti")
    return spread(own, labels).union(alone).select("node", F.col("mark").alias("attribute"))


def first_root(labels: Labels, roots: list) -> DataFrame:
    """(node, category): index of the first of some roots that a node is or is below, else their number."""
    numbers = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(i).alias("i")) for i, r in enumerate(roots)))
    hit = F.filter(numbers, lambda x: x["r"] == F.col("node"))
    marks = labels.nodes.where(F.size(hit) > 0).select("node", F.element_at(hit, 1)["i"].alias("mark"))
    best = spread(marks, labels).groupBy("node").agg(F.min("mark").alias("mark"))
    return labels.nodes.select("node").join(best.hint("merge"), "node", "left").select("node", F.coalesce("mark", F.lit(len(roots))).cast("bigint").alias("category"))
