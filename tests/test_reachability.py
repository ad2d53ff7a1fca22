"""Labels against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from florispark.operators import graph as G
from florispark.operators import reachability as R

EDGES = "child long, parent long"


def above(edges):
    """Pairs (node, ancestor) of edges (child, parent)."""
    up = {}
    for c, p in edges:
        up.setdefault(c, set()).add(p)
    out = set()
    for c in up:
        todo, seen = list(up[c]), set()
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += up.get(x, ())
        out |= {(c, x) for x in seen}
    return out


def random_graphs():
    rng = random.Random(11)
    forest = [(i, rng.randrange(i)) for i in range(1, 25)]
    diamonds = [(i, rng.randrange(i)) for i in range(1, 25) for _ in range(2)]
    tangle = [(rng.randrange(20), rng.randrange(20)) for _ in range(26)]
    # several cycles with trees on them, an edge to oneself, smaller nodes below a cycle than on it, and edges that don't count
    cycles = [(5, 6), (6, 7), (7, 5), (1, 5), (0, 1), (9, 8), (8, 9), (3, 3), (2, 9), (2, 7), (5, 6), (None, 4), (4, None)]
    return {"forest": forest, "diamonds": diamonds, "tangle": tangle, "cycles": cycles}


@pytest.mark.parametrize("name", list(random_graphs()))
def test_against_brute_force(spark, name):
    edges = random_graphs()[name]
    made = R.labels(spark.createDataFrame(edges, EDGES))
    real = [(c, p) for c, p in edges if c is not None and p is not None]
    nodes, pairs = {x for e in real for x in e}, above(real)
    rows = [tuple(r) for r in made.nodes.collect()]
    assert sorted(r[0] for r in rows) == sorted(nodes)
    assert sorted(r[1] for r in rows) == list(range(len(nodes)))
    # each node marked with itself: all pairs at once, own ones only on cycles
    marks = made.nodes.select("node", F.col("node").alias("mark"))
    got = [tuple(r) for r in R.spread(marks, made, own=False).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs
    root = min(nodes)
    assert sorted(r.node for r in R.below(root, made).collect()) == sorted(c for c, p in pairs if p == root)


def test_attributes_and_categories_equal_the_closure(spark):
    rng = random.Random(3)
    edges = spark.createDataFrame([(i, rng.randrange(i)) for i in range(1, 60) for _ in range(1 + i % 2)], EDGES)
    held = spark.createDataFrame([(rng.randrange(60), f"r{i % 4}") for i in range(12)] + [(777, "r9"), (None, "r1"), (5, None)], "node long, role string")
    made, closure = R.labels(edges), G.ancestors(edges)
    clean = held.where("node is not null and role is not null")
    assert sorted(map(tuple, R.inherited(held, made, "node", "role").collect())) == sorted(map(tuple, G.inherited(clean, closure, "node", "role").collect()))
    every = made.nodes.select("node")
    assert sorted(map(tuple, R.first_root(made, [4, 2, 1]).collect())) == sorted(map(tuple, G.first_root(every, closure, [4, 2, 1], "node").collect()))


def test_deep_hierarchies_have_a_row_a_node(spark):
    """A chain of 1,500 with a few other edges, and a cycle of 400 with a chain below it."""
    chain = [(i, i - 1) for i in range(1, 1500)] + [(i, i // 3) for i in range(300, 1500, 300)]
    ring = [(2000 + i, 2000 + (i + 1) % 400) for i in range(400)] + [(2400, 2000)] + [(i, i - 1) for i in range(2401, 2450)]
    made = R.labels(spark.createDataFrame(chain + ring, EDGES))
    assert made.nodes.count() == 1500 + 450
    assert made.links.count() == 4 + 1  # edges outside the forest
    marks = spark.createDataFrame([(1000, 1), (1400, 2), (2017, 3), (2430, 4)], "node long, mark long")
    got = {}
    for r in R.spread(marks, made, own=False).collect():
        got.setdefault(r.mark, []).append(r.node)
    want = {1: range(1001, 1500), 2: range(1401, 1500), 3: range(2000, 2450), 4: range(2431, 2450)}
    assert {m: sorted(v) for m, v in got.items()} == {m: list(v) for m, v in want.items()}


def estimated(df):
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def test_rounds_below_a_root_have_the_sizes_of_their_files(spark):
    """What is estimated for a round isn't the product of all rounds before it: the driver's plans don't grow."""
    edges = spark.createDataFrame([(i, i // 2) for i in range(2, 1000)], EDGES)
    got = G.descendants(edges, 3)
    assert sorted(r.node for r in got.collect()) == sorted(c for c, p in above([(i, i // 2) for i in range(2, 1000)]) if p == 3)
    assert estimated(got) < 1_000_000, estimated(got)
