import random

import pytest
from pyspark.sql import functions as F

from florispark.operators import cleaning as C
from florispark.operators import graph as G
from florispark.operators import mining as M
from florispark.operators import relational as R
from florispark.operators import serving as S


def test_not_in_is_null_aware(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    for right, want in (([(2,)], [1]), ([(2,), (None,)], []), ([], [1, 2, None])):
        got = R.not_in(left, spark.createDataFrame(right, "b int"), "a", "b")
        assert sorted((r.a for r in got.collect()), key=str) == sorted(want, key=str)


def test_similar_pairs_are_all_of_brute_force(spark):
    rng = random.Random(1)
    sets = {o: set(rng.choices(range(60), k=rng.randrange(5, 40))) for o in range(40)}
    df = spark.createDataFrame([(o, i) for o, s in sets.items() for i in s], "o int, i int")
    got = {(r.a, r.b): (r.shared, round(r.jaccard, 9)) for r in M.similar_pairs(df, "o", "i", 10, 5, 0.3).collect()}
    want = {}
    for a in sets:
        for b in sets:
            if a < b and min(len(sets[a]), len(sets[b])) >= 10:
                n = len(sets[a] & sets[b])
                j = n / len(sets[a] | sets[b])
                if n >= 5 and j >= 0.3:
                    want[a, b] = (n, round(j, 9))
    assert got == want and got


def test_similar_pairs_are_made_in_rounds_and_leave_no_shuffles(spark, monkeypatch):
    """Items of many owners are dealt into blocks, meetings into rounds; the files of the shuffles go once a table is there."""
    rng = random.Random(2)
    sets = {o: set(rng.choices(range(300), k=rng.randrange(60, 120))) for o in range(150)}
    df = spark.createDataFrame([(o, i) for o, s in sets.items() for i in s], "o long, i long").repartition(3)

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_"))

    monkeypatch.setattr(M, "BLOCK", 16, raising=False)
    monkeypatch.setattr(M, "ROUND", 60_000, raising=False)
    before = shuffled()
    got = {(r.a, r.b): r.shared for r in M.similar_pairs(df, "o", "i", 10, 5, 0.2).collect()}
    assert shuffled() - before < 20_000
    n = {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a < b}
    assert got == {(a, b): c for (a, b), c in n.items() if c >= 5 and c >= 0.2 * (len(sets[a]) + len(sets[b]) - c)} and len(got) > 100


def test_closure_with_diamonds_and_cycles(spark):
    e = spark.createDataFrame([("c", "b"), ("b", "a"), ("c", "d"), ("d", "a"), ("x", "y"), ("y", "x"), (None, "a")], "child string, parent string")
    got = {tuple(r) for r in G.ancestors(e).collect()}
    assert got == {("c", "b"), ("b", "a"), ("c", "a"), ("c", "d"), ("d", "a"), ("x", "y"), ("y", "x"), ("x", "x"), ("y", "y")}
    assert {r.node for r in G.descendants(e, "a").collect()} == {"b", "c", "d"}
    roles = spark.createDataFrame([("a", "r"), ("b", "s")], "n string, role string")
    inherited = {tuple(r) for r in G.inherited(roles, G.ancestors(e), "n", "role").collect()}
    assert {x for n, x in inherited if n == "c"} == {"r", "s"}
    nodes = spark.createDataFrame([("c",), ("x",)], "n string")
    assert {tuple(r) for r in G.first_root(nodes, G.ancestors(e), ["d", "b"], "n").collect()} == {("c", 0), ("x", 2)}


def test_ranked_union_names_the_best_path(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "s int, c int, doi int, v boolean")
    got = R.ranked_union([("name", rows((1, 1, 10, False))), ("synonym", rows((1, 1, 10, True), (1, 1, 11, False), (2, 1, 12, False)))], ["s", "c"], "doi", "v").collect()
    assert {(r.s, r.n_references, r.validated, r.via) for r in got} == {(1, 2, True, "name"), (2, 1, False, "synonym")}


def test_adjudication(spark):
    rows = [("A", 95, "A", 92), ("A", 95, None, 0), ("A", 95, "B", 95), ("A", 80, "A", 95), (None, 0, None, 0)]
    df = spark.createDataFrame(rows, "a string, ca int, b string, cb int")
    assert [(r.reason, r.resolved_to) for r in C.adjudicate(df, "a", "ca", "b", "cb").collect()] == [("same_name", "A"), ("one_side", "A"), ("two_species", None), ("weak_match", None), ("no_match", None)]


@pytest.mark.parametrize(
    "name,text,parts,source,processes",
    [
        ("SEED OIL", None, ["seed"], "inci", ["oil"]),
        ("FLOWER WATER EXTRACT", None, ["flower"], "inci", ["water", "extract"]),
        ("SEEDCAKE", None, ["seed"], "process_implied", ["seedcake"]),
        ("EXTRACT", "is an extract of the sprouts of the plant", ["sprout"], "description", ["extract"]),
        ("EXTRACT", "is an extract", None, None, ["extract"]),
        ("WHOLE ROOT EXTRACT", "", ["root"], "inci", ["extract"]),
    ],
)
def test_parts(spark, name, text, parts, source, processes):
    df = spark.createDataFrame([(name, text)], "n string, t string")
    vocab = {"SEED": "seed", "FLOWER": "flower", "SPROUT": "sprout", "ROOT": "root", "WHOLE": "whole_plant"}
    r = C.parts_and_processes(df, F.split("n", " "), F.col("t"), vocab, {"OIL": "oil", "WATER": "water", "EXTRACT": "extract", "SEEDCAKE": "seedcake"}, {"SEEDCAKE": "seed"}, []).first()
    assert (r.plant_part, r.part_source, r.process_all, r.process) == (parts, source, processes, processes[0])


def test_lookup_and_lists(spark):
    items = spark.createDataFrame([(1, "Rose Oil", "56-81-5"), (2, "ROSE OIL", "1-1-1"), (3, "Mint Leaf", "1-1-1")], "ref_no long, name string, cas string")
    q = spark.createDataFrame([("1",), ("1-1-1",), ("rose oil",), ("none",)], "query string")
    assert {r.query: r.ref_no for r in S.lookup(q, items).collect()} == {"1": 1, "1-1-1": 2, "rose oil": 2, "none": None}
    labels = spark.createDataFrame([(0, "rose oil"), (1, "mintleaf"), (2, "mint leaf water"), (3, " "), (4, "zzz")], "position long, label string")
    assert {r.position: (r.ref_no, r.tier) for r in S.match_list(labels, items).collect()} == {0: (2, 1), 1: (3, 2), 2: (3, 3), 4: (None, None)}
    assert S.match_list(labels.where("false"), items).count() == 0


def test_never_clobber_and_layers(spark):
    made = spark.createDataFrame([(1, "m"), (2, "m"), (3, "m")], "k int, v string")
    human = spark.createDataFrame([(1, "auto"), (2, "mine")], "k int, v string")
    assert {r.k: r.v for r in R.never_clobber(made, human, "k", "v", F.col("_was") == "auto").collect()} == {1: "m", 2: "mine", 3: "m"}
    assert [r.k for r in R.addon_delta(made, human.where("k = 1"), human.where("k = 2"), "k").collect()] == [3]


def test_what_is_within_what(spark):
    from florispark.operators.serving import within

    parts = ["red ring", "ring", "ng", "g", "zz", "ring red", "édi"]
    wholes = ["a red ring", "ring", "strong", "médium", "g", ""]
    got = within(spark.createDataFrame([(x,) for x in parts], "part string"), spark.createDataFrame([(x,) for x in wholes], "whole string"))
    assert {tuple(r) for r in got.collect()} == {(p, w) for p in parts for w in wholes if p in w}


def test_ranks_medians_and_closures_over_many_ranges(spark):
    from florispark.operators import graph as G
    from florispark.operators import relational as R

    df = spark.range(1000).select(F.pmod(F.xxhash64("id"), F.lit(97)).alias("v"))
    values = sorted(r.v for r in df.collect())
    assert R.upper_median(df, "v").first().v == values[500]
    rows = R.ordered(df.groupBy("v").agg(F.count("*").alias("n")), [F.desc("n"), F.asc("v")], "n").orderBy("_rank").collect()
    assert [r._rank for r in rows] == list(range(1, len(rows) + 1)) and rows[-1]._running == 1000
    assert all(b._running - a._running == b.n and (-a.n, a.v) < (-b.n, b.v) for a, b in zip(rows, rows[1:]))
    assert R.upper_median(df.where("false"), "v").count() == 0
    edges = [(i, i + 1) for i in range(30)] + [(30, 0), (40, 41), (40, 42), (41, 43), (42, 43)]
    got = {tuple(r) for r in G.ancestors(spark.createDataFrame(edges, "child long, parent long")).collect()}
    assert got == {(a, b) for a in range(31) for b in range(31)} | {(40, 41), (40, 42), (40, 43), (41, 43), (42, 43)}


def test_rows_are_dealt_by_their_number_not_by_their_bytes(spark):
    from florispark.session import dealt

    df = spark.range(10_000).selectExpr("id % 2500 as k", "id")
    sizes = lambda d: [r[0] for r in d.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]
    got = dealt(df, 10_000, "k", most=500)
    assert len(sizes(got)) == 20 and max(sizes(got)) < 1000
    # a group of the same columns needs no further exchange, which would be put together by bytes again
    assert got.groupBy("k").count()._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert dealt(df, 10_000, "k") is df
