import itertools
import random

import pytest

from florispark.functions import notation
from florispark.operators import structure as S

SAME = [
    ("OCC", "C(O)C", "[H]OCC", "C-C-O"),
    ("c1ccccc1", "C1=CC=CC=C1", "[cH]1[cH][cH][cH][cH][cH]1"),
    ("N[C@@H](C)C(=O)O", "OC(=O)[C@@H](N)C", "C[C@H](N)C(O)=O", "[H][C@@](C)(N)C(=O)O"),
    ("c1ccc2ccccc2c1", "C1=CC=C2C=CC=CC2=C1"),
    ("[Na+].[Cl-]", "[Cl-].[Na+]"),
    ("C%10CCCC%10", "C1CCCC1"),
    ("c1cc[nH]c1", "[nH]1cccc1", "N1C=CC=C1"),
]
BAD = ["C1CC", "C(", "C)", "", None, "C==C", "Xx", "C1C1", "=C", "C.", "C(C", "[C"]


def keys(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    return {r.notation: (r.full_key, r.connectivity_key) for r in S.structure_keys(df, "x").collect()}


def test_spellings(spark):
    got = keys(spark, [*itertools.chain(*SAME), "N[C@H](C)C(=O)O", "C1CCC2CCCCC2C1", "C1CCC(C1)C1CCCC1", "[13CH4]", "C", *BAD])
    for group in SAME:
        assert len({got[x] for x in group}) == 1, group
    assert len({got[g[0]] for g in SAME}) == len(SAME)
    left, right = got["N[C@@H](C)C(=O)O"], got["N[C@H](C)C(=O)O"]
    assert left[0] != right[0] and left[1] == right[1]
    assert got["C1CCC2CCCCC2C1"][1] != got["C1CCC(C1)C1CCCC1"][1]  # which neighbours' labels alone can't tell apart
    assert got["C"][0] != got["[13CH4]"][0] and got["C"][1] == got["[13CH4]"][1]
    assert not set(BAD) & set(got)


@pytest.mark.parametrize("text, want", [
    ("CCO", ("C2H6O", 3, 0, 1, 1, 0, 1.0)),
    ("c1ccccc1O", ("C6H6O", 7, 1, 1, 1, 0, 0.0)),
    ("CC(=O)Oc1ccccc1C(=O)O", ("C9H8O4", 13, 1, 1, 4, 3, 1 / 9)),
    ("CN1C=NC2=C1C(=O)N(C(=O)N2C)C", ("C8H10N4O2", 14, 2, 0, 6, 0, 3 / 8)),
    ("[NH4+].[Cl-]", ("H4ClN", 2, 0, 1, 1, 0, 0.0)),
    ("[O-]S(=O)(=O)O", ("HO4S-", 5, 0, 1, 4, 0, 0.0)),
    ("[H][H]", ("H2", 0, 0, 0, 0, 0, 0.0)),
    ("C1CC", (None,) * 7),
])
def test_figures(spark, text, want):
    r = S.structure_figures(spark.createDataFrame([(text,)], "x string"), "x").first()
    assert tuple(r)[1:-1] == want[:-1] and r.fsp3 == (pytest.approx(want[-1]) if want[-1] is not None else None)


def spelled(n, edges, elements, rng):
    """A notation of a graph, from any atom, in any order."""
    near = {i: [b if a == i else a for a, b in edges if i in (a, b)] for i in range(n)}
    used, tree, back = set(), {}, []

    def walk(i, up):
        used.add(i)
        tree[i] = []
        rest = [x for x in near[i] if x != up]
        rng.shuffle(rest)
        for x in rest:
            if x not in used:
                tree[i].append(x)
                walk(x, i)
            elif (x, i) not in back and (i, x) not in back:
                back.append((i, x))

    def write(i):
        rings = "".join(f"%{10 + k}" for k, pair in enumerate(back) if i in pair)
        inner = [write(x) for x in tree[i]]
        return f"[{elements[i]}]" + rings + "".join(f"({x})" for x in inner[:-1]) + "".join(inner[-1:])

    root = rng.randrange(n)
    walk(root, None)
    return write(root) if len(used) == n else None


def test_keys_are_isomorphism_on_small_graphs(spark):
    rng, graphs, texts = random.Random(5), [], []
    while len(graphs) < 60:
        n = rng.choice([4, 5, 6])
        edges = sorted(rng.sample(list(itertools.combinations(range(n), 2)), rng.randint(n - 1, n + 2)))
        elements = [rng.choice(["C", "C", "C", "N"]) for _ in range(n)]
        both = [spelled(n, edges, elements, rng) for _ in range(2)]
        if both[0]:
            graphs.append((n, set(edges), elements))
            texts.append(both)
    got = keys(spark, itertools.chain(*texts))
    for a, b in texts:
        assert got[a] == got[b], (a, b)

    def iso(x, y):
        if x[0] != y[0] or len(x[1]) != len(y[1]) or sorted(x[2]) != sorted(y[2]):
            return False
        return any(all(x[2][i] == y[2][p[i]] for i in range(x[0])) and {tuple(sorted((p[a], p[b]))) for a, b in x[1]} == y[1] for p in itertools.permutations(range(x[0])))

    for (i, x), (j, y) in itertools.combinations(enumerate(graphs), 2):
        assert (got[texts[i][0]] == got[texts[j][0]]) == iso(x, y), (texts[i][0], texts[j][0])


def test_bridges():
    atoms, bonds = notation.parse("C1CC1CC2CCC2")
    assert sorted((b["a"], b["b"]) for b in bonds if not b["ring"]) == [(2, 3), (3, 4)]


def test_verification(spark):
    rows = [(1, 0, "N[C@H](C)C(=O)O"), (1, 1, "OC(=O)[C@@H](N)C"), (2, 0, "N[C@H](C)C(=O)O"), (3, 0, "CCO"), (4, 0, "C(")]
    candidates = spark.createDataFrame(rows, "id long, n int, x string")
    key = keys(spark, ["N[C@@H](C)C(=O)O"])["N[C@@H](C)C(=O)O"]
    expected = spark.createDataFrame([(i, *key) for i in (1, 2, 3, 4, 5)], "id long, full_key string, connectivity_key string")
    got = {r.id: (r.notation, r.via) for r in S.verified(expected, candidates, "id", "n", "x").collect()}
    assert got == {1: ("OC(=O)[C@@H](N)C", "full"), 2: ("N[C@H](C)C(=O)O", "planar"), 3: (None, "mismatch"), 4: (None, "none"), 5: (None, "none")}


def test_verification_is_dealt_by_rows_not_by_packed_bytes(spark, monkeypatch):
    """Neither side of its join is sent whole, and a task gets a bounded number of rows, however small they pack."""
    monkeypatch.setattr(S, "MOST_ROWS", 100, raising=False)
    expected = S.structure_keys(spark.createDataFrame([("CCO",)], "x string"), "x").drop("notation").crossJoin(spark.range(2000).withColumnRenamed("id", "k"))
    candidates = spark.range(2000).selectExpr("id as k", "1 as n", "if(id % 2 = 0, 'OCC', 'CCC') as x")
    got = S.verified(expected, candidates, "k", "n", "x")
    sizes = got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 2000 and max(sizes) < 400, sizes
    assert {(r.k % 2, r.notation, r.via) for r in got.collect()} == {(0, "OCC", "full"), (1, None, "mismatch")}
