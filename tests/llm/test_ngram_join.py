import random
import re

import numpy as np
import pyarrow as pa
import pytest

from florispark.llm import ngram_join
from florispark.llm.common import components, shingles, word_chunks


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, k=3, percent=90):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((find(ids[x]), find(ids[y])))
                comp[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n, size):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 6))) for _ in range(300)]
    out = {}
    while len(out) < n:
        base = rng.choices(vocab, k=rng.randrange(1, size))
        for _ in range(rng.choice([1, 1, 2, 9, 40])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(base) // 20])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            if rng.random() < 0.2:
                copy = copy[: rng.randrange(1, len(copy) + 1)]
            out[len(out)] = rng.choice([" ", "\n", " \t"]).join(copy).title() if rng.random() < 0.3 else " ".join(copy)
    return out


def run(spark, texts, **args):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in texts.items()], "doc_id long, text string, family int, component_id string")
    rows = ngram_join.ngram_jaccard_components(df, **args).collect()
    assert len(rows) == len(texts)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_components_are_those_of_brute_force(spark):
    texts = corpus(1, 350, 160) | {900: None, 901: "", 902: " \n", 903: "One", 904: "one", 905: "one two", 906: "a b c a b c a b c", 907: "a b c a b c"}
    assert run(spark, texts) == brute(texts)


def test_families_of_many_tiles_and_other_thresholds(spark):
    texts = corpus(2, 260, 60)
    for percent, k in ((80, 5), (100, 2)):
        for tile in (2, 5, 1000):  # with and without contraction
            assert run(spark, texts, percent=percent, k=k, tile=tile) == brute(texts, k, percent)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.ngram_jaccard_components(empty).count() == 0
    rows = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (5, "a b c d")], "doc_id long, text string")
    got = sorted(ngram_join.ngram_jaccard_components(rows).collect(), key=str)
    assert [(r.doc_id, r.component_id) for r in got].count((1, 1)) == 2
    assert (5, 1) in [(r.doc_id, r.component_id) for r in got] and (None, None) in [(r.doc_id, r.component_id) for r in got]


@pytest.mark.parametrize("percent", [80, 90])
def test_keys_lose_no_pair(percent):
    """Small sets, where groups are often empty: every linked pair shares a key."""
    rng, linked = np.random.default_rng(3), 0
    for n in list(range(1, 60)) * 6 + [100, 300, 1000, 5000] * 3:
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = rng.integers(0, 1 + n * (100 - percent) // (100 + percent) + 1)
        b = np.unique(np.concatenate((a[drop:], rng.integers(0, 2**63, rng.integers(0, drop + 1)).astype(np.uint64))))
        if not len(b) or 100 * len(np.intersect1d(a, b)) < percent * len(np.union1d(a, b)):
            continue
        linked += 1
        keys, text = ngram_join.keys_of(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), percent)
        assert np.intersect1d(keys[text == 0], keys[text == 1]).size
        assert len(keys) < 40 + 7 * (len(a) + len(b)) * (100 - percent) // 100
    assert linked > 150


def test_shingles_of_a_chunk_don_t_cross_texts():
    texts = ["a b", "c d e f", None, "", "A B", "x\ty\nz w"]
    got = []
    for w in word_chunks(pa.array(texts), lower=True, chunk_bytes=8):
        s, b = shingles(w, 3)
        got += [s[x:y].tolist() for x, y in zip(b[:-1], b[1:])]
    assert [len(x) for x in got] == [1, 2, 0, 0, 1, 2] and got[0] == got[4]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_a_family_of_near_copies_costs_rows_not_pairs(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = {}
    for i in range(3000):
        x = list(base)
        x[rng.randrange(len(x))] = f"n{i}"
        texts[i] = " ".join(x)
    texts[3000] = " ".join(base[:139] + [f"z{i}" for i in range(11)])  # links with few of them
    got, rows = counted(spark, texts, monkeypatch)
    assert {c for i, (_, c) in got.items() if i < 3000} == {0}
    assert rows["hubs"] < 2 * 3000 and rows["tiles"] < 4 * 3000


def counted(spark, texts, monkeypatch):
    """The result, and how many rows were made for hubs and for tiles of large families."""
    rows = {"hubs": 0, "tiles": 0}
    by_hubs, by_keys = ngram_join._by_hubs, ngram_join._by_keys

    def hubs(sets, shared, *rest):
        rows["hubs"] += shared.count()
        return by_hubs(sets, shared, *rest)

    def keys(*args):
        out = by_keys(*args)
        rows["tiles"] += out.count()
        return out

    monkeypatch.setattr(ngram_join, "_by_hubs", hubs)
    monkeypatch.setattr(ngram_join, "_by_keys", keys)
    return run(spark, texts, tile=64), rows


def test_texts_that_drift_cost_rows_not_pairs(spark, monkeypatch):
    """Each text has two new words and is without the two oldest ones: all are one component, but only neighbours link."""
    per = {}
    for n in (500, 2000):
        texts = {i: " ".join(f"w{j}" for j in range(2 * i, 2 * i + 120)) for i in range(n)}
        got, rows = counted(spark, texts, monkeypatch)
        monkeypatch.undo()
        assert {c for _, c in got.values()} == {0}
        per[n] = (rows["hubs"] + rows["tiles"]) / n
    assert per[2000] < 1.2 * per[500] and per[2000] < 60


def test_very_long_texts(spark):
    a = [f"w{i}" for i in range(120_000)]
    texts = {1: " ".join(a), 2: " ".join(a[:118_000]), 3: " ".join(a[:60_000]), 4: "x " * 100_000, 5: "X x x"}
    got = run(spark, texts)
    assert got[1] == (119_998, 1) and got[2][1] == 1 and got[3][1] == 3 and got[4] == (1, 4) and got[5] == (1, 4)


def test_edges_are_contracted_in_parts(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from florispark.llm import common

    monkeypatch.setattr(common, "CONTRACTED_EDGES", 40)
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 300, (2, 200))
    keep = a != b
    a, b = np.maximum(a, b)[keep], np.minimum(a, b)[keep]
    parts = [pa.RecordBatch.from_arrays([pa.array(a[i : i + 16]), pa.array(b[i : i + 16])], names=["a", "b"]) for i in range(0, len(a), 16)]
    made = list(common._contracted(iter(parts)))
    assert len(made) > 1
    x, y = (np.concatenate([r.column(i).to_numpy() for r in made]) for i in (0, 1))
    assert (x > y).all()
    whole, again = common.smallest_connected(a, b), common.smallest_connected(x, y)
    assert np.array_equal(whole[0], again[0]) and np.array_equal(whole[1], again[1])
    for nodes, low in [common.smallest_connected(np.arange(1, 5000), np.arange(4999))]:
        assert len(nodes) == 4999 and not low.any()


def test_components_of_more_edges_than_one_task_contracts(spark, monkeypatch):
    from florispark.llm import common

    pairs = [(i, i + 1) for i in range(40)] + [(100, 101)]
    made = []
    stored = common.stored
    monkeypatch.setattr(common, "stored", lambda *args: made.append(args) or stored(*args))
    for most in (common.CONTRACTED_EDGES, 3):
        made.clear()
        monkeypatch.setattr(common, "CONTRACTED_EDGES", most)
        got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(8)).collect()}
        assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
        assert ("Exchange" in made[1][0]._jdf.queryExecution().toString()) == (most == 3)  # few edges end in one task


def test_bitmaps_pass_all_links_and_name_what_meets_once():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, int(rng.integers(1, 6000)), dtype=np.uint64)) for _ in range(40)]
    sets += [np.unique(np.concatenate((x[rng.random(len(x)) < 0.93], rng.integers(0, 2**63, len(x) // 30, dtype=np.uint64)))) for x in sets if len(x) > 1]
    sets += [rng.integers(0, 2**63, size, dtype=np.uint64) for size in (3, 700, 5000)]  # link with none
    sets = [np.unique(x) for x in sets]
    n, bounds = np.array([len(x) for x in sets]), np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    maps = ngram_join.packed(np.concatenate(sets), bounds)
    for percent in (80, 90):
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if ngram_join.links(sets[i], sets[j], percent)]
        assert percent == 90 or len(pairs) > 25
        assert all(ngram_join.may_link(n[i], maps[i], n[j], maps[j], percent) for i, j in pairs)
        group = ngram_join.likely(n, maps, np.full(len(n), -1), np.arange(len(n)), percent)
        assert all(group[i] == group[j] >= 0 for i, j in pairs) and (group < 0).any()
        # of two blocks only pairs across count, and what is connected isn't asked again
        side = np.arange(len(n)) % 2
        across = ngram_join.likely(n, maps, side, np.arange(len(n)), percent)
        assert all(across[i] == across[j] >= 0 for i, j in pairs if side[i] != side[j])
        assert (ngram_join.likely(n, maps, side, np.zeros(len(n), int), percent) == -1).all()
    rows = [(r, r, -1, tile, 0, 0, int(n[r]), maps[r]) for tile in range(5) for r in range(len(sets))]
    batches = lambda size: [pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i : i + size]), [pa.int64()] * 7 + [pa.binary()])], names=[x.split()[0] for x in ngram_join._CARD.split(", ")]) for i in range(0, len(rows), size)]
    made = [{tuple(x.values()) for b in ngram_join._likely(iter(batches(size)), 80) for x in b.to_pylist()} for size in (7, 10_000)]
    assert made[0] == made[1] and len(made[0]) == np.count_nonzero(ngram_join.likely(n, maps, np.full(len(n), -1), np.arange(len(n)), 80) >= 0)


def test_keys_of_several_documents_are_marked():
    rng = np.random.default_rng(9)
    keys = rng.integers(0, 2**64, 500, dtype=np.uint64)
    ids = np.concatenate((np.arange(500), np.arange(200) + 1000, np.arange(10)))
    keys = np.concatenate((keys, keys[:200], keys[:10]))  # ten repeat their id as well
    distinct, smallest, _, _ = ngram_join.smallest_of_keys(keys, ids)
    several, other = ngram_join.others_of_keys(keys, ids, distinct, smallest)
    assert set(several.tolist()) == set(keys[:200].tolist()) and (other >= 1000).all()
    for buckets, bits in ((1, 16), (7, 16), (211, 20)):
        marked = np.zeros(2**bits // 8 + 1, np.uint8)
        for i in range(buckets):
            own = several[((several >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(int) == i]
            first, part = ngram_join.shared_bits(i, own, buckets, bits)
            marked[first : first + len(part)] |= np.frombuffer(part, np.uint8)[: len(marked) - first]
        assert set(np.flatnonzero(np.unpackbits(marked)).tolist()) == set((several >> np.uint64(64 - bits)).tolist())


def test_sets_move_once_for_what_may_link(spark, monkeypatch):
    """Texts that share common passages but don't link: their keys meet in many tiles, to which only bitmaps are dealt."""
    rng = random.Random(8)
    common = [" ".join(f"p{i}_{j}" for j in range(12)) for i in range(60)]
    texts = {i: " ".join(rng.sample(common, 8) + [f"w{i}_{j}" for j in range(60)]) for i in range(400)}
    texts[400] = texts[7] + " more"
    rows = {}
    kept = ngram_join.kept
    monkeypatch.setattr(ngram_join, "kept", lambda df, name: rows.setdefault(name, kept(df, name)))
    got = run(spark, texts, tile=16, percent=60)
    assert got[400][1] == 7 and all(c == i for i, (_, c) in got.items() if i < 400)
    assert rows["keys-of-families"].count() > 400 and rows["sets-of-likely-links"].count() + rows["sets-of-hubs"].count() < 20
