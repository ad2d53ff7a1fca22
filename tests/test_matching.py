import random
import re

import pytest
from pyspark.sql import functions as F

from florispark.operators import dictionary, relational, serving
from florispark.operators.search_index import BLOCK, SearchIndex
from florispark.session import shared_folder
from florispark.sources.versions import CheckFailed, VersionedTable

VOCAB = [("oil", "process", "oil", True), ("seed oil", "part", "seed", True), ("seed", "part", "seed", True), ("seed", "category", "grain", True), ("pre", "prefix", "p", False), ("oil press", "process", "press", True), ("(raw)", "mark", "raw", True), ("", "none", "none", True)]


def brute(text, longest):
    out = []
    for entry, kind, value, whole in VOCAB:
        if entry:
            for m in re.finditer(f"(?={re.escape(entry)})", text):
                s, e = m.start(), m.start() + len(entry)
                bound = lambda i: i in (0, len(text)) or not (re.match(r"\w", text[i - 1]) and re.match(r"\w", text[i]))
                if bound(s) and (not whole or bound(e)):
                    out.append((s, -e, kind, value, entry))
    out.sort()
    kept, at = [], 0
    for m in out:
        if not longest or m[0] >= at or kept and m[:2] == kept[-1][:2]:
            kept.append(m)
            at = max(at, -m[1])
    return [(s, -e, entry, kind, value) for s, e, kind, value, entry in kept]


def test_dictionary_holds_the_matches_of_few_texts():
    import pyarrow as pa

    texts = ["rosa " * 20_000, None, "", *(f"rosa {i}" for i in range(5000)), "é rosa " * 60_000, "rosa"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["n", "text"])
    entries = [("rosa", "part", "x", True)]
    got = list(dictionary._matched(iter([batch.slice(1), batch.slice(0, 0), batch.slice(0, 1)]), 1, entries, False, False, "m"))
    assert [x for b in got for x in b.column(0).to_pylist()] == [*range(1, len(texts)), 0]
    assert [len(x) for b in got for x in b.column(2).to_pylist()] == [0, 0, *[1] * 5000, 60_000, 1, 20_000]
    assert all(b.num_rows == 1 or sum(len((x or "").encode()) for x in b.column(1).to_pylist()) <= dictionary.TEXT_BYTES for b in got)


@pytest.mark.parametrize("bound, longest", [(1 << 20, True), (1 << 20, False), (150, True), (150, False)])
def test_dictionary_against_brute_force(spark, bound, longest):
    rng = random.Random(1)
    words = ["seed", "oil", "press", "seeds", "prepare", "pre", "(raw)", "oilseed", "été", "x_oil", "seed oil", "oil press"]
    texts = [None, "", "seed oil press", *("".join(rng.choice(words) + rng.choice([" ", "-", "", "  "]) for _ in range(12)) for _ in range(60))]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id int, text string, kind string")
    v = spark.createDataFrame(VOCAB, "entry string, kind string, value string, whole boolean")
    for r in dictionary.matches(df, "text", v, longest=longest, most_bytes=bound).collect():
        got = [(m.start, m.end, m.entry, m.kind, m.value) for m in r.matches]
        assert sorted(got) == sorted(brute(r.text or "", longest)) and r.kind == "kept", r.text
    assert dictionary.matches(df, "text", v.where("false")).where("size(matches) > 0").count() == 0


def test_index_gives_what_the_scans_give(spark):
    rng = random.Random(2)
    words = ["rosa", "Rosa", "alba", "oil", "Öl", "straße", "STRASSE", "x", "yy", "canina", "of", "leaf"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 4]))), rng.choice(["Fam a", "Fam b", None]), rng.choice([None, "II/1"]), [rng.choice(["red", "blue"])]) for i in range(3 * BLOCK)]
    items = spark.createDataFrame(rows, "ref_no long, name string, family string, restriction string, functions array<string>")
    index = SearchIndex.build(items, ["family"], shared_folder(spark, "index"))
    for text in ("rosa", "a", "fam B", "oil of", "Straße", "zzz", "ROSA ALBA", ""):
        for more in ({}, {"limit": 3}, {"function": "RED", "family": "fam a", "restricted_only": True}, {"family": "no such"}):
            a, b = (sorted((r.ref_no, r.score) for r in f(text, ["family"], **more).collect()) for f in (lambda *x, **y: serving.search(items, *x, **y), index.search))
            assert a == b, (text, more)
    labels = spark.createDataFrame(list(enumerate(["rosa", "Rosa canina of the leaf oil", " strasse", "nothing", "", "y", "rosaalba", "a x b"])), "position long, label string")
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert key(index.match_list(labels)) == key(serving.match_list(labels, items))
    empty = SearchIndex.build(items.where("false"), ["family"], shared_folder(spark, "index"))
    assert empty.search("rosa", ["family"]).count() == 0 and empty.match_list(labels).where("ref_no is not null").count() == 0


def test_a_search_reads_few_rows(spark):
    items = spark.range(60_000).selectExpr("id as ref_no", "concat('name ', cast(id as string)) as name", "'f' as family")
    index = SearchIndex.build(items, [], shared_folder(spark, "index"))
    at = index._with_all("name 31415", 0, 10**6)
    assert [r._place for r in at.collect()] and at.count() < 60
    scan = index.postings.where("gram = '314'")
    scan.collect()
    read = scan._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    assert read < index.postings.count() / 4
    assert [r.name for r in index.search("name 31415", []).collect()] == ["name 31415"]


def test_sketches_merge(spark):
    df = spark.range(20_000).selectExpr("cast(id % 5000 as string) as a", "case when id % 4 = 0 then null when id % 4 = 1 then ' ' else repeat('x', cast(id % 9 as int)) end as b", "id % 3 as part")
    whole = {r.column: r for r in relational.merged(relational.sketches(df, ["a", "b"])).collect()}
    parts = {r.column: r for r in relational.merged(relational.sketches(df, ["a", "b"], [F.col("part")])).collect()}
    exact = {r.column: r for r in relational.profile(df, ["a", "b"]).collect()}
    for c in "ab":
        for r in (whole[c], parts[c]):
            assert (r.rows, r.blank, r.longest) == (exact[c].rows, exact[c].blank, exact[c].longest)
            assert abs(r.distinct_values - exact[c].distinct_values) <= 0.03 * exact[c].distinct_values
    assert parts["a"].median_length in (3, 4)
    assert relational.merged(relational.sketches(df.where("false"), ["a"])).first().median_length is None


def test_failed_checks_stop_the_commit(spark):
    t = VersionedTable(spark, shared_folder(spark, "checked"))
    rule = {"rows": (F.count("*"), lambda n: n == 100), "most": (F.max("id"), lambda n: n == 99)}
    assert t.replace_checked(spark.range(100), rule, ["id"]) == {"rows": (True, 100), "most": (True, 99)}
    with pytest.raises(CheckFailed, match="rows: 50"):
        t.replace_checked(spark.range(50), rule)
    assert t.version() == 0 and t.read().count() == 100
