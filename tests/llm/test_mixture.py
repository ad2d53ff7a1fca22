import duckdb
import pytest

from florispark.llm import mixture

SCHEMA = "doc_id long, text string, source string, copies int, size string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x") for i, t, s in rows], SCHEMA)


def rows_of(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), "abc"[i % 3] if i % 5 else "a") for i in range(400)]
    rows += [(None, "no id here", "b"), (None, "no id here", "b"), (500, None, "a"), (501, "", None), (502, "x " * 3000, "c"), (503, "one two", None), (503, "one two", None), (504, " \t\n", "only blanks")]
    return rows


def test_targets_are_filled_by_weight(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 900), ("", 90), ("\U0001f600", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixture.targets(sizes, (5, 2, 1), 1.5, 2).collect()}
    # in order: '' 5, a 2, b 1, c 5, emoji 2, null 1; '', a, c and the emoji stop at twice their size
    assert got[""] == 180 and got["a"] == 200 and got["c"] == 20 and got["\U0001f600"] == 0
    assert got["b"] == got[None] == (1.5 * 2100 - 400) / 2
    nothing = mixture.targets(sizes.withColumn("source_size", sizes.source_size * 0), (5, 2, 1), 1.5, 2)
    assert {r.target for r in nothing.collect()} == {0.0}
    assert mixture.targets(sizes.where("false"), (5, 2, 1), 1.5, 2).count() == 0


def test_mix_against_sql_and_its_own_rules(spark):
    rows = rows_of(spark)
    got = mixture.words_taken(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    per = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        per.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), all_ in per.items():
        assert sum(r.size for r in all_) == size
        assert abs(sum(r.taken for r in all_) - target) <= max(r.size for r in all_)
    assert sum(t for _, t in per) == pytest.approx(1.5 * sum(s for s, _ in per))
    # rows with one id each are as SQL has them
    unique = [r for r in rows if r[0] is not None and r[0] != 503]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", unique)
    want = sorted(con.execute(mixture.ORACLE).fetchall())
    assert sorted(map(tuple, mixture.words_taken(frame(spark, unique)).collect())) == want
    assert mixture.words_taken(frame(spark, rows).where("false")).count() == 0


def test_partitions_don_t_matter_but_the_seed_does(spark):
    df = frame(spark, rows_of(spark))
    a = sorted(map(str, mixture.words_taken(df.repartition(1)).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        b = sorted(map(str, mixture.words_taken(df.repartition(9)).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b
    assert a != sorted(map(str, mixture.words_taken(df, seed=1).collect()))


def test_rows_are_emitted_as_often_as_they_are_taken(spark):
    df = frame(spark, rows_of(spark)).drop("copies").withColumnRenamed("size", "copies")
    want = {}
    for r in mixture.plan(df).collect():
        want[r.doc_id, r.source] = want.get((r.doc_id, r.source), 0) + r.copies
    got = {}
    for r in mixture.mix(df).collect():
        got.setdefault((r.doc_id, r.source), []).append(r.copy)
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(1, n + 1)) for k, n in want.items() if n}
    with pytest.raises(ValueError):
        mixture.mix(df, copy_col="copies")
