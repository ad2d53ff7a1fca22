import gzip
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from florispark.sources import fetching, notes, readers, sinks
from florispark.sources.versions import VersionedTable
from florispark.streaming.incremental import load_decisions, load_new


def test_validated_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿No,Ph. Eur. Name,Text\n1, x ,"two\nlines ""q"""\n2,,  \n'.encode())
    df = readers.csv_validated(spark, str(tmp_path / "a.csv"), {"No": "no", "Ph. Eur. Name": "name", "Text": "text"}, keep_blank=["name"])
    assert [tuple(r) for r in df.collect()] == [("1", "x", 'two\nlines "q"'), ("2", "", None)]
    with pytest.raises(ValueError, match="Missing"):
        readers.csv_validated(spark, str(tmp_path / "a.csv"), {"Missing": "x"})


def test_globs_gzip_and_numbers(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"annex_{i}.csv").write_text(f"a,b\n{i},\n{i},x\n")
    df = readers.numbered(readers.csv_strings(spark, str(tmp_path / "annex_*.csv")), ["a"])
    assert sorted((r.a, r.entry_seq, r.b) for r in df.collect()) == [("1", 1, None), ("1", 2, "x"), ("2", 1, None), ("2", 2, "x")]
    (tmp_path / "t.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n"))
    assert readers.csv_strings(spark, str(tmp_path / "t.csv.gz")).first().b == "2"
    assert readers.vocabulary(spark, str(tmp_path / "none.csv"), "token", "part").count() == 0


def test_json_cache_and_ontology(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"n": {"rank": "S", "ok": True}, "m": {"rank": None, "ok": False}}))
    got = {r.name: (r.record.rank, r.record.ok) for r in readers.json_cache(spark, str(tmp_path / "c.json"), "struct<rank:string,ok:boolean>").collect()}
    assert got == {"n": ("S", True), "m": (None, False)}
    text = 'format-version: 1.2\n\n[Term]\nid: C:1\nname: one\ndef: "a \\"b\\" c" []\nis_a: C:2 ! two\nis_a: C:3\nrelationship: has_role C:9\n\n[Term]\nid: C:2\nname: two\nis_obsolete: true\n\n[Term]\nid: C:3\nname: three\n\n[Typedef]\nid: has_role\nname: has role\n'
    (tmp_path / "o.obo.gz").write_bytes(gzip.compress(text.encode()))
    got = {r.id: r for r in readers.obo(spark, str(tmp_path / "o.obo.gz")).collect()}
    assert set(got) == {"C:1", "C:3"}
    assert got["C:1"].parents == ["C:2", "C:3"] and got["C:1"].roles == ["C:9"] and got["C:1"].definition == 'a \\"b\\" c'
    assert got["C:3"].name == "three" and got["C:3"].parents == []


class Api:
    rows = [f"{i:03d}" for i in range(250)]

    def of(self, prefix):
        return [x for x in self.rows if x.startswith(prefix)]

    def count(self, prefix):
        return len(self.of(prefix))

    def page(self, prefix, number, size):
        return [(x, "p" + x) for x in self.of(prefix)[number * size : (number + 1) * size]]


def test_paged_source(spark):
    reader = readers.PagedReader(Api, most=60, size=7, alphabet="0123456789")
    parts = reader.partitions()
    assert [p.prefix for p in parts][:3] == ["00", "01", "02"] and all(p.total <= 60 for p in parts)
    rows = [r for p in parts for r in reader.read(p)]
    df = spark.createDataFrame(rows, "id string, payload string")
    assert readers.reconciled(df, "id", 250).count() == 250
    with pytest.raises(ValueError):
        readers.reconciled(df, "id", 251)
    cache = spark.createDataFrame([("001", "old")], "id string, payload string")
    got = readers.enrich(df.where("id < '003'"), cache, "id", lambda k: k.withColumn("payload", F.lit("new")))
    assert {r.id: r.payload for r in got.collect()} == {"000": "new", "001": "old", "002": "new"}


def test_chunks_and_findings(spark, tmp_path):
    df = spark.createDataFrame([("Rosa", 1, None), ("rumex", 2, "x"), ("Abies", 3, "y")], "name string, n int, re string")
    sinks.write_chunks(df, "name", ["n", "re"], str(tmp_path / "c"))
    got = {r.name: (r.json, r.chunk) for r in spark.read.json(str(tmp_path / "c")).collect()}
    assert got == {"Rosa": ('{"n":1}', "ro"), "rumex": ('{"n":2,"re":"x"}', "ru"), "Abies": ('{"n":3,"re":"y"}', "ab")}
    assert "| Abies | 3 | y |" in sinks.finding("T", df.orderBy("name"))
    sinks.write_csv(df, str(tmp_path / "csv"), ["name"])
    assert [r.name for r in spark.read.csv(str(tmp_path / "csv"), header=True).collect()] == ["Abies", "Rosa", "rumex"]


def test_incremental_load_adds_each_key_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = "k int, v string"
    for rows in ([(1, "a"), (2, "b")], [(2, "again"), (3, "c")]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        q = load_new(spark, src, schema, out, cp, "k")
        assert q.awaitTermination(60)
    assert sorted((r.k, r.v) for r in VersionedTable(spark, out).read().collect()) == [(1, "a"), (2, "b"), (3, "c")]
    # a batch whose version is there adds nothing when it is tried again
    assert VersionedTable(spark, out).append(spark.createDataFrame([(9, "z")], schema), batch=(cp, 1)) == VersionedTable(spark, out).version()
    assert VersionedTable(spark, out).read().count() == 3


def test_machines_never_replace_decisions(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = "k int, v string, n int, person boolean"
    for rows in ([(1, "a", 1, False), (2, "b", 1, True), (None, "x", 1, False), (3, "c", 1, False)], [(1, "a2", 2, False), (2, "b2", 2, False), (3, "c2", 2, True), (3, "c3", 3, False)], [(3, None, 4, True), (2, "b3", 3, False), (1, "a0", 0, False), (4, "d", 3, False)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        assert load_decisions(spark, src, schema, out, cp, "k", "n", "person").awaitTermination(60)
    assert sorted((r.k, r.v) for r in VersionedTable(spark, out).read().collect()) == [(1, "a2"), (2, "b"), (3, None), (4, "d")]


def test_notes_keep_their_tails(spark, tmp_path):
    path = str(tmp_path / "notes")
    rows = lambda n, extra=(): spark.createDataFrame([(x, f"v: {n}", f"body {n}", f"\ntail {n} {x}") for x in ("Rosa canina", "a+b", *extra)], "name string, frontmatter string, body string, tail string")
    notes.write_notes(rows(1), path)
    (tmp_path / "notes" / "Rosa canina.md").write_text((tmp_path / "notes" / "Rosa canina.md").read_text() + "\nmine, with <!-- AUTO-END --> in it")
    (tmp_path / "notes" / "other.md").write_text("no marker")
    notes.write_notes(rows(2, ["new", "other"]), path)
    got = {r.name: r.text for r in notes.read_notes(spark, path).collect()}
    head = "---\nv: 2\n---\n\n<!-- AUTO-START -->\n\nbody 2\n\n<!-- AUTO-END -->"
    assert got == {"Rosa canina": head + "\ntail 1 Rosa canina\nmine, with <!-- AUTO-END --> in it", "a+b": head + "\ntail 1 a+b", "new": head + "\ntail 2 new", "other": head + "\ntail 2 other"}
    # a task that fails leaves no file, and old notes as they were
    with pytest.raises(Exception, match="not a name"):
        notes.write_notes(rows(3, ["fresh", "../up"]), path)
    assert {r.name: r.text for r in notes.read_notes(spark, path).collect()} == got and not [x for x in (tmp_path / "notes").iterdir() if x.is_dir()]


class Counting(Api):
    """Notes each page that is asked for, and dies when it is told to."""

    pointer = os.path.join(tempfile.gettempdir(), f"florispark-counting-{os.getuid()}")  # read in other processes

    def page(self, prefix, number, size):
        self.folder = open(self.pointer).read()
        with open(f"{self.folder}/asked", "a") as f:
            f.write(f"{prefix}-{number}\n")
        if number == 1 and prefix == "1" and not os.path.exists(f"{self.folder}/well"):
            raise OSError("gone away")
        return super().page(prefix, number, size)


class CountingStream(fetching.PagedStream):
    clients = {"api": Counting}

    @classmethod
    def name(cls):
        return "counting_stream"


def test_a_fetch_is_taken_up_where_it_broke_off(spark, tmp_path):
    with open(Counting.pointer, "w") as f:
        f.write(str(tmp_path))
    spark.dataSource.register(CountingStream)

    def start():
        stream = spark.readStream.format("counting_stream").options(client="api", store=str(tmp_path / "store"), most="100", size="30", rate="1000", tasks="2", pages_per_batch="3").load()
        return stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).start(str(tmp_path / "out"))

    q = start()
    with pytest.raises(Exception, match="gone away"):
        q.processAllAvailable()
    (tmp_path / "well").write_text("")
    q = start()
    q.processAllAvailable()
    q.stop()
    got = sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [f"{i:03d}" for i in range(250)]
    asked = (tmp_path / "asked").read_text().split()
    again = [p for p in set(asked) if asked.count(p) > 1]
    assert again == ["1-1"] and len(set(asked)) == 10  # only the page at which it died


class Down:
    def fetch(self, keys):
        return None


def test_batches_that_never_come_are_an_error(spark):
    keys = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    with pytest.raises(Exception, match="no answer after 2 tries"):
        readers.fetch_batches(keys, "k", Down, tries=2, pause=0.0).collect()
    assert readers.fetch_batches(keys.where("false"), "k", Down).count() == 0


def test_snapshots(spark, tmp_path):
    def down():
        raise OSError("unreachable")

    with pytest.raises(OSError):
        readers.snapshot(spark, str(tmp_path / "a"), down)
    assert readers.snapshot(spark, str(tmp_path / "a"), down, optional=True) is None
    for n, days, want in ((1, 7, 1), (2, 7, 1), (3, -1, 3)):  # fetched, kept, fetched again
        got = readers.snapshot(spark, str(tmp_path / "a"), lambda n=n: spark.createDataFrame([(n,)], "n int"), days)
        assert [r.n for r in got.collect()] == [want]


def test_bindings_and_caches(spark, tmp_path):
    rows = [("k1", "en", "Rose", "L"), ("k1", "en", "Rose", "L"), ("k1", "en", "Alba", "L"), ("k1", "zh", None, "L"), ("k2", "zh", "x", None)]
    df = spark.createDataFrame(rows, "k string, lang string, name string, label string")
    got = {r.k: (r["values"], r.label) for r in readers.group_bindings(df, "k", "lang", "name", "label").collect()}
    assert got == {"k1": ({"en": ["Alba", "Rose"]}, "L"), "k2": ({"zh": ["x"]}, None)}
    sinks.write_json_cache(df.dropDuplicates(["k"]).select("k", "lang"), "k", ["lang"], str(tmp_path / "c"))
    assert readers.json_cache(spark, str(tmp_path / "c"), "struct<lang:string>").count() == 2


def test_paged_api_of_more_than_a_million_ids():
    """Every id has a page, whatever its length, and tasks that read several buckets read each row once."""
    from florispark.plans.storage import Shop

    for most in (1_000_000, 1_000_123):
        reader = readers.PagedReader(lambda most=most: Shop(most), most=300_000, size=50_000, alphabet="0123456789", rows_per_task=400_000)
        parts = reader.partitions()
        assert len(parts) < len(reader.buckets())
        got = [r[0] for p in parts for r in reader.read(p)]
        assert len(got) == len(set(got)) == most and {int(x) for x in got} == set(range(most))


def test_plan_of_a_stream_has_more_than_a_million_ids(tmp_path):
    from florispark.plans.storage import Shop
    from florispark.sources.fetching import PagedStreamReader

    reader = PagedStreamReader(lambda: Shop(1_000_500), {"store": f"file://{tmp_path}/store", "size": "500"})
    end = reader.latestOffset()
    reader.batch = 10_000
    end = reader.latestOffset()
    got = sum(1 for p in reader.partitions({"pages": end["pages"] - 40}, end) for _ in reader.read(p))
    assert end["pages"] == 2001 and got == 40 * 500


def test_what_is_known_of_keys_is_kept_by_aggregation(spark, tmp_path):
    """Of rows alike in order the greatest of a batch stays, or the first; a later batch's equal rank replaces; unchanged keys leave no row."""
    src, schema = str(tmp_path / "src"), "k int, v string, n int, person boolean"
    batches = [[(1, "b", 1, False), (1, "a", 1, False), (2, "x", 5, True), (3, None, 1, False), (3, "z", 1, None)], [(1, "a0", 1, False), (2, "y", 9, False), (3, "zz", 0, False), (4, "d", None, False)]]
    put = {}
    for name, load in (("once", lambda t: load_new(spark, src, schema, t, t + "-cp", "k", "n")), ("all", lambda t: load_decisions(spark, src, schema, t, t + "-cp", "k", "n", "person"))):
        src = str(tmp_path / f"src-{name}")
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
            q = load(str(tmp_path / name))
            assert q.awaitTermination(60)
            states = [s for p in q.recentProgress for s in p["stateOperators"]]
            assert states and all(s["operatorName"] == "stateStoreSave" for s in states)
        put[name] = sorted((r.k, r.v) for r in VersionedTable(spark, str(tmp_path / name)).read().collect())
    assert put["once"] == [(1, "a"), (2, "x"), (3, "z"), (4, "d")]
    assert put["all"] == [(1, "a0"), (2, "x"), (3, None), (4, "d")]
