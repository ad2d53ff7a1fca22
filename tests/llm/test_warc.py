import hashlib

from florispark.llm import warc
from florispark.llm.common import work_dir


def pages(spark):
    long = "<p>é " + "x" * 5000
    rows = [(5, "http://a/ b", long), (3, None, long), (9, "http://c", "short"), (2, "u", "short"), (1, "u", None), (4, "u", ""), (None, "u", long), (None, "u", "y" * 100), (7, "u\r\nX: y", "y" * 99), (8, "u", "y" * 99)]
    rows += [(3, None, long)] + [(100 + i, f"http://h/{i}", "z" * 300 + str(i // 10)) for i in range(50)]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record_type string"), rows


def test_round_trip(spark):
    df, rows = pages(spark)
    manifest = warc.write_archives(df, work_dir(spark, "warc"), frame_bytes=2000, bundle_bytes=3000)
    assert manifest.select("bundle").distinct().count() > 1
    got = [tuple(r) for r in warc.read_archives(manifest).collect()]
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(i, first.get(html, i))
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = first.get(html) if len(data) >= 100 and first.get(html) not in (None, i) else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert sorted(got, key=str) == sorted(want, key=str)
    fields, payload = warc.read_record(manifest, 9)[0]
    assert payload == b"short" and fields["WARC-Target-URI"] == "http://c"
    assert warc.read_record(manifest, 5)[0][0]["WARC-Refers-To"] == "<urn:page:3>"


def test_the_manifest_stays_beside_the_bundles(spark):
    df, rows = pages(spark)
    folder = work_dir(spark, "warc")
    warc.write_archives(df, folder)
    manifest = spark.read.parquet(f"{folder}/manifest")
    assert warc.read_archives(manifest).count() == len(rows)
    ids = [warc.parse(warc.BundleReader(open_file(r.bundle)).frame(r.frame)[r.start : r.start + r.length])[0]["WARC-Record-ID"] for r in manifest.where("page_id is null").collect()]
    assert len(set(ids)) == 2 and all(x.startswith("<urn:uuid:") for x in ids)
    first = warc.BundleReader(open_file(manifest.first().bundle)).frame(0)
    assert b"WARC-Type: warcinfo" in first[:60]


def open_file(uri):
    store, path = warc._storage(uri)
    return store.open_input_file(path)


def test_a_bundle_is_plain_zstandard(spark):
    import zstandard

    df, _ = pages(spark)
    row = warc.write_archives(df, work_dir(spark, "warc"), frame_bytes=500).first()
    with open(row.bundle.removeprefix("file://"), "rb") as f:
        data = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert data.startswith(b"WARC/1.1\r\n")


def test_no_pages(spark):
    df, _ = pages(spark)
    assert warc.archive_round_trip(spark, df.where("false")).count() == 0
