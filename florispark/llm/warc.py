"""WARC archives as seekable Zstandard bundles.

Each task writes its records into bundles.  Records are gathered into frames of about a megabyte,
each compressed on its own; a bundle ends in a skippable frame that holds the seek table (the
public seekable Zstandard layout: sizes of every frame, packed and unpacked).  The manifest maps
each record to bundle, frame and its offset within the unpacked frame, so one record costs one
frame.  Bundles are named by task attempt: a retried task writes files of its own, and only the
attempt that ended well is in the manifest, which is a Parquet table beside the bundles, so that
archives keep their index.  Every bundle begins with a warcinfo record.

Of records with equal payloads of at least min_revisit bytes, that with the smallest page id is a
response and the others are revisits without payload.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, work_dir

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
# fixed values of the formats
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "page_id long, bundle string, frame int, start long, length long"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _storage(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def info(name: str, date: str) -> bytes:
    """The warcinfo record of a bundle."""
    block = b"software: florispark\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Date: {date}", f"WARC-Record-ID: {unique(name)}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def unique(place: str) -> str:
    """A record id made from where the record is."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(place.encode()).digest()[:16], version=4)}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str, place: str) -> bytes:
    """One WARC record with its closing blank lines; its id is that of its page, or, for a page without one, made from `place`."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {date}"]
    head.append(f"WARC-Record-ID: {unique(place) if page_id is None else f'<urn:page:{page_id}>'}")
    if url:
        head.append("WARC-Target-URI: " + "".join(x if x > " " else "%20" for x in url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    block = HTTP.format(len(payload)).encode() + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


class BundleWriter:
    """Frames, and at the end the seek table, into one open stream."""

    def __init__(self, out, frame_bytes: int):
        self.out, self.frame_bytes = out, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        self.buffer, self.held, self.frames, self.written = [], 0, [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        """The record's frame and its offset there."""
        if self.held and self.held + len(data) > self.frame_bytes:
            self.flush()
        place = len(self.frames), self.held
        self.buffer.append(data)
        self.held += len(data)
        return place

    def flush(self) -> None:
        if self.held:
            packed = self.pack(b"".join(self.buffer))
            self.out.write(packed)
            self.frames.append((len(packed), self.held))
            self.written += len(packed)
            self.buffer, self.held = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Frames of a bundle by number, through its seek table."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        frames, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        table = file.read_at(8 * frames, size - 9 - 8 * frames)
        self.sizes = [struct.unpack_from("<II", table, 8 * i) for i in range(frames)]
        self.at = [0]
        for packed, _ in self.sizes:
            self.at.append(self.at[-1] + packed)

    def frame(self, i: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(self.sizes[i][0], self.at[i]), max_output_size=self.sizes[i][1])


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 100, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes bundles into folder, a URI that driver and executors share, and the manifest beside them; returns the manifest.

    Null html is an empty payload.  A page without id is written; it can be a revisit but isn't
    referred to.  Repeated rows with one id are each a response, and their records have one id.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("html")).withColumn("digest", F.sha2("html", 256))
    first = (
        pages.select(F.col(id_col).cast("long").alias("page_id"), payload.alias("html"))
        .where(F.octet_length("html") >= min_revisit)
        .select("page_id", F.sha2("html", 256).alias("digest"))
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # cut, so that the join deals both sides anew and Spark can split the pages of a common payload
    rows = rows.join(cut(first), "digest", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    out = rows.select("page_id", "url", F.col("html").cast("binary").alias("html"), "digest", "refers_to").mapInArrow(lambda it: _write(it, folder, frame_bytes, bundle_bytes, date), MANIFEST)
    out.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _write(batches: Iterator[pa.RecordBatch], folder: str, frame_bytes: int, bundle_bytes: int, date: str) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    store, path = _storage(folder)
    store.create_dir(path, recursive=True)
    context, writer, made, name = TaskContext.get(), None, 0, ""
    for batch in batches:
        rows = []
        for page_id, url, html, digest, refers_to in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if writer is None:
                name = f"bundle-{context.partitionId():06d}-{context.taskAttemptId()}-{made}.warc.zst"
                writer, made = BundleWriter(store.open_output_stream(f"{path}/{name}", compression=None), frame_bytes), made + 1
                writer.add(info(name, date))
            data = record(page_id, url, html, digest, refers_to, date, f"{name}/{len(writer.frames)}/{writer.held}")
            frame, start = writer.add(data)
            rows.append((page_id, f"{folder}/{name}", frame, start, len(data)))
            if writer.written + writer.held >= bundle_bytes:
                writer.close()
                writer = None
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["page_id", "bundle", "frame", "start", "length"])
    if writer is not None:
        writer.close()


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records that the manifest names, read from the archives: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Every frame is read once for all of its records.  Digest and size are those of the payload that
    was read; a revisit has those of the record that it refers to, which must be in the manifest.
    """
    rows = cut(manifest.select("bundle", "frame", "start", "length").repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "start").mapInArrow(_read, _READ))
    full = rows.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("payload_digest")).agg(F.min("payload_bytes").alias("full_bytes"))
    revisits = rows.where("record_type = 'revisit'").join(full, ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.col("full_bytes"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return rows.where("record_type = 'response'").select(names).union(revisits.select(names))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name = frame = reader = None
    data = b""
    for batch in batches:
        rows = []
        for bundle, number, start, length in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if bundle != name:
                store, path = _storage(bundle)
                name, frame, reader = bundle, None, BundleReader(store.open_input_file(path))
            if number != frame:
                frame, data = number, reader.frame(number)
            fields, payload = parse(data[start : start + length])
            of = lambda key: int(x[len("<urn:page:") : -1]) if (x := fields.get(key, "")).startswith("<urn:page:") else None  # noqa: B023, E731
            kind = fields["WARC-Type"]
            given = fields["WARC-Payload-Digest"].removeprefix("sha256:")
            if kind == "response" and hashlib.sha256(payload).hexdigest() != given:
                raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
            rows.append((of("WARC-Record-ID"), len(payload) if kind == "response" else None, given, kind, of("WARC-Refers-To")))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_record(manifest: DataFrame, page_id: int) -> list[tuple[dict[str, str], bytes]]:
    """Headers and payload of one page's records: a lookup in the manifest, and one frame for each."""
    out = []
    for row in manifest.where(F.col("page_id") == page_id).collect():
        store, path = _storage(row.bundle)
        data = BundleReader(store.open_input_file(path)).frame(row.frame)
        out.append(parse(data[row.start : row.start + row.length]))
    return out


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return read_archives(write_archives(pages, work_dir(spark, "warc")))


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM f
"""
