"""What the operators share: checkpoints, and vectorised hashing of words in batches of texts.

Words here are runs of bytes other than 0x20 and 0x09-0x0D.  All of these are
single bytes in UTF-8, so words can be found in the bytes of a text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from florispark.session import cut, shared_folder

CHUNK_BYTES = 1 << 18
BUCKET_BYTES = 32 << 20


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    return shared_folder(spark, name)


FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows of df from a Parquet table in the shared folder, packed where cut() would hold them plain, and its path.

    Once the table is there nothing reads the shuffles that made it, so Spark is told to remove their
    files then, where they would stay until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    with setting(spark, FREE, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a Parquet table in the shared folder."""
    return stored(df, name)[0]


def drop(spark: SparkSession, path: str) -> None:
    """Removes a table that no later step reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def buckets(docs: DataFrame, column: str, share: float) -> int:
    """Buckets to deal what is gathered from a text column, `share` bytes for each of its bytes, into groups of about BUCKET_BYTES."""
    size = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(partitions(docs), int(size * share) // BUCKET_BYTES + 1)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """The rows of df, which are distinct, with numbers 0, 1, ... in the order of a column: sorted by ranges, whose sizes give each its first number."""
    ranged = cut(df.repartitionByRange(partitions(df), order).sortWithinPartitions(order).select("*", F.monotonically_increasing_id().alias("__at")))
    block = F.shiftright("__at", 33)
    sizes = sorted((r["b"], r["n"]) for r in ranged.groupBy(block.alias("b")).agg(F.count("*").alias("n")).collect())  # a row for each partition
    starts, total = {}, 0
    for b, n in sizes:
        starts[b] = total
        total += n
    base = F.element_at(F.create_map(*(F.lit(x) for pair in starts.items() for x in pair)), block) if starts else F.lit(0)
    return ranged.select(*df.columns, (base.cast("long") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def in_order(df: DataFrame, order: Sequence[Column], name: str, within: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """df stored in an order, dealt by ranges of it, and what turns a row's place in its range into one of the whole order.

    The first frame has df's columns, __part (the range) and __at, which grows along the order.
    The second has a row for each group of `within` columns, in which the order begins, and range that holds some of it:
    __at + __shift is the row's place in its group, from 0.  No task gets a group whole, and the
    second frame has no more rows than there are groups and ranges.  Ties fall as Spark deals them.
    """
    at = F.monotonically_increasing_id()
    ranged, _ = stored(df.repartitionByRange(partitions(df), *order).sortWithinPartitions(*order).select("*", at.alias("__at")), name)
    ranged = ranged.withColumn("__part", F.shiftright("__at", 33))
    pieces = ranged.groupBy(*within, "__part").agg(F.min("__at").alias("__low"), F.count("*").alias("__n"))
    before = Window.partitionBy(*within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    return ranged, pieces.withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__low")).drop("__low")


# ---- vectorised hashing -------------------------------------------------------------------------

_B = np.uint64(0x9E3779B97F4A7C15)
_B_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n."""
    if not len(_powers) or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES * 2)
        for name, base in (("up", _B), ("down", _B_INV)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] the polynomial hash of data[:i]; span_hash() gives that of any span."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] ^ (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """The words of some consecutive texts of a batch."""

    first: int  # index in the batch of the first text
    count: int  # texts
    hash: np.ndarray  # uint64 of each word
    bounds: np.ndarray  # words of text i: bounds[i]:bounds[i+1]
    start: np.ndarray  # byte offset of each word in its text
    end: np.ndarray
    data: np.ndarray  # bytes of the texts, one space after each
    offset: np.ndarray  # of each text in data


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8), ends


def word_chunks(column: pa.Array, lower: bool, chunk_bytes: int = CHUNK_BYTES, breaks: bytes = b"") -> Iterator[Words]:
    """Hashed words of a column's texts, in chunks of whole texts of about chunk_bytes; `breaks` end words as white space does."""
    space = _SPACE
    if breaks:
        space = _SPACE.copy()
        space[list(breaks)] = True
    raw, ends = text_bytes(column)
    n, i = len(ends) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + chunk_bytes, side="right")) - 1)
        j = min(j, n)
        sizes = np.diff(ends[i : j + 1])
        offset = np.concatenate(([0], np.cumsum(sizes + 1)))
        data = np.full(offset[-1], 0x20, dtype=np.uint8)
        part = raw[ends[i] : ends[j]]
        data[np.arange(len(part)) + np.repeat(np.arange(j - i), sizes)] = part
        if lower:
            data = _LOWER[data]
        word = np.concatenate(([False], ~space[data]))
        edge = np.flatnonzero(word[1:] != word[:-1])  # the last byte is a space
        start, end = edge[0::2], edge[1::2]
        text = np.searchsorted(offset, start, side="right") - 1
        yield Words(i, j - i, span_hash(prefix_hash(data), start, end), np.searchsorted(text, np.arange(j - i + 1)), start - offset[text], end - offset[text], data, offset)
        i = j


_STEP = [np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xD1342543DE82EF95, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0xF1357AEA2E62A9C5)]


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's k-word shingles in order, and their bounds by text.

    A text of fewer than k words, but at least one, has its whole sequence as its one shingle.
    """
    h, b = words.hash, words.bounds
    sizes = np.diff(b)
    if len(h) == 0:
        return h, np.zeros(words.count + 1, dtype=np.int64)
    padded = np.concatenate((h, np.zeros(k - 1, dtype=np.uint64)))
    out = np.zeros(len(h), dtype=np.uint64)
    for j in range(k):
        out += padded[j : j + len(h)] * (_STEP[j % 8] + np.uint64(2 * (j // 8)))
    out = mix(out)
    count = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    keep = np.arange(len(h)) - np.repeat(b[:-1], sizes) < np.repeat(count, sizes)
    for t in np.flatnonzero((sizes > 0) & (sizes < k)):
        out[b[t]] = mix(np.array([int(sum(int(x) * int(_STEP[j % 8]) for j, x in enumerate(h[b[t] : b[t + 1]])) + int(sizes[t])) % 2**64], dtype=np.uint64))[0]
    return out[keep], np.concatenate(([0], np.cumsum(count)))


def distinct_by_text(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and their bounds."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, text))
    v, t = values[order], text[order]
    first = np.ones(len(v), dtype=bool)
    first[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
    v, t = v[first], t[first]
    return v, np.searchsorted(t, np.arange(len(bounds)))


# ---- packing ------------------------------------------------------------------------------------


def planes(x: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, their low bytes first, then the next ones and so on; it packs better."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


# ---- connected components -----------------------------------------------------------------------


CONTRACTED_EDGES = 1 << 19


def smallest_connected(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of edges (a, b) that have a smaller one in their component, and the smallest one."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b, up = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        x, y = up[a], up[b]
        apart = x != y
        if not apart.any():
            break
        np.minimum.at(up, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(further := up[up], up):
            up = further
    below = np.flatnonzero(up != np.arange(len(nodes)))
    return nodes[below], nodes[up[below]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges as stars: of each CONTRACTED_EDGES that a task gets, nodes with the smallest one that these edges connect them with."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def stars() -> pa.RecordBatch:
        a, b = smallest_connected(*(np.concatenate(x) for x in zip(*held, strict=True)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
        if sum(len(x) for x, _ in held) >= CONTRACTED_EDGES:
            yield stars()
    if held:
        yield stars()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), for every node of an edge.

    Alternating large-star and small-star rounds, each a grouped minimum and a join on
    the node; what a task gets of a round's edges is contracted there, so that chains within it don't
    take rounds.  They end when no edge changes, or when fewer than CONTRACTED_EDGES are left, which one task contracts (8 MB).  Only counts reach the driver.  After max_rounds, which
    is an error, chains of links would be longer than any corpus.
    """
    spark = edges.sparkSession

    def contracted(e: DataFrame) -> tuple[DataFrame, str]:
        return stored(e.mapInArrow(_contracted, "a long, b long"), "edges")

    edges, path = contracted(edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct())

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.join(low, "a")
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return moved.where("a <> b").distinct()

    def print_of(e: DataFrame) -> tuple:  # an edge that two tasks have made counts twice, but not after the next round
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = print_of(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        before = path
        if seen[0] < CONTRACTED_EDGES:
            edges, path = contracted(edges.coalesce(1))
            drop(spark, before)
            break
        edges, path = contracted(star(star(edges, True), False))
        drop(spark, before)  # what it was made into is stored
        now = print_of(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not converge")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
