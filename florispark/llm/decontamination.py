"""Benchmark decontamination: size-partitioned MinHash containment search.

A document is contaminated by an item if it has at least 80 % of the item's distinct 5-word
shingles (words in lower-case A-Z).  Items are partitioned by size, in powers of two.  An item of
n shingles has as its MinHash sketch the m smallest hashes of its shingles.  At most
floor(0.2 n) of its shingles may be missing, so a match has at least m - floor(0.2 n) of the
sketch.  m is chosen by partition so that this is at least `hits` or all of a short item: the
search loses no match, and long documents need no sketch of their own.  Candidates are verified
by exact containment of shingles as words.

Items of up to block_bytes are sent to all tasks, and one pass over the documents finds and verifies
matches.  Where there are more, which is found out first, tasks get a bitmap of a fixed size of the
sketches' hashes instead.  Again one pass finds the shingles of documents that are in it; these are
joined with the sketches by hash, counted by document and item, and the pairs that have enough are
verified on the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, shingles, word_chunks

K = 5
BLOCK_BYTES = 2 << 20
BITMAP_BITS = 26
_OUT = "doc_id long, item_id long, n_shingles long, n_found long"


def item_of(text: str, percent: int, hits: int) -> tuple[np.ndarray, int, set] | None:
    """(sketch, values of it that a match has, all shingles as words) of an item; None if it has no shingle."""
    for w in word_chunks(pa.array([text]), lower=True):
        words = [bytes(w.data[s:e]) for s, e in zip(w.start, w.end, strict=True)]
        if len(words) >= K:
            hashes, _ = shingles(w, K)
            exact = {tuple(words[i : i + K]) for i in range(len(words) - K + 1)}
            n = len(exact)
            missing = n - -(-percent * n // 100)
            band = 1 << int(math.log2(n))  # the partition: sizes band to 2 * band - 1
            sketch = np.unique(hashes)[: min(n, missing + max(hits, band // 32))]
            return sketch, max(1, len(sketch) - missing), exact
    return None


class Index:
    """Sketches of a block of items, partitioned by size."""

    def __init__(self, items: list[tuple[int | None, str]], percent: int, hits: int):
        self.need, self.sets, self.ids = [], [], []
        values, owner = [], []
        for item_id, text in dict.fromkeys(items):
            if item := item_of(text, percent, hits):
                sketch, need, exact = item
                values.append(sketch)
                owner.append(np.full(len(sketch), len(self.ids)))
                self.ids.append(item_id)
                self.need.append(need)
                self.sets.append(exact)
        values_, owner_ = np.concatenate([np.zeros(0, np.uint64), *values]), np.concatenate([np.zeros(0, np.int64), *owner])
        order = np.argsort(values_, kind="stable")
        self.values, self.owner = values_[order], owner_[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.values & np.uint64((1 << 20) - 1)] = True
        self.percent = percent


def _texts(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> tuple[DataFrame, DataFrame, int]:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null").distinct()
    return docs, items, int(items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0)


def _sent(items: DataFrame, percent: int, hits: int):
    return items.sparkSession.sparkContext.broadcast(Index([tuple(r) for r in items.collect()], percent, hits))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", percent: int = 80, hits: int = 3, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found): each document that has at least percent % of an item's shingles.

    n_shingles is the number of the item's distinct 5-word shingles, n_found how many of them the
    document has.  Items of fewer than 5 words (null and empty ones too) have no 5-word shingle
    and match nothing, and neither do such documents.  Each row of docs is searched, repeated ones
    and null ids too; repeated rows of items count once.  Other columns are ignored.
    """
    docs, items, size = _texts(docs, items, id_col, text_col, item_col, item_text)
    if size > block_bytes:
        return _by_join(docs, items, percent, hits).select("doc_id", "item_id", "n_shingles", "n_found")
    index = _sent(items, percent, hits)
    return docs.mapInArrow(lambda it: _search(it, index.value), _OUT)


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", percent: int = 80, hits: int = 3, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, that have less than percent % of every item's shingles; see contamination().

    Each row is judged by its own text, whatever its id: rows without id and rows that repeat an id
    go if their text is contaminated, and null, empty and short texts stay.
    """
    texts, items, size = _texts(docs, items, id_col, text_col, item_col, item_text)
    if size <= block_bytes:
        index, at = _sent(items, percent, hits), docs.columns.index(text_col)

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                number = pa.array(np.arange(batch.num_rows))
                own = pa.RecordBatch.from_arrays([number, batch.column(at).cast(pa.string())], names=["doc_id", "text"])
                bad = [x for part in _search([own], index.value) for x in part.column(0).to_pylist()]
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[bad] = False
                yield batch.filter(pa.array(keep))

        return docs.mapInArrow(clean, docs.schema)
    bad = _by_join(texts, items, percent, hits).select(F.col("id").alias("__decontamination_id"), F.col("th").alias("__decontamination_th")).distinct()
    id_, th = _name(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return docs.join(bad, (id_ == F.col("__decontamination_id")) & (th == F.col("__decontamination_th")), "left_anti")


def _name(id_: Column, text: Column) -> tuple[Column, Column]:
    """What names a row: id and text."""
    return F.coalesce(id_, F.lit(-(1 << 63))), F.xxhash64(F.coalesce(text, F.lit("")))


def _sketches(batches: Iterator[pa.RecordBatch], percent: int, hits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item_id, ih, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if item := item_of(text, percent, hits):
                n = len(item[0])
                yield pa.RecordBatch.from_arrays([pa.array(item[0].view(np.int64)), pa.array([item_id] * n, pa.int64()), pa.array([ih] * n, pa.int64()), pa.array([item[1]] * n, pa.int64())], names=["value", "item_id", "ih", "need"])


def _hits(batches: Iterator[pa.RecordBatch], bits: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """(id, th, value) of the distinct shingles of each document that may be in a sketch."""
    for batch in batches:
        for w in word_chunks(batch.column(2), lower=True):
            h, bounds = shingles(w, K)
            place = h & np.uint64((1 << width) - 1)
            at = np.flatnonzero(bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1))
            pairs = np.unique(np.stack((np.searchsorted(bounds, at, "right").astype(np.uint64) - np.uint64(1), h[at])), axis=1)
            if pairs.shape[1]:
                rows = pa.array(pairs[0].astype(np.int64) + w.first)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(pairs[1].view(np.int64))], names=["id", "th", "value"])


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    split = lambda text: next(([bytes(w.data[s:e]) for s, e in zip(w.start, w.end, strict=True)] for w in word_chunks(pa.array([text]), lower=True, chunk_bytes=1 << 40)), [])
    for batch in batches:
        rows, known = [], {}
        for id_, th, text, item_id, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sets = []
            for key, x in (((id_, th), text), (item, item)):
                if key not in known:
                    if len(known) > 8:
                        known.clear()
                    words = split(x)
                    known[key] = {tuple(words[i : i + K]) for i in range(len(words) - K + 1)}
                sets.append(known[key])
            n, both = len(sets[1]), len(sets[0] & sets[1])
            if 100 * both >= percent * n:
                rows.append((None if id_ == -(1 << 63) else id_, id_, th, item_id, n, both))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "id", "th", "item_id", "n_shingles", "n_found"])


def _by_join(docs: DataFrame, items: DataFrame, percent: int, hits: int, width: int = BITMAP_BITS) -> DataFrame:
    """As contamination(), with the name (id, th) of each row, for any number of items: sketches are joined, not sent."""
    id_, th = _name(F.col("doc_id"), F.col("text"))
    named = docs.select(id_.alias("id"), th.alias("th"), "text")
    items = items.withColumn("ih", F.xxhash64("text"))
    sketches = cut(items.select("item_id", "ih", "text").mapInArrow(lambda it: _sketches(it, percent, hits), "value long, item_id long, ih long, need long"))
    place = F.col("value").bitwiseAND(F.lit((1 << width) - 1))
    words = sketches.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(value & 63 as int))")).alias("bits")).toPandas()  # 2 ** (width - 6) rows at most
    bits = np.zeros(1 << (width - 6), dtype=np.uint64)
    bits[words["word"].to_numpy().astype(np.int64)] = words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    found = named.mapInArrow(lambda it: _hits(it, sent.value, width), "id long, th long, value long").distinct()
    pairs = found.join(sketches, "value").groupBy("id", "th", "item_id", "ih").agg(F.count("*").alias("n"), F.max("need").alias("need")).where("n >= need")
    texts = named.join(pairs.select("id", "th", "item_id", "ih"), ["id", "th"])
    both = texts.join(items.select(F.col("item_id").alias("own"), "ih", F.col("text").alias("item")), (F.col("item_id").eqNullSafe(F.col("own"))) & (texts["ih"] == items["ih"]))
    return both.select("id", "th", "text", "item_id", "item").mapInArrow(lambda it: _verify(it, percent), "doc_id long, id long, th long, item_id long, n_shingles long, n_found long")


def _search(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, rows = batch.column(0).to_pylist(), []
        for w in word_chunks(batch.column(1), lower=True) if len(index.ids) else ():
            h, bounds = shingles(w, K)
            at = np.flatnonzero(index.maybe[h & np.uint64((1 << 20) - 1)])
            lo, hi = np.searchsorted(index.values, h[at], "left"), np.searchsorted(index.values, h[at], "right")
            at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
            if not len(at):
                continue
            n = hi - lo
            entry = np.repeat(lo - np.concatenate(([0], np.cumsum(n)))[:-1], n) + np.arange(n.sum())
            text = np.repeat(np.searchsorted(bounds, at, "right") - 1, n)
            pairs = np.unique(np.stack((text, index.owner[entry], entry)), axis=1)  # a sketch value counts once in a document
            for t, item in sorted({(int(a), int(b)) for a, b in zip(pairs[0], pairs[1], strict=True)}):
                if np.count_nonzero((pairs[0] == t) & (pairs[1] == item)) >= index.need[item]:
                    rows.append((t + w.first, t, item, w))
        out = []
        known: tuple = ()
        for i, t, item, w in rows:
            if not known or known[0] != i:
                a, b = w.bounds[t], w.bounds[t + 1]
                words = [bytes(w.data[s:e]) for s, e in zip(w.start[a:b] + w.offset[t], w.end[a:b] + w.offset[t], strict=True)]
                known = i, {tuple(words[j : j + K]) for j in range(len(words) - K + 1)}
            n = len(index.sets[item])
            both = sum(x in known[1] for x in index.sets[item])
            if 100 * both >= index.percent * n:
                out.append((ids[i], index.ids[item], n, both))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["doc_id", "item_id", "n_shingles", "n_found"])


ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), q AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
), qs AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM q WHERE len(w) >= 5)
), n AS (SELECT item_id, count(*) AS n FROM qs GROUP BY item_id)
SELECT doc_id, qs.item_id, n.n AS n_shingles, count(*) AS n_found
FROM ds JOIN qs ON ds.s = qs.s JOIN n ON n.item_id = qs.item_id
GROUP BY doc_id, qs.item_id, n.n HAVING 100 * count(*) >= 80 * n.n
"""
