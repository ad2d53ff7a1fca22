r"""Line dedup by a deletion-neighbourhood join.

Lines are \n-separated; a line is its words (runs of bytes other than white space, in lower-case
A-Z).  A line of min_words or more goes if an earlier line of the corpus (in order of doc_id and
line number) is equal, or, where both have near_words or more, is one word edit away: one word
put in, taken out or changed.

1. Equal lines meet by a 128-bit hash, in packets to buckets of hashes; the first of each stands for
   all.  What is equal within a packet is settled there, so a line that is everywhere costs one row
   for each packet.
2. Two lines one edit apart have their first or their last h words in common, h being about half of
   the shorter one's.  The lines of 1. meet again by the hashes of these; a line that shares none
   has no such partner and goes no further.
3. Of the rest, every variant with one word deleted is emitted as a hash.  Lines of one length that
   have a variant and its position in common differ in that word alone, so all but the first of
   such a group go; a variant that is a line itself pairs with it.  Both cost one row per member.
4. Pairs are verified by edit distance on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets as buckets_for
from .common import Words, cut, mix, powers, prefix_hash, span_hash, word_chunks

PACKET_LINES = 1 << 18
_PACKET = "bucket int, kind int, id binary, th binary, line binary, k1 binary, k2 binary, keys binary"
_AGAIN = np.uint64(0xC2B2AE3D27D4EB4F)


def named(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def line_words(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, line number, first word, end word) of each line with words."""
    text = np.repeat(np.arange(w.count), np.diff(w.bounds))
    breaks = np.concatenate(([0], np.cumsum(w.data == 10)))
    line = breaks[w.start + w.offset[text]] - breaks[w.offset[text]]
    if not len(line):
        return text, line, text, text
    new = np.ones(len(line), dtype=bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return text[first], line[first], first, np.append(first[1:], len(line))


def half(n: np.ndarray) -> np.ndarray:
    """Words at either end that are compared: half of n, in fours, so that lines of like lengths mostly agree on it."""
    return np.where(n >= 8, n // 2 // 4 * 4, n // 2)


NAMES = ("id", "th", "line", "k1", "k2")
KINDS = (np.int64, np.int64, np.int32, np.uint64, np.uint64)


def _lines(w: Words, min_words: int, near_words: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(text, [line, k1, k2], keys) of each line; four keys each, 0 where there is none."""
    text, line, s, e = line_words(w)
    keep = e - s >= min_words
    text, line, s, e = text[keep], line[keep], s[keep], e[keep]
    n = e - s
    prefix, other = prefix_hash(w.hash), prefix_hash(mix(w.hash ^ _AGAIN))
    keys = []
    own, less = half(n), half(np.maximum(n - 1, 0))
    for h, ok in ((own, n >= near_words), (less, (n > near_words) & (less != own))):
        for a, b, side in ((s, s + h, 0), (e - h, e, 1)):
            keys.append(np.where(ok, span_hash(prefix, a, b) ^ mix(h.astype(np.uint64) * np.uint64(2) + np.uint64(side)), np.uint64(0)))
    return text, [line.astype(np.int32), span_hash(prefix, s, e), span_hash(other, s, e)], np.column_stack(keys)


def _bucket_edges(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(((sorted_keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1).astype(np.uint64))


def first_lines(cols: list[np.ndarray], keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """Lines (columns as in NAMES) and their keys, the first of equal ones only; and id, th and line of the others."""
    order = np.lexsort((cols[2], cols[1], cols[0], cols[4], cols[3]))
    cols, keys = [c[order] for c in cols], keys[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (cols[3][1:] != cols[3][:-1]) | (cols[4][1:] != cols[4][:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    other = (cols[0] != cols[0][first]) | (cols[1] != cols[1][first]) | (cols[2] != cols[2][first])  # a row may be there twice
    return [c[new] for c in cols], keys[new], [c[other] for c in cols[:3]]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 6)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "kind", *NAMES, "keys"])


COPY, LINE, KEY, SHARED = range(4)


def _packets(batches: Iterator[pa.RecordBatch], min_words: int, near_words: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """kind LINE: lines to meet equal ones; COPY: those that an earlier line of the packet equals."""
    held: list[list[np.ndarray]] = []
    size, made = 0, TaskContext.get().partitionId()

    def flush() -> pa.RecordBatch:
        nonlocal size, made
        *cols, keys = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        cols, keys, copies = first_lines(cols, keys)
        edge = _bucket_edges(cols[3], buckets)
        rows = [(b, LINE, *(c[s:e].tobytes() for c in cols), np.ascontiguousarray(keys[s:e]).tobytes()) for b, (s, e) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if e > s]
        if len(copies[0]):
            rows.append((made % buckets, COPY, *(c.tobytes() for c in copies), b"", b"", b""))
        size, made = 0, made + 1
        return _rows(rows)

    for batch in batches:
        ids, ths = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        for w in word_chunks(batch.column(2), lower=True):
            text, cols, keys = _lines(w, min_words, near_words)
            if len(text):
                held.append([ids[text + w.first], ths[text + w.first], *cols, keys])
                size += len(text)
            if size >= PACKET_LINES:
                yield flush()
    if size:
        yield flush()


def _load(pdf: pd.DataFrame, names: tuple[str, ...], kinds: tuple) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, k), *(np.frombuffer(x, k) for x in pdf[n])]) for n, k in zip(names, kinds, strict=True)]


def _meet_equal(pdf: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Of one bucket of lines: COPY rows, and by bucket of keys KEY rows of the first lines.

    A key that lines of this bucket share needs no partner from another: all its lines but one are
    SHARED at once, and that one goes on with the key's mark in k1.
    """
    cols, keys, copies = first_lines(_load(pdf[pdf["kind"] == LINE], NAMES, KINDS), np.concatenate([np.zeros((0, 4), np.uint64), *(np.frombuffer(x, np.uint64).reshape(-1, 4) for x in pdf.loc[pdf["kind"] == LINE, "keys"])]))
    rows = [tuple(r) for r in pdf[pdf["kind"] == COPY].itertuples(index=False)]
    if len(copies[0]):
        rows.append((0, COPY, *(c.tobytes() for c in copies), b"", b"", b""))
    at, _ = np.nonzero(keys)
    key = keys[keys != 0]
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    many = np.append(~new[1:], False) if len(key) else new
    rest = np.unique(at[~new])
    if len(rest):
        rows.append((0, SHARED, *(c[rest].tobytes() for c in cols[:3]), b"", b"", b""))
    key, at, many = key[new], at[new], many[new]
    edge = _bucket_edges(key, buckets)
    for b, (s, e) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
        if e > s:
            rows.append((b, KEY, *(c[at[s:e]].tobytes() for c in cols[:3]), many[s:e].astype(np.uint8).tobytes(), b"", key[s:e].tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "kind", *NAMES, "keys"])


def _meet_keys(pdf: pd.DataFrame) -> pd.DataFrame:
    """Lines that share a key with another one."""
    ids, ths, lines, many, key = _load(pdf, ("id", "th", "line", "k1", "keys"), (*KINDS[:3], np.uint8, np.uint64))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    marked = np.zeros(len(count), dtype=bool)
    np.logical_or.at(marked, inverse, many > 0)
    ok = (count[inverse] > 1) | marked[inverse]
    return pd.DataFrame({"id": ids[ok], "th": ths[ok], "line": lines[ok]})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row[n], k)) for n, k in zip(NAMES[:3], KINDS[:3], strict=True)], names=list(NAMES[:3]))


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines of each text, as words joined by one space."""
    for batch in batches:
        wanted, rows = batch.column(3).to_pylist(), []
        for w in word_chunks(batch.column(2), lower=True):
            text, line, s, e = line_words(w)
            want = {(t, x) for t in range(w.count) for x in wanted[t + w.first]}
            for t, x, a, b in zip(text.tolist(), line.tolist(), s.tolist(), e.tolist(), strict=True):
                if (t, x) in want:
                    words = b" ".join([bytes(w.data[i:j]) for i, j in zip(w.start[a:b] + w.offset[t], w.end[a:b] + w.offset[t], strict=True)])
                    rows.append((batch.column(0)[t + w.first].as_py(), batch.column(1)[t + w.first].as_py(), x, words.decode()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.string()), strict=True)], names=["id", "th", "line", "words"])


_VARIANT = "id long, th long, line int, v long, kind int"


def _variants(batches: Iterator[pa.RecordBatch], near_words: int) -> Iterator[pa.RecordBatch]:
    """kind -1: the line itself; -2: a variant, to meet a line; i: the variant without word i, to meet others of its length."""
    for batch in batches:
        for w in word_chunks(batch.column(3), lower=False):
            n = np.diff(w.bounds)
            text = np.repeat(np.arange(w.count), n)
            s, e, i = w.bounds[:-1][text], w.bounds[1:][text], np.arange(len(w.hash))
            # a sum of placed words: deleting one moves those behind it a place to the left
            prefix = prefix_hash(w.hash)
            _, down = powers(len(prefix))
            base = down[s]
            before, behind = (prefix[i] - prefix[s]) * base, (prefix[e] - prefix[i + 1]) * base * down[1]
            without = mix((before + behind) ^ mix((n[text] - 1).astype(np.uint64)))
            whole = mix(((prefix[w.bounds[1:]] - prefix[w.bounds[:-1]]) * down[w.bounds[:-1]]) ^ mix(n.astype(np.uint64)))
            place = (i - s).astype(np.int32)
            longer = n[text] > near_words
            rows = np.concatenate((np.arange(w.count), text[longer], text)) + w.first
            v = np.concatenate((whole, without[longer], without))
            kind = np.concatenate((np.full(w.count, -1, np.int32), np.full(int(longer.sum()), -2, np.int32), place))
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at), pa.array(v.view(np.int64)), pa.array(kind)], names=["id", "th", "line", "v", "kind"])


def word_edits(a: list[str], b: list[str], bound: int) -> int:
    """Word edit distance, or bound + 1 where it is more."""
    if abs(len(a) - len(b)) > bound:
        return bound + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return min(max(len(a), len(b)), bound + 1)
    if bound == 0:
        return 1
    return min(bound + 1, 1 + min(word_edits(a[1:], b[1:], bound - 1), word_edits(a[1:], b, bound - 1), word_edits(a, b[1:], bound - 1)))


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        ok = [word_edits(a.split(" "), b.split(" "), 1) <= 1 for a, b in zip(pdf["words"], pdf["first_words"], strict=True)]
        yield pdf.loc[ok, ["id", "th", "line"]]


def removed_lines(docs: DataFrame, min_words: int = 3, near_words: int = 8) -> DataFrame:
    """Of named() documents, the lines that go, as (id, th, line, near)."""
    place, buckets = F.struct("id", "th", "line"), buckets_for(docs, "text", 1.0)  # lines of some words have about as many bytes of hashes
    met = docs.mapInArrow(lambda it: _packets(it, min_words, near_words, buckets), _PACKET).groupBy("bucket").applyInPandas(lambda pdf: _meet_equal(pdf, buckets), _PACKET)
    met = cut(met)
    three = "id long, th long, line int"
    packed = lambda kind: met.where(F.col("kind") == kind).select(*NAMES[:3]).mapInArrow(_unpack, three)
    copies = packed(COPY).withColumn("near", F.lit(False))
    some = packed(SHARED).union(met.where(F.col("kind") == KEY).groupBy("bucket").applyInPandas(_meet_keys, three))
    some = some.groupBy("id", "th").agg(F.collect_set("line").alias("wanted"))
    texts = cut(docs.join(some, ["id", "th"]).select("id", "th", "text", "wanted").mapInArrow(_fetch, "id long, th long, line int, words string"))
    v = texts.select("id", "th", "line", "words").mapInArrow(lambda it: _variants(it, near_words), _VARIANT)
    changed = v.where("kind >= 0")
    first = cut(changed.groupBy("v", "kind").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"))
    pairs = changed.join(first, ["v", "kind"]).where(place != F.col("first")).select(place.alias("late"), F.col("first"))
    lines_ = v.where("kind = -1").select("v", place.alias("whole"))
    one = v.where("kind = -2").select("v", place.alias("longer")).join(lines_, "v").select(F.greatest("whole", "longer").alias("late"), F.least("whole", "longer").alias("first"))
    pairs = pairs.union(one).where("late <> first").distinct()
    named_text = texts.select(place.alias("first"), F.col("words").alias("first_words"))
    near = pairs.join(texts.select(place.alias("late"), "words"), "late").join(named_text, "first").select("late.*", "words", "first_words").mapInPandas(_verify, "id long, th long, line int").distinct()
    return copies.union(near.select("id", "th", "line", F.lit(True).alias("near")))


def _per_document(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """(id, th, gone, n_near) of documents that lose lines; a copy of a line that goes for a near one goes as well, being later."""
    gone = removed_lines(docs, min_words, near_words).groupBy("id", "th", "line").agg(F.bool_and("near").alias("near"))
    return gone.groupBy("id", "th").agg(F.collect_list("line").alias("gone"), F.count_if("near").alias("n_near"))


def line_duplicates(docs: DataFrame, min_words: int = 3, near_words: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_removed, n_near, removed) of each row.

    removed are the numbers (from 0, in order) of lines with an earlier equal or near line, as one
    string; n_near of them have a near line only.  Null
    and empty texts have no lines.  Rows alike in id and text are one document, and each of them
    has a result; rows without id come first in order.  Other columns are ignored.
    """
    docs = named(docs, id_col, text_col)
    found = _per_document(docs, min_words, near_words)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    return docs.select("id", "th").join(found, ["id", "th"], "left").select(F.nullif("id", F.lit(-(1 << 63))).alias("doc_id"), zero(F.size(gone)).alias("n_removed"), zero(F.col("n_near")).alias("n_near"), F.array_join(F.sort_array(gone), ",").alias("removed"))


def remove_lines(docs: DataFrame, min_words: int = 3, near_words: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without their duplicate lines; a document that has lost all its words goes.

    A document none of whose lines go keeps its text as it is, empty or null.  Rows without id come
    first in order; rows alike in id and text are one document, and each of them has a row.  Other
    columns are carried along.
    """
    # names that no table has
    key, hash_, gone = "__line_dedup_id", "__line_dedup_th", "__line_dedup_gone"
    source = docs.withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))).withColumn(hash_, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    found = _per_document(named(docs, id_col, text_col), min_words, near_words).select(F.col("id").alias(key), F.col("th").alias(hash_), F.col("gone").alias(gone))
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column(at).to_pylist(), np.ones(batch.num_rows, dtype=bool)
            for i, numbers in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if numbers is not None:
                    numbers = set(numbers)
                    texts[i] = "\n".join([x for n, x in enumerate(texts[i].split("\n")) if n not in numbers])
                    keep[i] = any(x.strip(" \t\n\v\f\r") for x in texts[i].split("\n"))
            columns = list(batch.columns)[:-1]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1]).filter(pa.array(keep))

    return source.join(found, [key, hash_], "left").select(*docs.columns, gone).mapInArrow(run, schema)


ORACLE = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, list_filter(regexp_split_to_array(translate(lines[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)
), k AS (
  SELECT doc_id, line, w, array_to_string(w, ' ') AS s, doc_id * 1000000 + line AS place FROM l WHERE len(w) >= 3
), e AS (
  SELECT *, min(place) OVER (PARTITION BY s) AS first_place FROM k
), r AS (SELECT place, w, s, len(w) AS n FROM e WHERE place = first_place AND len(w) >= 8
), v AS (
  SELECT place, n, i, array_to_string(list_concat(w[1:i-1], w[i+1:n]), ' ') AS s FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM r)
), near AS (
  SELECT place FROM (SELECT place, min(place) OVER (PARTITION BY n, i, s) AS m FROM v) WHERE m < place
  UNION SELECT greatest(v.place, r.place) FROM v JOIN r ON v.s = r.s WHERE v.place <> r.place
), g AS (
  SELECT e.doc_id, e.line, e.place <> e.first_place AS copy, near.place IS NOT NULL AS near FROM e LEFT JOIN near ON e.place = near.place
)
SELECT d.doc_id, count(*) FILTER (copy OR near) AS n_removed, count(*) FILTER (near AND NOT copy) AS n_near,
       coalesce(string_agg(CAST(g.line AS VARCHAR), ',' ORDER BY g.line) FILTER (copy OR near), '') AS removed
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id GROUP BY d.doc_id
"""
