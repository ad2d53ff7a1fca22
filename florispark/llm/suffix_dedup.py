"""Suffix-array dedup: byte strings of a given length that occur more than once, in all documents.

Equal strings are brought together by content.  Of each `length`-byte window, the smallest hash
of its GRAM-byte substrings (the leftmost of equal ones) is the window's seed; equal windows have
equal seeds at equal offsets.  Neighbouring windows mostly share one seed occurrence, so a document
gives one row for each run of such windows, a few for every thousand bytes:

1. Seeds that occur once can't belong to a repeated window and go.
2. Runs whose whole context (the bytes that their windows cover) occurs again are repeated as they
   are.  They are found by grouping on the context's hash; copies cost one row each.
3. The other runs of a seed are compared with one representative of each of the seed's contexts.
   A task takes the contexts of many seeds, sorts their windows in suffix order, and
   computes the longest-previous-factor array: for each window, previous and next smaller
   positions in suffix order give the longest match that begins earlier.  The same array over
   reversed positions gives the longest match that begins later.
4. A seed with very many contexts isn't given to one task: its windows are counted by a 128-bit
   hash, with partial sums (hot_contexts is where that begins; the result is the same).

Repeated windows become byte spans, merged by document.  With report_length, all this is done for
strings of that many bytes first, whose spans are only counted; longer repeated strings lie in
them, so only the spans that are long enough are looked at again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, cut, drop, mix, prefix_hash, span_hash, stored, text_bytes

GRAM = 48
HOT_CONTEXTS = 20_000
SEGMENT = 1 << 22
_SEED = "id long, th long, fp long, c long, lo int, hi int"


def seeds_of(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, fp, context hash, lo, hi) of each run of windows of texts in data; positions are those in their texts."""
    out: list[tuple[np.ndarray, ...]] = []
    width = length - gram + 1
    prefix = prefix_hash(data)
    at = np.arange(max(0, len(data) - gram + 1))
    h = span_hash(prefix, at, at + gram)
    for begin in range(0, len(data) - length + 1, SEGMENT):
        end = min(begin + SEGMENT, len(data) - length + 1)  # windows begin:end
        v = (h[begin : end + width - 1] & ~np.uint64(0xFFFFFF)) | np.arange(end - begin + width - 1, dtype=np.uint64)
        padded = np.full(-(-len(v) // width) * width, ~np.uint64(0), dtype=np.uint64)
        padded[: len(v)] = v
        rows = padded.reshape(-1, width)
        up = np.minimum.accumulate(rows, axis=1).ravel()
        down = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        x = np.arange(end - begin)
        p = (np.minimum(down[x], up[x + width - 1]) & np.uint64(0xFFFFFF)).astype(np.int64) + begin
        text = np.searchsorted(ends, x + begin, "right") - 1
        good = x + begin + length <= ends[text + 1]
        x, p, text = x[good] + begin, p[good], text[good]
        if not len(x):
            continue
        first = np.ones(len(x), dtype=bool)
        first[1:] = (p[1:] != p[:-1]) | (text[1:] != text[:-1])
        last = np.append(first[1:], True)
        lo, hi, p, text = x[first], x[last], p[first], text[first]
        base = ends[text]
        out.append((text, h[p], span_hash(prefix, lo, hi + length) ^ (p - lo).astype(np.uint64), lo - base, hi - base))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(np.zeros(0, np.int64) for _ in range(5))


def _seeds(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, ends = text_bytes(batch.column(2))
        n, i = len(ends) - 1, 0
        while i < n:
            j = min(n, max(i + 1, int(np.searchsorted(ends, ends[i] + CHUNK_BYTES, "right")) - 1))
            text, fp, c, *places = seeds_of(raw[ends[i] : ends[j]], ends[i : j + 1] - ends[i], length, gram)
            if len(text):
                at, off = pa.array(text + i), batch.column(3).to_numpy()[text + i]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(fp.view(np.int64)), pa.array(c.view(np.int64)), *(pa.array((v + off).astype(np.int32)) for v in places)], names=["id", "th", "fp", "c", "lo", "hi"])
            i = j


_CONTEXT = "id long, th long, fp long, c long, m long, lo int, hi int, context binary"


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes under the runs of a document that are in the stretch at hand, one row for each run."""
    names = [x.split()[0] for x in _CONTEXT.split(", ")]
    for batch in batches:
        raw, ends = text_bytes(batch.column(2))
        key, th, off = (batch.column(c).to_numpy() for c in (0, 1, 3))
        of = batch.column(4).value_parent_indices().to_numpy()
        fp, c, m, lo, hi = (x.to_numpy() for x in batch.column(4).flatten().flatten())
        inside = (lo >= off[of]) & (hi + length <= (off + np.diff(ends))[of])
        of, fp, c, m, lo, hi = (x[inside] for x in (of, fp, c, m, lo, hi))
        start = ends[:-1][of] + lo - off[of]
        for i in range(0, len(of), 4096):
            part = slice(i, i + 4096)
            context = pa.array([raw[a:b].tobytes() for a, b in zip(start[part].tolist(), (start + hi - lo + length)[part].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(pa.array(x[part]) for x in (key[of], th[of], fp, c, m, lo, hi)), context], names=names)


# ---- suffix order and longest previous factors ---------------------------------------------------


def dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    s = keys[order]
    rank = np.empty(len(keys), dtype=np.uint32)
    rank[order] = np.cumsum(np.concatenate(([0], s[1:] != s[:-1])))
    return rank


def prefix_ranks(data: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """By prefix doubling: (size, rank of the `size` bytes from each position) for sizes of 8 bytes up to `length`."""
    w = np.concatenate((data, np.zeros(length + 8, dtype=np.uint8))).astype(np.uint64)
    for shift in (8, 16, 32):
        step = shift // 8
        w = (w[:-step] << np.uint64(shift)) | w[step:]
    levels, size = [(8, dense(w[: len(data) + length - 8]))], 8
    while size * 2 <= length:
        rank = levels[-1][1].astype(np.uint64)
        levels.append((size * 2, dense((rank[:-size] << np.uint64(32)) | rank[size:])))
        size *= 2
    return levels


def suffix_order(levels: list[tuple[int, np.ndarray]], at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes that begin at `at`, compared on `length` bytes, and the common prefix of neighbours.

    Equal suffixes are in order of position.  lcp[i] is that of the i-th and the one before it:
    exact where it is `length`, else rounded down to 8 bytes.
    """
    levels = [x for x in levels if x[0] <= length]
    size, rank = levels[-1]
    key = (rank[at].astype(np.uint64) << np.uint64(32)) | rank[at + length - size]
    order = np.lexsort((at, key))
    a, b = at[order[:-1]], at[order[1:]]
    lcp = np.zeros(len(at), dtype=np.int64)
    same = key[order[1:]] == key[order[:-1]]
    got = np.zeros(len(a), dtype=np.int64)
    for size, rank in reversed(levels):
        limit = len(rank) - 1
        more = (got + size <= length) & (rank[np.minimum(a + got, limit)] == rank[np.minimum(b + got, limit)])
        got += size * more
    lcp[1:] = np.where(same, length, np.minimum(got, length - 1))
    return order, lcp


def previous_factors(position: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """For suffixes in suffix order: the longest match, if `least` or more, with a suffix of smaller position.

    position[i] is that of the i-th suffix.  From each suffix, links lead to the previous and to
    the next suffix of smaller position, passing over others by their own links; the smallest lcp
    on the way is the length of the match.  A walk ends where that falls below `least`.
    """
    best = np.zeros(len(position), dtype=np.int64)
    for pos, near in ((position, lcp), (position[::-1], np.concatenate((lcp[1:], [0]))[::-1])):
        link, low = np.arange(len(pos)) - 1, near.copy()
        live = np.flatnonzero((link >= 0) & (low >= least))
        while len(live):
            to = link[live]
            found = pos[to] < pos[live]
            far = live[~found]
            to = to[~found]
            low[far], link[far] = np.minimum(low[far], low[to]), link[to]
            live = far[(link[far] >= 0) & (low[far] >= least)]
        ok = (link >= 0) & (low >= least)
        ok[ok] = pos[link[ok]] < pos[ok]
        found = np.where(ok, low, 0)
        best = np.maximum(best, found if near is lcp else found[::-1])
    return best


def repeated_windows(contexts: list[bytes], starts: np.ndarray, length: int, both: bool) -> np.ndarray:
    """Which windows of the contexts (starts[i] in context i) have an earlier match, or with both=True any other."""
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    sizes = np.array([len(x) for x in contexts])
    at = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(starts) - starts), starts) + np.arange(starts.sum())
    order, lcp = suffix_order(prefix_ranks(data, length), at, length)
    hit = previous_factors(order, lcp, length) >= length
    if both:
        hit |= previous_factors(-order, lcp, length) >= length
    out = np.zeros(len(at), dtype=bool)
    out[order] = hit
    return out


BATCH_BYTES = 1 << 20
_SPAN = "id long, th long, s int, e int"


def _evaluate(batches: Iterator[pd.DataFrame], length: int, both: bool) -> Iterator[pd.DataFrame]:
    """Rows are sorted by fp, id, th and lo; each pass takes whole seeds."""
    rest: list[pd.DataFrame] = []

    def spans(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        starts = (pdf["hi"] - pdf["lo"] + 1).to_numpy().astype(np.int64)
        hit = repeated_windows(pdf["context"].tolist(), starts, length, both)
        owner = np.repeat(np.arange(len(pdf)), starts)
        x = np.arange(len(hit)) - np.repeat(np.cumsum(starts) - starts, starts)
        if both:
            hit |= (pdf["m"].to_numpy() > 1)[owner]
        edge = np.flatnonzero(hit)
        if len(edge):
            new = np.ones(len(edge), dtype=bool)
            new[1:] = (np.diff(edge) != 1) | (owner[edge[1:]] != owner[edge[:-1]])
            a, b = edge[new], edge[np.append(new[1:], True)]
            ids, ths, los = (pdf[c].to_numpy()[owner[a]] for c in ("id", "th", "lo"))
            yield pd.DataFrame({"id": ids, "th": ths, "s": los + x[a], "e": los + x[b] + length})

    def whole(final: bool) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(rest, ignore_index=True)
        rest.clear()
        fp = pdf["fp"].to_numpy()
        ends = np.append(np.flatnonzero(fp[1:] != fp[:-1]) + 1, len(fp) if final else [])
        size, begin = np.concatenate(([0], np.cumsum(pdf["size"].to_numpy()))), 0
        for k, end in enumerate(ends.astype(int)):
            if k + 1 == len(ends) or size[int(ends[k + 1])] - size[begin] > BATCH_BYTES:
                yield from spans(pdf.iloc[begin:end])
                begin = end
        if begin < len(pdf):
            rest.append(pdf.iloc[begin:])

    held = 0
    for pdf in batches:
        if len(pdf):
            pdf = pdf.assign(size=pdf["context"].str.len())
            rest.append(pdf)
            held += int(pdf["size"].sum())
            if held >= BATCH_BYTES:
                yield from whole(False)
                held = 0
    if rest:
        yield from whole(True)


_AGAIN = np.uint64(0xC2B2AE3D27D4EB4F)
_WINDOW = "id long, th long, fp long, m long, x int, h long, g long"


def _window_hashes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, ends = text_bytes(batch.column(7))
        lo, hi = (batch.column(c).to_numpy().astype(np.int64) for c in (5, 6))
        starts = hi - lo + 1
        for i in range(0, batch.num_rows, 512):
            j = min(i + 512, batch.num_rows)
            data, n = raw[ends[i] : ends[j]], starts[i:j]
            of = np.repeat(np.arange(i, j), n)
            x = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            at = ends[of] - ends[i] + x
            h, g = (span_hash(prefix_hash(d), at, at + length).view(np.int64) for d in (data, mix(data.astype(np.uint64) ^ _AGAIN)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(of)) for c in (0, 1, 2, 4)), pa.array((x + lo[of]).astype(np.int32)), pa.array(h), pa.array(g)], names=[x.split()[0] for x in _WINDOW.split(", ")])


def repeated_spans(docs: DataFrame, length: int = 400, keep_first: bool = True, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(id, th, spans): byte spans (s, e) covered by repeated strings of rows (id, th, text, off), which are stretches of documents from byte `off` on.

    keep_first: a string is repeated where it occurs earlier, in order of id, text hash and
    position; otherwise wherever it occurs anywhere else.
    """
    gram = min(GRAM, length)
    every, path = stored(docs.mapInArrow(lambda it: _seeds(it, length, gram), _SEED), "seeds")
    # cut, so that the join deals both sides anew and Spark can split a common seed's rows
    multi = cut(every.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"))
    seeds, _ = stored(every.join(multi, "fp"), "repeated-seeds")
    drop(docs.sparkSession, path)
    place = F.struct("id", "th", "lo", "hi")
    kinds = cut(seeds.groupBy("fp", "c").agg(F.count("*").alias("m"), F.min(place).alias("rep")))
    groups = kinds.groupBy("fp").agg(F.count("*").alias("kinds"), F.min("m").alias("least"))
    groups = groups.where("kinds > 1" if keep_first else "kinds > 1 and least = 1")
    reps = kinds.join(groups, "fp").select("rep.*", "fp", "c", "m", "kinds")
    both = not keep_first

    def contexts(reps: DataFrame) -> DataFrame:
        texts = reps.groupBy("id", "th").agg(F.collect_list(F.struct("fp", "c", "m", "lo", "hi")).alias("runs"))
        return docs.join(texts, ["id", "th"]).select("id", "th", "text", "off", "runs").mapInArrow(lambda it: _contexts(it, length), _CONTEXT)

    is_hot = F.col("kinds") > hot_contexts
    found = contexts(reps.where(~is_hot)).repartition("fp").sortWithinPartitions("fp", "id", "th", "lo").mapInPandas(lambda it: _evaluate(it, length, both), _SPAN)
    if not groups.where(is_hot).isEmpty():
        windows = cut(contexts(reps.where(is_hot)).mapInArrow(lambda it: _window_hashes(it, length), _WINDOW))
        where = F.struct("id", "th", "x")
        counts = windows.groupBy("fp", "h", "g").agg(F.count("*").alias("n"), F.min(where).alias("first")).where("n > 1")
        again = windows.join(counts, ["fp", "h", "g"], "left").where(F.col("n").isNotNull() & (where != F.col("first")) if keep_first else F.col("n").isNotNull() | (F.col("m") > 1))
        found = found.union(again.select("id", "th", F.col("x").alias("s"), (F.col("x") + length).cast("int").alias("e")))
    # runs whose context occurs again, as they are
    copies = seeds.join(kinds.where("m > 1"), ["fp", "c"])  # kinds is cut, as multi is
    if keep_first:
        copies = copies.where(place != F.col("rep"))
    found = found.union(copies.select("id", "th", F.col("lo").alias("s"), (F.col("hi") + length).cast("int").alias("e")))
    return found.groupBy("id", "th").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows are named by id and text, so that repeated ids don't mix."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def _spans(column: pa.Array) -> list[list[tuple[int, int]]]:
    return [merged([(x["s"], x["e"]) for x in spans or ()]) for spans in column.to_pylist()]


_LOOK = "id long, th long, text binary, n_repeated long, parts array<struct<s:int,e:int>>, n_bytes long, kept_sha256 string"
_ROW = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("text", pa.binary()), ("n_repeated", pa.int64()), ("parts", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))), ("n_bytes", pa.int64()), ("kept_sha256", pa.string())])


def _look(batches: Iterator[pa.RecordBatch], length: int, digests: bool) -> Iterator[pa.RecordBatch]:
    """Each document with the parts in which longer repeats can be; if only digests are wanted, without its text where there are none."""
    for batch in batches:
        raw, ends = text_bytes(batch.column(2))
        rows = []
        for i, spans in enumerate(_spans(batch.column(3))):
            data, parts = raw[ends[i] : ends[i + 1]].tobytes(), [{"s": s, "e": e} for s, e in spans if e - s >= length]
            rows.append((data if parts or not digests else None, sum(e - s for s, e in spans), parts, len(data), None if parts or not digests else hashlib.sha256(data).hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), list(_ROW)[2:], strict=True))], schema=_ROW)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(key, th, text[x["s"] : x["e"]], x["s"]) for key, th, text, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True) for x in parts]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.int32()), strict=True)], names=["id", "th", "text", "off"])


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("n_repeated", pa.int64())])
_TEXT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("removed", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))), ("n_repeated", pa.int64())])


def _cut_out(batches: Iterator[pa.RecordBatch], digests: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, data, n_repeated, n_bytes, sha, gone in zip(*(batch.column(c).to_pylist() for c in range(5)), _spans(batch.column(5)), strict=True):
            key = None if key == -(1 << 63) else key
            if data is None:
                rows.append((key, n_bytes, 0, 0, sha, n_repeated))
                continue
            n_repeated = sum(e - s for s, e in gone) if n_repeated is None else n_repeated
            edges = [0, *(y for x in gone for y in x), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True))
            rows.append((key, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), n_repeated) if digests else (key, kept.decode("utf-8", "ignore"), [{"s": a, "e": b} for a, b in gone], n_repeated))
        if rows:
            schema = _DIGEST if digests else _TEXT
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def remove_repeats(docs: DataFrame, length: int = 400, keep_first: bool = True, digests: bool = False, id_col: str = "doc_id", text_col: str = "text", hot_contexts: int = HOT_CONTEXTS, report_length: int | None = None) -> DataFrame:
    """Each row's text without repeated byte strings of `length` or more.

    Returns (doc_id, text, removed spans, n_repeated), where bytes of a character that was cut are left
    out, or with digests=True (doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated).
    keep_first=True keeps the first occurrence in order of doc_id and position; keep_first=False
    removes every one.  n_repeated is the number of bytes that repeated strings of report_length
    (less than `length`) that occur anywhere else cover; without it, n_removed.
    Matches don't cross documents but may lie in one.  Null texts count as empty.  Each row has a
    result; rows alike in id and text are copies of each other if keep_first is false, and one
    text if it is true.  Rows without id come first.  Other columns are ignored.
    """
    named = _named(docs, id_col, text_col)
    whole = (named.dropDuplicates(["id", "th"]) if keep_first else named).withColumn("off", F.lit(0))
    two = report_length is not None and report_length < length
    spans = repeated_spans(whole, report_length if two else length, keep_first and not two, hot_contexts)
    if two:
        looked, _ = stored(named.join(spans, ["id", "th"], "left").select("id", "th", "text", "spans").mapInArrow(lambda it: _look(it, length, digests), _LOOK), "looked")
        parts, _ = stored((looked.dropDuplicates(["id", "th"]) if keep_first else looked).where(F.size("parts") > 0).select("id", "th", "text", "parts").mapInArrow(_stretches, "id long, th long, text binary, off int"), "parts")
        spans = repeated_spans(parts, length, keep_first, hot_contexts)
        out = looked.join(spans, ["id", "th"], "left").select("id", "text", "n_repeated", "n_bytes", "kept_sha256", "spans")
    else:
        total = F.lit(None).cast("long")
        out = named.join(spans, ["id", "th"], "left").select("id", F.col("text").cast("binary").alias("text"), total.alias("n_repeated"), total.alias("n_bytes"), F.lit(None).cast("string").alias("kept_sha256"), "spans")
    return out.mapInArrow(lambda it: _cut_out(it, digests), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_repeated long" if digests else "doc_id long, text string, removed array<struct<s:int,e:int>>, n_repeated long")


#: Windows of bytes as hexadecimal digits; runs of covered bytes by gaps between windows.
ORACLE = """
WITH RECURSIVE lengths AS (SELECT 400 AS n UNION ALL SELECT 240), d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, n, i, md5_number(substring(h, 2 * i + 1, 2 * n)) AS k
  FROM (SELECT doc_id, h, n, unnest(range(0, greatest(len(h) // 2 - n + 1, 0))) AS i FROM d, lengths)
), c AS (SELECT n, k FROM w GROUP BY n, k HAVING count(*) > 1
), s AS (
  SELECT doc_id, n, i, i - lag(i) OVER (PARTITION BY doc_id, n ORDER BY i) AS gap FROM w JOIN c USING (n, k)
), r AS (
  SELECT doc_id, n, i, sum(CASE WHEN gap <= n THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, n ORDER BY i) AS run FROM s
), m AS (SELECT doc_id, n, run, min(i) AS s, max(i) + n AS e FROM r GROUP BY doc_id, n, run
), p AS (
  SELECT doc_id, h, run, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY run), 0) AS before FROM m JOIN d USING (doc_id) WHERE n = 400
), t AS (
  SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans,
         string_agg(substring(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY run) || substring(any_value(h), 2 * max(e) + 1) AS kept FROM p GROUP BY doc_id
), u AS (SELECT doc_id, sum(e - s) AS n_repeated FROM m WHERE n = 240 GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256, CAST(coalesce(n_repeated, 0) AS BIGINT) AS n_repeated
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN u USING (doc_id)
"""
