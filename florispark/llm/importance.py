"""Target-distribution importance resampling with hashed word features.

The tokenizers library's untrained Split pre-tokeniser finds the words of ASCII-lowered texts with
their offsets; windows of offset pairs give the features (runs of words joined by one space), whose
CRC-32 names one of a fixed number of buckets.  Each text is cut into words once and kept as its
distinct buckets with counts.  Tasks add these up to one histogram each, histograms are summed by bucket,
and the gain of a bucket says how much more frequent it is in the target texts than in the
documents.  A document's weight is the sum of its features' gains; Gumbel noise from a hash of its id
makes the best scores a draw without replacement in proportion to exp(weight).

The draw is ranked by ranges of the order, which are counted, so no task gets all documents.  What is
sent to all tasks is one number for each bucket.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_order, stored

# fixed values: what a word is, after lower-casing A-Z, and what it isn't
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BREAK = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
BUCKETS = 10_000
PIECE_CHARS = 1 << 18
CACHE = 200_000
GAIN_UNIT = 1000


def pieces(text: str, chars: int = PIECE_CHARS) -> Iterator[str]:
    """A text in stretches of about `chars` characters that end between words; a longer word isn't cut."""
    at = 0
    while len(text) - at > chars:
        found = _BREAK.search(text, at + chars)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class Features:
    """Buckets of a text's features, by word order."""

    def __init__(self, shortest: int, longest: int, buckets: int):
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.split = Split(Regex(WORD), behavior="removed", invert=True)
        self.shortest, self.longest, self.buckets = shortest, longest, buckets
        self.cache: dict[str, int] = {}

    def bucket(self, feature: str) -> int:
        got = self.cache.get(feature)
        if got is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            got = self.cache[feature] = zlib.crc32(feature.encode()) % self.buckets
        return got

    def of(self, text: str) -> tuple[int, int, np.ndarray, np.ndarray]:
        """(words, features, sorted distinct buckets, their counts)."""
        total, words, features = np.zeros(self.buckets, np.int64), 0, 0
        carried = ""  # words of the piece before that windows may begin with
        for part in pieces(text):
            low = part.translate(_LOWER)
            found = self.split.pre_tokenize_str(low)
            words += len(found)
            if self.longest == 1:
                found_in = [self.bucket(w) for w, _ in found]
            else:
                held = carried.split(" ") if carried else []
                line = " ".join([*held, *(low[s:e] for _, (s, e) in found)])
                start = np.concatenate(([0], np.cumsum([len(w) + 1 for w in [*held, *(w for w, _ in found)]]))).astype(np.int64)
                first = len(held)
                found_in = [self.bucket(line[start[i] : start[i + n] - 1]) for n in range(self.shortest, self.longest + 1) for i in range(max(0, first - n + 1), len(start) - n)]
                carried = " ".join(line.split(" ")[-(self.longest - 1) :]) if line else ""
            features += len(found_in)
            total += np.bincount(np.array(found_in, np.int64), minlength=self.buckets)
        some = np.flatnonzero(total)
        return words, features, some, total[some]


_COUNTED = "doc_id long, n_words long, n_features long, buckets binary, counts binary"


def _count(batches: Iterator[pa.RecordBatch], shortest: int, longest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    f = Features(shortest, longest, buckets)
    for batch in batches:
        rows = [f.of(t) if t else (0, 0, np.zeros(0, np.int64), np.zeros(0, np.int64)) for t in (x.as_py() for x in batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].astype("<u4").tobytes() for r in rows], pa.binary()), pa.array([r[3].astype("<u4").tobytes() for r in rows], pa.binary())],
            names=["doc_id", "n_words", "n_features", "buckets", "counts"],
        )


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u4")


def _histogram(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """One histogram of a task's texts: a row for each bucket at most."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        np.add.at(total, _flat(batch, "buckets"), _flat(batch, "counts").astype(np.int64))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(total[some])], names=["bucket", "n"])


def counted(texts: DataFrame, doc_id: Column, text_col: str, shortest: int, longest: int, buckets: int, name: str) -> DataFrame:
    """Each text's words, features and bucket counts, stored."""
    rows = texts.select(doc_id.cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(lambda it: _count(it, shortest, longest, buckets), _COUNTED), name)[0]


def histogram(texts: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, of all texts: as many numbers as there are buckets."""
    rows = texts.select("buckets", "counts").mapInArrow(lambda it: _histogram(it, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # a row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket: the log of its smoothed frequencies' ratio, in thousandths, rounded down."""
    import math

    n, (S, T) = len(corpus), (float(corpus.sum()), float(target.sum()))
    # math.log, as vectorised ones may differ in the last bit
    return np.array([math.floor(GAIN_UNIT * math.log((t + 1.0) * (S + n) / ((s + 1.0) * (T + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.array([len(x) // 4 for x in batch.column("buckets").to_pylist()], np.int64)
        total = np.concatenate(([0], np.cumsum(gain[_flat(batch, "buckets")] * _flat(batch, "counts").astype(np.int64))))
        end = np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(total[end] - total[end - sizes])], names=["doc_id", "n_words", "n_features", "weight"])


def resample(docs: DataFrame, target: DataFrame, percent: float = 10, min_words: int = 20, ngrams: Sequence[int] = (1, 1), buckets: int = BUCKETS, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each document; rank is null for those that aren't drawn.

    Of the documents with min_words words or more, percent % (rounded down) with the highest scores
    are drawn; rank counts them from 1, ties in order of doc_id.  Null and empty texts, and texts without a
    word, have no features and weight 0.  Rows without id are scored as the empty id and come last in ties;
    repeated rows are scored and ranked one by one.  An empty target leaves gains that rare words have;
    an empty table gives none.  Other columns are ignored.  ngrams are the shortest and longest runs of words.
    """
    shortest, longest = ngrams
    corpus = counted(docs, F.col(id_col), text_col, shortest, longest, buckets, "importance-documents")
    wanted = counted(target, F.lit(None), target_col, shortest, longest, buckets, "importance-target")
    gain = gains(histogram(corpus, buckets), histogram(wanted, buckets))
    weighed = corpus.mapInArrow(lambda it: _weigh(it, gain), "doc_id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-GAIN_UNIT * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("long")
    scored = weighed.withColumn("score", F.col("weight") + noise).withColumn("__out", F.col("n_words") < min_words)
    ranged, pieces_ = in_order(scored, [F.col("__out"), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), *map(F.col, ("weight", "n_features"))], "importance-order", ["__out"])
    drawn = int(percent * ranged.where(~F.col("__out")).count() // 100)
    told = pieces_.select(F.col("__out").alias("__none"), F.col("__part").alias("__range"), "__shift")
    rank = F.col("__at") + F.col("__shift") + 1
    placed = ranged.join(told, (F.col("__out") == F.col("__none")) & (F.col("__part") == F.col("__range")))
    return placed.select("doc_id", "n_features", "weight", "score", F.when(~F.col("__out") & (rank <= drawn), rank).alias("rank"))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs whose id resample() draws, ids being distinct; rows without id aren't drawn here."""
    chosen = resample(docs, target, id_col=id_col, **options).where("rank is not null and doc_id is not null").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(chosen, docs[id_col].cast("long") == F.col("__drawn"), "left_semi")


ORACLE = r"""
WITH RECURSIVE k AS (
  -- the CRC-32 table, by its rule
  SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n, [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(n))
), f AS (
  SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), h AS (
  SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM f)
), v AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(('0x' || substr(x, 2 * i + 1, 2)) AS BIGINT) FOR i IN range(length(x) // 2)]), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket FROM h, k
), s AS (
  SELECT bucket, CAST(count(*) FILTER (kind = 'd') AS DOUBLE) AS s, CAST(count(*) FILTER (kind = 'b') AS DOUBLE) AS t FROM f JOIN v USING (w) GROUP BY bucket
), a AS (SELECT sum(s) AS ss, sum(t) AS tt FROM s
), g AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000)))) AS BIGINT) AS gain FROM s, a
), d AS (
  SELECT doc_id, count(w) AS n, CAST(coalesce(sum(gain), 0) AS BIGINT) AS weight FROM documents LEFT JOIN (SELECT id, w, gain FROM f JOIN v USING (w) JOIN g USING (bucket) WHERE kind = 'd') ON id = doc_id GROUP BY doc_id
), e AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('2024:' || doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total FROM e WHERE n >= 20
)
SELECT e.doc_id, e.n AS n_features, e.weight, e.score, CASE WHEN rank <= 10 * total // 100 THEN rank END AS rank FROM e LEFT JOIN r USING (doc_id)
"""
