"""Quality classifier by co-training: a text view and a page-metadata view teach each other.

Two things are told apart, each by a pair of classifiers: low quality and toxicity.  The text view
sees which words and beginnings of words a document has and figures of its make-up; the metadata view
sees source, its host, language and length.  Both are logistic, fitted on a bounded sample of labelled
documents (labelled_rows).  Then, in each round, both views score all documents, in one pass over
the table.  A document of which one view is sure, by its calibrated probability, is counted for the
other view: for each of its features, in how many documents of either class it is.  These counts,
over the whole table, are grouped by feature, and the log-odds of the features that tell classes apart
by more than chance become the other view's taught table: what the features of a document sum up to in
it is one more input when the view is fitted again.

Labelled documents fall into parts by the hash of their id: three fifths fit the views, one fifth
calibrates them, and one fifth, which neither has seen, fits the logistic combination of both views'
log-odds that scores all documents.

Only the sample, whose bound is a parameter, meets in one task; what all tasks get is its model and
the taught tables (taught_words features at most for each view and target).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, cut, mix, prefix_hash, shingles, span_hash, word_chunks

LABELLED_ROWS = 8000
TAUGHT_WORDS = 20_000
ROUNDS = 2
SURE = 0.97
MIN_DOCS = 8
LEAST_Z = 4.0
STEM_BYTES = 6
TARGETS = ("low_quality", "toxic")
CATEGORIES = 5
_FEATURES = "doc_id long, words binary, dense binary, meta binary, length double"

_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[list(b"#*$%&|<>")] = 1
_CLASS[list(b"!?")] = 2
_CLASS[list(b".,;:")] = 3
_CLASS[list(b"0123456789")] = 4
_CLASS[ord("A") : ord("Z") + 1] = 5
_CLASS[10] = 6


def figures(w: Words) -> np.ndarray:
    """Of each text: length, and shares of kinds of characters, distinct words and distinct word pairs."""
    n = np.diff(w.bounds).astype(float)
    size = np.maximum(np.diff(w.offset) - 1, 1).astype(float)
    text = np.repeat(np.arange(w.count), np.diff(w.offset))
    counts = np.bincount(text * 8 + _CLASS[w.data], minlength=8 * w.count).reshape(-1, 8)[:, 1:7] / size[:, None]
    shares = []
    for k in (1, 2):
        s, b = shingles(w, k)
        t = np.repeat(np.arange(w.count), np.diff(b))
        order = np.lexsort((s, t))
        s, t = s[order], t[order]
        new = np.ones(len(s), dtype=bool)
        new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
        shares.append(np.bincount(t[new], minlength=w.count) / np.maximum(np.diff(b), 1))
    chars = np.bincount(np.repeat(np.arange(w.count), np.diff(w.bounds)), weights=(w.end - w.start).astype(float), minlength=w.count) / np.maximum(n, 1)
    return np.column_stack((np.log1p(n), np.minimum(n, 50) / 50, chars, *counts.T, *shares))


def marks(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each word and of each word's beginning."""
    start = w.start + np.repeat(w.offset[:-1], np.diff(w.bounds))
    end = w.end + np.repeat(w.offset[:-1], np.diff(w.bounds))
    text = np.repeat(np.arange(w.count), np.diff(w.bounds))
    long = end - start > STEM_BYTES
    stems = span_hash(prefix_hash(w.data), start[long], start[long] + STEM_BYTES)
    return np.concatenate((w.hash, stems)), np.concatenate((text, text[long]))


def categories(lang: list[str | None], source: list[str | None], length: np.ndarray) -> np.ndarray:
    """Hashed categories of the metadata view, CATEGORIES for each document."""
    size = [int(2 * np.log2(1 + x)) for x in length]
    host = [None if x is None else x.split("://")[-1].split("/")[0] for x in source]
    kinds = [[f"lang={x}" for x in lang], [f"source={x}" for x in source], [f"host={x}" for x in host], [f"length={x}" for x in size], [f"both={x}/{y}" for x, y in zip(host, size, strict=True)]]
    words = [next(word_chunks(pa.array([v.replace(" ", "_") for v in kind]), lower=False, chunk_bytes=1 << 40)) for kind in kinds]
    return np.column_stack([x.hash for x in words]) if len(lang) else np.zeros((0, CATEGORIES), np.uint64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, Words, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of (doc_id, text, lang, source, n_chars): first row, words, figures, metadata and length."""
    length = np.nan_to_num(np.array(batch.column(4).fill_null(0).to_pylist(), dtype=float)).clip(0)
    meta = categories(batch.column(2).to_pylist(), batch.column(3).to_pylist(), length)
    for w in word_chunks(batch.column(1), lower=False):
        part = slice(w.first, w.first + w.count)
        low = next(word_chunks(batch.column(1).slice(w.first, w.count), lower=True, chunk_bytes=1 << 40, breaks=b".,;:!?\"()"))
        low.first = w.first
        yield w.first, low, figures(w), meta[part], np.log1p(length[part])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, w, dense, meta, length in _texts(batch):
            h, text = marks(w)
            order = np.argsort(text, kind="stable")
            words = [np.unique(x).tobytes() for x in np.split(h[order], np.searchsorted(text[order], np.arange(1, w.count)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, w.count), pa.array(words, pa.binary()), pa.array([x.tobytes() for x in dense], pa.binary()), pa.array([x.tobytes() for x in meta], pa.binary()), pa.array(length)],
                names=["doc_id", "words", "dense", "meta", "length"],
            )


class Table:
    """Numbers of hashed features, looked up for many documents at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values, self.maybe = keys, values, None  # keys ascend

    def __getstate__(self) -> dict:
        return {"keys": self.keys, "values": self.values, "maybe": None}  # what can be made again isn't sent

    def find(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(feature, row), once each, of what hashed values are features."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.maybe is None:
            self.maybe = np.zeros(1 << 20, dtype=bool)
            self.maybe[self.keys & np.uint64((1 << 20) - 1)] = True
        some = np.flatnonzero(self.maybe[h & np.uint64((1 << 20) - 1)])
        at = np.searchsorted(self.keys, h[some]).clip(0, len(self.keys) - 1)
        ok = self.keys[at] == h[some]
        pairs = np.unique(row[some][ok] * len(self.keys) + at[ok])
        return pairs % len(self.keys), pairs // len(self.keys)

    def sums(self, h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        feature, row = self.find(h, row)
        return np.bincount(row, weights=self.values[feature], minlength=rows)


NOTHING = Table(np.zeros(0, np.uint64), np.zeros(0))


@dataclass
class View:
    """A logistic model on hashed features, which are there or not, on dense ones, and on what the other view has taught."""

    weights: Table
    taught: Table
    mean: np.ndarray
    scale: np.ndarray
    dense: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, h: np.ndarray, row: np.ndarray, dense: np.ndarray) -> np.ndarray:
        rows = len(dense)
        dense = np.column_stack((dense, self.taught.sums(h, row, rows)))
        raw = self.bias + ((dense - self.mean) / self.scale).clip(-5, 5) @ self.dense
        return self.shift + self.slope * (raw + self.weights.sums(h, row, rows))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(feature: np.ndarray, row: np.ndarray, dense: np.ndarray, y: np.ndarray, sizes: int, l2: float, steps: int = 300) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of a logistic model by Adam on all rows."""
    w = np.zeros(sizes + dense.shape[1] + 1)
    m, v, n = np.zeros_like(w), np.zeros_like(w), max(len(y), 1)
    w[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    for t in range(1, steps + 1):
        p = sigmoid(np.bincount(row, weights=w[feature], minlength=len(y)) + dense @ w[sizes:-1] + w[-1])
        r = (p - y) / n
        g = np.concatenate((np.bincount(feature, weights=r[row], minlength=sizes), dense.T @ r, [r.sum()]))
        g[:-1] += l2 * w[:-1] / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return w[:sizes], w[sizes:-1], float(w[-1])


class Sample:
    """One view's features of the sample."""

    def __init__(self, lists: list[np.ndarray], dense: np.ndarray):
        self.h = np.concatenate([np.zeros(0, np.uint64), *lists])
        self.of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        keys = np.sort(self.h)
        first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
        self.keys, self.raw = keys[first[np.diff(first, append=len(keys)) >= MIN_DOCS]], dense
        del keys, first  # most features are in few documents
        at = np.searchsorted(self.keys, self.h)
        keep = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == self.h) if len(self.keys) else np.zeros(0, np.int64)
        self.feature, self.row = at[keep], self.of[keep]

    def fit(self, rows: np.ndarray, y: np.ndarray, l2: float, taught: Table = NOTHING) -> View:
        number = np.full(len(self.raw), -1)
        number[rows] = np.arange(len(rows))
        inside = number[self.row] >= 0
        feature, row = self.feature[inside], number[self.row[inside]]
        # only features that tell the classes apart by more than chance
        c1 = np.bincount(feature, weights=y[row], minlength=len(self.keys))
        c0 = np.bincount(feature, minlength=len(self.keys)) - c1
        chosen = np.flatnonzero(np.abs(z_score(c1, c0, max(y.sum(), 1), max((1 - y).sum(), 1))) >= LEAST_Z)
        place = np.full(len(self.keys), -1)
        place[chosen] = np.arange(len(chosen))
        some = place[feature] >= 0
        dense = np.column_stack((self.raw, taught.sums(self.h, self.of, len(self.raw))))
        mean, scale = dense.mean(axis=0), dense.std(axis=0) + 1e-6
        w, d, b = fit(place[feature[some]], row[some], ((dense - mean) / scale).clip(-5, 5)[rows], y, len(chosen), l2)
        return View(Table(self.keys[chosen], w), taught, mean, scale, d, b)

    def logit(self, view: View) -> np.ndarray:
        return view.logit(self.h, self.of, self.raw)


def z_score(c1: np.ndarray, c0: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Of a feature in c1 of n1 documents of one class and c0 of n0 of the other."""
    share = (c1 + c0) / (n1 + n0)
    return (c1 / n1 - c0 / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)


def platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make log-odds of scores; never a negative slope."""
    none = np.zeros(0, np.int64)
    scale = x.std() + 1e-6
    _, d, b = fit(none, none, ((x - x.mean()) / scale)[:, None], y, 0, 1.0, 200)
    slope = max(float(d[0]) / scale, 0.0)
    return slope, b - slope * float(x.mean())


FIT, CALIBRATE, COMBINE = range(3)


def fit_views(text: Sample, meta: Sample, y: np.ndarray, part: np.ndarray, taught: tuple[Table, Table] = (NOTHING, NOTHING)) -> dict:
    """Both calibrated views and the weights of their combination; y is NaN where there is no label."""
    fitted, tested, last = (np.flatnonzero(~np.isnan(y) & (part == x)) for x in (FIT, CALIBRATE, COMBINE))
    views, none = [], np.zeros(0, np.int64)
    for s, table, l2 in zip((text, meta), taught, (0.05, 3.0), strict=True):
        view = s.fit(fitted, y[fitted], l2, table)
        view.slope, view.shift = platt(s.logit(view)[tested], y[tested])
        views.append(view)
    both = np.column_stack([text.logit(views[0]), meta.logit(views[1])])[last]
    _, weights, bias = fit(none, none, both, y[last], 0, 1.0, 400)
    return {"views": views, "weights": np.maximum(weights, 0), "bias": bias}


def _fit(pdf: pd.DataFrame, taught: dict) -> pd.DataFrame:
    pdf = pdf.sort_values("doc_id", kind="stable")
    dense = np.stack([np.frombuffer(x) for x in pdf["dense"]])
    meta = [np.frombuffer(x, np.uint64) for x in pdf["meta"]]
    text = Sample([np.frombuffer(x, np.uint64) for x in pdf["words"]], dense)
    page = Sample(meta, pdf[["length"]].to_numpy())
    fifth = mix(pdf["doc_id"].to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(5)
    part = np.where(fifth == 0, CALIBRATE, np.where(fifth == 1, COMBINE, FIT))
    models = {}
    for target in TARGETS:
        y = pdf[target].to_numpy(dtype=float, na_value=np.nan)
        classes = [np.count_nonzero(y[part == side] == c) for side in (FIT, CALIBRATE, COMBINE) for c in (0, 1)]
        models[target] = fit_views(text, page, y, part, taught.get(target, (NOTHING, NOTHING))) if min(classes) >= 3 else None
    return pd.DataFrame({"model": [pickle.dumps(models)]})


def sample_of(docs: DataFrame, labels: DataFrame, labelled_rows: int) -> DataFrame:
    """Features and labels of the bounded sample of labelled documents, chosen by the hash of doc_id.

    Of rows with one id, the one with the smallest hash of its columns stands for all.
    """
    labels = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((1 - F.min("quality")).cast("double").alias("low_quality"), F.max("toxic").cast("double").alias("toxic"))
    chosen = labels.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)
    # at most labelled_rows ids, so it can be sent to all
    row = F.struct("text", "lang", "source", "n_chars")
    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min_by(row, F.struct(F.xxhash64(row), "text")).alias("row")).select("doc_id", "row.*")
    feats = texts.mapInArrow(_features, _FEATURES)
    return feats.join(F.broadcast(chosen), "doc_id").select(*feats.columns, *TARGETS)


TEXT, META = range(2)
_COUNT = "target int, view int, key long, n1 long, n0 long"


def sure_counts(texts: tuple[np.ndarray, np.ndarray], metas: tuple[np.ndarray, np.ndarray], probabilities: np.ndarray, target: int, sure: float) -> list[tuple[np.ndarray, ...]]:
    """(target, view, key, n1, n0) of what sure documents of one view tell the other; key 0 counts the documents.

    texts and metas are (hash, row) of either view's features, probabilities those of both views for each row.
    """
    out = []
    for teacher, learner, (h, row) in ((TEXT, META, metas), (META, TEXT, texts)):
        p = probabilities[:, teacher]
        certain, yes = (p >= sure) | (p <= 1 - sure), p > 0.5
        some = np.flatnonzero(certain[row])
        order = some[np.lexsort((h[some], row[some]))]
        once = np.ones(len(order), dtype=bool)  # a feature counts once for a document
        once[1:] = (h[order[1:]] != h[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
        some = order[once]
        h, row = np.concatenate((h[some], np.zeros(certain.sum(), np.uint64))), np.concatenate((row[some], np.flatnonzero(certain)))
        keys, inverse = np.unique(h, return_inverse=True)
        n1 = np.bincount(inverse, weights=yes[row], minlength=len(keys)).astype(np.int64)
        n = np.bincount(inverse, minlength=len(keys))
        if len(keys):
            out.append((np.full(len(keys), target, np.int32), np.full(len(keys), learner, np.int32), keys, n1, n - n1))
    return out


def _teach(batches: Iterator[pa.RecordBatch], models: dict, sure: float) -> Iterator[pa.RecordBatch]:
    """Counts of sure documents, summed for some batches at a time."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> pa.RecordBatch:
        target, view, key, n1, n0 = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((key, view, target))
        target, view, key = target[order], view[order], key[order]
        first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (view[1:] != view[:-1]) | (target[1:] != target[:-1]))))
        return pa.RecordBatch.from_arrays([pa.array(target[first]), pa.array(view[first]), pa.array(key[first].view(np.int64)), *(pa.array(np.add.reduceat(x[order], first)) for x in (n1, n0))], names=[x.split()[0] for x in _COUNT.split(", ")])

    for batch in batches:
        for _, w, dense, meta, length in _texts(batch):
            texts, metas = marks(w), (meta.ravel(), np.repeat(np.arange(w.count), meta.shape[1]))
            for i, target in enumerate(TARGETS):
                if models[target] is not None:
                    views = models[target]["views"]
                    p = sigmoid(np.column_stack((views[TEXT].logit(*texts, dense), views[META].logit(*metas, length[:, None]))))
                    held += sure_counts(texts, metas, p, i, sure)
            if sum(len(x[0]) for x in held) > 1 << 18:
                yield flush()
    if held:
        yield flush()


def log_odds(keys: np.ndarray, n1: np.ndarray, n0: np.ndarray, all1: float, all0: float) -> Table:
    order = np.argsort(keys)
    return Table(keys[order], np.clip(np.log((n1 + 1) / (all1 + 2)) - np.log((n0 + 1) / (all0 + 2)), -4, 4)[order])


def _taught(counts: DataFrame, most: int) -> dict:
    """Taught tables by target, from the summed counts of sure documents: the features that tell classes apart best, `most` at most."""
    out: dict = {}
    totals = {(r.target, r.view): (r.n1, r.n0) for r in counts.where("key = 0").collect()}  # four rows at most
    for i, target in enumerate(TARGETS):
        tables = []
        for view in (TEXT, META):
            all1, all0 = totals.get((i, view), (0, 0))
            if not all1 or not all0:
                tables.append(NOTHING)  # of one class only: nothing to tell apart
                continue
            n1, n0, share = F.col("n1"), F.col("n0"), (F.col("n1") + F.col("n0")) / F.lit(float(all1 + all0))
            z = F.abs(n1 / F.lit(float(all1)) - n0 / F.lit(float(all0))) / F.sqrt(share * (1 - share) * F.lit(1 / all1 + 1 / all0) + 1e-12)
            some = counts.where((F.col("target") == i) & (F.col("view") == view) & (F.col("key") != 0) & (n1 + n0 >= MIN_DOCS) & (z >= LEAST_Z))
            best = some.select("key", "n1", "n0").orderBy(z.desc(), "key").limit(most).collect()
            keys, n1, n0 = (np.array([r[c] for r in best], dtype=np.int64) for c in ("key", "n1", "n0"))
            tables.append(log_odds(keys.view(np.uint64), n1, n0, all1, all0))
        out[target] = tuple(tables)
    return out


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, rounds: int = ROUNDS, sure: float = SURE, taught_words: int = TAUGHT_WORDS) -> dict:
    """Models by target; None where the sample has too few labels of a class.

    Each round is a pass over all of docs.  Labels of documents that docs hasn't aren't used; null or
    repeated labels count as the worst that is said of a document.
    """
    docs = _columns(docs)
    sample, context = cut(sample_of(docs, labels, labelled_rows)), docs.sparkSession.sparkContext
    fitted = lambda taught: sample.groupBy(F.lit(0).alias("all")).applyInPandas(lambda pdf: _fit(pdf, taught), "model binary").collect()
    taught: dict = {}
    for i in range(rounds + 1):
        rows = fitted(taught)
        models = pickle.loads(rows[0].model) if rows else dict.fromkeys(TARGETS)
        if i == rounds or not any(models.values()):
            return models
        sent = context.broadcast(models)
        counts = docs.mapInArrow(lambda it, sent=sent: _teach(it, sent.value, sure), _COUNT).groupBy("target", "view", "key").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        taught = _taught(cut(counts.where(f"key = 0 or n1 + n0 >= {MIN_DOCS}")), taught_words)
        sent.destroy()  # the counts are stored


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("double"))


def _score(batches: Iterator[pa.RecordBatch], models: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, w, dense, meta, length in _texts(batch):
            (h, row), mrow = marks(w), np.repeat(np.arange(w.count), meta.shape[1])
            out = []
            for target in TARGETS:
                model = models[target]
                if model is None:
                    out += [np.zeros(w.count)] * 3
                    continue
                text, page = model["views"]
                logits = np.column_stack((text.logit(h, row, dense), page.logit(meta.ravel(), mrow, length[:, None])))
                out += [sigmoid(logits[:, 0]), sigmoid(logits[:, 1]), sigmoid(logits @ model["weights"] + model["bias"])]
            empty = np.diff(w.bounds) == 0
            out[2] = np.where(empty, 1.0, out[2])
            kept = (out[2] < 0.5) & (out[5] < 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, w.count), *map(pa.array, out), pa.array(kept)], names=[x.split()[0] for x in _SCORES.split(", ")])


_SCORES = "doc_id long, text_low_quality double, meta_low_quality double, p_low_quality double, text_toxic double, meta_toxic double, p_toxic double, kept boolean"


def score(docs: DataFrame, models: dict) -> DataFrame:
    """Calibrated probabilities of both views and of their combination, and the verdict, for each row.

    Documents without a word are of low quality.  A target without a model rejects nothing.  Null
    source, language or length are values like others; repeated rows and null ids are scored
    like all; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(models)
    return _columns(docs).mapInArrow(lambda it: _score(it, sent.value), _SCORES)


def keep_good(docs: DataFrame, models: dict) -> DataFrame:
    """The rows of docs that the verdict keeps, as they are.

    Null and empty texts go; null ids, sources, languages and lengths are values like others; each of
    repeated rows is judged by itself, so all of them stay or go; other columns are carried along.
    """
    sent, names = docs.sparkSession.sparkContext.broadcast(models), docs.columns
    need = ["doc_id", "text", "lang", "source", "n_chars"]
    kinds = dict(doc_id=pa.int64(), n_chars=pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            view = pa.RecordBatch.from_arrays([batch.column(names.index(c)).cast(kinds.get(c, pa.string())) for c in need], names=need)
            kept = [x for part in _score([view], sent.value) for x in part.column(7).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
