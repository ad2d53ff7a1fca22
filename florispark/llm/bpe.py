"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

A text is normalised and its special strings are set apart.  A stretch of up to leaf_chars is
encoded in one piece.  A longer one is halved, anywhere, until its leaves are short enough; the
leaves are rows of their own and are encoded in parallel; then halves are concatenated pairwise
up the tree.  At each join a window around it is encoded again.  The window grows until it agrees
with both sides exactly:

* on the left it begins where the left side has the start of a token, so what is before stands;
* on the right it must reach a place where window and right side both begin a pre-token (from
  there on the scan of the text is the same), or, inside one long pre-token, share a token.

BPE needs no more than that: a sequence of tokens is the encoding of a pre-token if and only if
each adjacent pair is the encoding of its own text, and every pair of the joined sequence comes
from one of the three encodings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import from_planes, planes
from .pretoken import encoder

LEAF_CHARS = 16_384
CACHE_WORDS = 100_000
_LEAF = "uid string, part int, doc_id long, leaf int, special boolean, text string, ids binary, first binary"


class Coder:
    """Word-level encoding with a bounded cache, from which words that came again go last; decoding as the library does without a decoder."""

    def __init__(self, path: str):
        self.enc = encoder(path)
        tok = self.enc.whole
        self.token = [tok.id_to_token(i) for i in range(tok.get_vocab_size(with_added_tokens=True))]
        self.size = np.array([0 if t is None else len(t.removesuffix("</w>")) for t in self.token])
        self.last = np.array([bool(t) and t.endswith("</w>") for t in self.token])
        # of each word its ids and what they decode to; the older ones are those not seen since the newer ones were begun
        self.cache: tuple[dict[str, bytes], dict[str, str]] = {}, {}
        self.older: tuple[dict[str, bytes], dict[str, str]] = {}, {}

    def fill(self, words: list[str]) -> None:
        distinct = set(words)
        new = [w for w in distinct if w not in self.cache[0]]
        if len(self.cache[0]) + len(new) > CACHE_WORDS // 2:
            self.older, self.cache = self.cache, ({}, {})
            new = list(distinct)
        coded, decoded = self.cache
        if self.older[0]:
            (ids, text), missing = self.older, []
            for w in new:
                if w in ids:
                    coded[w], decoded[w] = ids[w], text[w]
                else:
                    missing.append(w)
            new = missing
        if new:
            ids, end = self.coded(new)
            tokens, data, low = [self.token[i] for i in ids.tolist()], ids.tobytes(), 0
            for w, high in zip(new, end.tolist(), strict=True):
                coded[w], decoded[w] = data[4 * low : 4 * high], " ".join(tokens[low:high])
                low = high

    def coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row, and where each word's end: at its token with the end mark, if all words have one."""
        if self.enc.special.keys().isdisjoint(words):
            ids = np.array(self.enc.row(words), "<u4")
            end = np.flatnonzero(self.last[ids]) + 1 if len(ids) else np.zeros(0, np.int64)
            if len(end) == len(words) and end[-1] == len(ids):
                return ids, end
        each = self.enc.ids(words)
        return np.array([i for x in each for i in x], "<u4"), np.cumsum([len(x) for x in each])

    def ids(self, words: list[str]) -> bytes:
        return b"".join(map(self.cache[0].__getitem__, words))

    def decoded(self, words: list[str]) -> str:
        return " ".join(map(self.cache[1].__getitem__, words))

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode(ids, skip_special_tokens=False): this vocabulary has no decoder, so tokens are joined by spaces."""
        return " ".join([self.token[i] for i in ids.tolist()])

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each token of a normalised text: id, start and end (in bytes of its UTF-8), and whether it begins a pre-token."""
        at, words = self.enc.placed(text)
        self.fill(words)
        coded = list(map(self.cache[0].__getitem__, words))
        counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        ids = np.frombuffer(b"".join(coded), "<u4")
        if not len(ids):
            return ids, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        if not text.isascii():
            wide = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            at = np.concatenate(([0], np.cumsum(1 + (wide >= 0x80) + (wide >= 0x800) + (wide >= 0x10000))))[at]
        size = self.size[ids]
        ends = np.cumsum(size)
        word = np.repeat(np.arange(len(words)), counts)
        before = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))[:-1]]
        end = ends - before[word] + at[word]
        first = np.zeros(len(ids), dtype=bool)
        first[np.cumsum(counts) - counts] = True
        return ids, end - size, end, first


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def leaves(text: str, most: int) -> list[str]:
    """Halves of halves of a text, in order, of at most `most` characters."""
    if len(text) <= most:
        return [text]
    half = len(text) // 2
    return leaves(text[:half], most) + leaves(text[half:], most)


class Side:
    """An encoded stretch of text: its bytes, and its tokens' ids, byte spans and pre-token starts."""

    def __init__(self, data: bytes, ids: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray):
        self.data, self.ids, self.start, self.end, self.first = data, ids, start, end, first


def join(c: Coder, a: Side, b: Side, window: int = 64) -> Side:
    """The encoding of a's text followed by b's, from theirs and from windows around the join."""
    data, m = a.data + b.data, len(a.data)
    while True:
        # begin with a token of the left side, preferably the first of a pre-token
        low, high = max(0, m - window), min(len(data), m + window)
        i = int(np.searchsorted(a.start, low, side="right")) - 1
        near = np.flatnonzero(a.first[: max(i + 1, 0)])
        whole = low == 0 or i < 0
        if whole:
            i, begin = 0, 0
        elif len(near) and a.start[near[-1]] >= low - 4 * window:
            i, whole = int(near[-1]), True
            begin = int(a.start[i])
        else:
            # inside a long pre-token; at the start of a character that can't begin another pattern
            while i > 0 and (data[a.start[i]] & 0xC0 == 0x80 or data[a.start[i]] == 0x27) and not a.first[i]:
                i -= 1
            begin, whole = int(a.start[i]), bool(a.first[i])
        while high < len(data) and data[high] & 0xC0 == 0x80:
            high += 1
        ids, start, end, first = c.spans(data[begin:high].decode("utf-8"))
        start, end = start + begin, end + begin
        bstart, bend = b.start + m, b.end + m
        k = 0
        if not whole:
            # the first token may differ at the cut; begin behind a token that both have
            same = np.flatnonzero(np.isin(start, a.start[i:]) & (start < m)) if len(ids) else np.zeros(0, int)
            k = -1
            for x in same:
                y = int(np.searchsorted(a.start, start[x]))
                if a.end[y] == end[x] and a.ids[y] == ids[x] and not c.last[ids[x]]:
                    k, i = int(x), y
                    break
        done = high == len(data) and k >= 0
        cut_w, cut_b = len(ids), len(b.ids)
        if not done and k >= 0:
            done, cut_w, cut_b = _meet(c, ids, start, end, first, b, bstart, bend, m, high, k)
        if done:
            take = slice(k, cut_w)
            out = [np.concatenate((x[:i], y[take], z[cut_b:])) for x, y, z in ((a.ids, ids, b.ids), (a.start, start, bstart), (a.end, end, bend), (a.first, first if whole else np.where(np.arange(len(first)) == 0, a.first[i] if k == 0 and len(a.first) > i else False, first), b.first))]
            return Side(data, *out)
        window *= 4


def _meet(c: Coder, ids, start, end, first, b: Side, bstart, bend, m: int, high: int, k: int) -> tuple[bool, int, int]:
    """Where window and right side agree: (found, tokens to take of the window, tokens of the right side to leave)."""
    here = np.flatnonzero(first & (start >= m) & (start < high - 3) & (np.arange(len(ids)) > k))  # a pattern looks 3 bytes ahead
    there = set(bstart[b.first].tolist())
    for x in here:
        if int(start[x]) in there:
            return True, int(x), int(np.searchsorted(bstart, start[x]))
    # one pre-token spans the join and the window's end: a token that both have, not at an end
    if len(b.first) and not (first & (start > m)).any() and not b.first[1:][bstart[1:] < high].any():
        for x in np.flatnonzero((start > m) & (end < high) & ~c.last[ids]):
            y = int(np.searchsorted(bstart, start[x]))
            if y < len(bstart) and y > 0 and bstart[y] == start[x] and bend[y] == end[x] and b.ids[y] == ids[x]:
                return True, int(x), y
    return False, 0, 0


def tree(c: Coder, sides: list[Side]) -> Side:
    while len(sides) > 1:
        sides = [join(c, *sides[i : i + 2]) if i + 1 < len(sides) else sides[i] for i in range(0, len(sides), 2)]
    return sides[0]


def digest(ids: bytes, decoded: str) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """(doc_id, ids binary, decoded string) of each row: ids are little-endian unsigned 32-bit integers.

    Equal to the library's encode(text, add_special_tokens=False).ids and
    decode(ids, skip_special_tokens=False).  Null texts count as empty and have no ids.  Repeated
    rows and null ids are kept, one result row for each; other columns are ignored.
    """
    return _encoded(docs, vocab_path, id_col, text_col, leaf_chars, False)


def encoding_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row; see encode()."""
    return _encoded(docs, vocab_path, id_col, text_col, leaf_chars, True)


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, leaf_chars: int, digests: bool) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids binary, decoded string"
    short = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= leaf_chars).mapInArrow(lambda it: _short(it, path, digests), out)
    # a long text: its leaves are rows, dealt out one by one, encoded, and gathered by text
    long = docs.where(F.length("text") > leaf_chars).mapInArrow(lambda it: _split(it, path, leaf_chars), _LEAF.partition(", ids")[0])
    coded = long.repartition("uid", "leaf").mapInArrow(lambda it: _leaf(it, path), _LEAF)
    joined = coded.groupBy("uid").applyInArrow(lambda table: _join_text(table, path, digests), out)
    return short.union(joined)


def _results(doc_id: pa.Array, rows: list[tuple], digests: bool) -> list[pa.Array]:
    kinds = (pa.int64(), pa.string(), pa.string()) if digests else (pa.binary(), pa.string())
    return [doc_id, *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))]


def _names(digests: bool) -> list[str]:
    return ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "ids", "decoded"]


def _short(batches: Iterator[pa.RecordBatch], path: str, digests: bool) -> Iterator[pa.RecordBatch]:
    c = coder(path)
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            words = c.enc.pretokens(text) if text else []
            c.fill(words)
            ids, decoded = c.ids(words), c.decoded(words)
            rows.append(digest(ids, decoded) if digests else (ids, decoded))
        yield pa.RecordBatch.from_arrays(_results(batch.column(0), rows, digests), names=_names(digests))


def _split(batches: Iterator[pa.RecordBatch], path: str, most: int) -> Iterator[pa.RecordBatch]:
    """Leaves of long texts.  A text is named by its id and a hash, so a task that runs again names it alike."""
    enc = encoder(path)
    for batch in batches:
        for i in range(batch.num_rows):
            key, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            uid = f"{key}:{hashlib.blake2b(text.encode(), digest_size=16).hexdigest()}"
            rows = [(p, n, special, x) for p, (special, t) in enumerate(enc.parts(text)) for n, x in enumerate([t] if special else leaves(enc.normalised(t), most))]
            part, leaf, special, stretch = (pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.bool_(), pa.string()), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([uid] * len(rows), pa.string()), part, pa.array([key] * len(rows), pa.int64()), leaf, special, stretch], names=["uid", "part", "doc_id", "leaf", "special", "text"])


def _leaf(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    c, pack = coder(path), zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        ids, first = [], []
        for special, text in zip(batch.column("special").to_pylist(), batch.column("text").to_pylist(), strict=True):
            i, s, e, f = c.spans("") if special else c.spans(text)
            ids.append(pack(planes(i) + planes(np.diff(s, prepend=0))))
            first.append(np.packbits(f).tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), pa.array(first, pa.binary())], names=[*batch.schema.names, "ids", "first"])


def _join_text(table: pa.Table, path: str, digests: bool) -> pa.Table:
    """Of a text's leaves: a result row for each of the rows that had this id and text."""
    c, ids, copies = coder(path), [], 0
    parts: dict[int, list[dict]] = {}
    seen = set()
    for row in table.select(["part", "leaf", "special", "text", "ids", "first"]).sort_by([("part", "ascending"), ("leaf", "ascending")]).to_pylist():
        copies += (row["part"], row["leaf"]) == (0, 0)
        if (row["part"], row["leaf"]) not in seen:
            seen.add((row["part"], row["leaf"]))
            parts.setdefault(row["part"], []).append(row)
    for _, part in sorted(parts.items()):
        if part[0]["special"]:
            ids.append(np.array([c.enc.special[part[0]["text"]]], "<u4"))
            continue
        sides = []
        for row in part:
            data = zstandard.decompress(row["ids"])
            i, gap = from_planes(data[: len(data) // 2]), from_planes(data[len(data) // 2 :])
            start = np.cumsum(gap.astype(np.int64))
            sides.append(Side(row["text"].encode(), i, start, start + c.size[i], np.unpackbits(np.frombuffer(row["first"], np.uint8), count=len(i)).astype(bool)))
        ids.append(tree(c, sides).ids)
    whole = np.concatenate([np.zeros(0, "<u4"), *ids])
    row = digest(whole.astype("<u4").tobytes(), c.decode(whole)) if digests else (whole.astype("<u4").tobytes(), c.decode(whole))
    return pa.Table.from_arrays(_results(table.column("doc_id").combine_chunks().slice(0, 1).take(pa.array([0] * copies)), [row] * copies, digests), names=_names(digests))
