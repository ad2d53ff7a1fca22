"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

Which documents meet in a tile is decided without loss.  Sizes of sets are cut into bands so that
two sets that link are in one band or in neighbouring ones.  For a pair of bands, linked sets
differ in at most D shingles, so if shingles are dealt by hash into groups of which D + 1 hold
something, one of these is equal in both; the hash of each is a key.  There are some groups more
than D + 1, and a set that leaves more than those empty is dealt again with another hash until it
doesn't, so that no equal group can hide among empty ones.  Documents with a common key are tied to the smallest of them, which gives
families; a key that very many documents share costs one edge for each of them, not pairs.

Copies with equal sets are one row of their family.  A family of up to TILE sets is one tile.  A larger
one is contracted: each member is compared with its hubs, the smallest sets of most of its keys where keys are tied together, as many rows
as it has hubs; what is linked so is connected.  Of what isn't connected then, only sets that share a key have to meet: a key whose sets
are all connected is done with, and any other is a tile, or several where many sets share it.  Of these sets the
largest connected part is dealt into blocks, the rest goes to all of them; two of the largest part never meet.  So families of near copies,
and chains of texts that drift, cost rows, not pairs.
In a tile, each set has a hashed bitmap; a bit that one set has and the other has not is a shingle outside
the overlap, so bit counts bound the overlap from above.  Bitmaps, a small part of the sets, are what is dealt to tiles and hubs.
What passes, and isn't connected yet, meets again with its text's sets, once however many tiles it passed in, and is
decided by exact intersection of sorted arrays.  Each of these tiles returns a spanning forest of its links.
Keys of large families are made anew from the texts; those that one document has are left out first by a
bitmap of the keys that several have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, distinct_by_text, kept, mix, partitions, shingles, word_chunks

TILE = 256
PACKET_KEYS = 1 << 19
KEY_BUCKET_BYTES = 8 << 20
MOST_BITS = 8192  # of a set's bitmap
MOST_KEY_BITS = 28  # 2**28 bits, of the bitmap of keys that several documents have


def band_floors(percent: int, most: int) -> np.ndarray:
    """Smallest size of each band, up to sizes of `most`."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, -(-100 * out[-1] // percent)))
    return np.array(out, dtype=np.int64)


def group_counts(floors: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs whose smaller set is in band b: groups, and how many may be empty.

    Groups that hold something number one more than the most shingles in which such a pair
    differs; some more groups are there for those that chance leaves empty.
    """
    small = floors[1:] - 1
    least = (small + 100 * small // percent) * (100 - percent) // (100 + percent) + 1
    empty = least * np.exp(-floors[:-1] / least)
    spare = np.floor(empty + 3 * np.sqrt(empty)).astype(np.int64)
    return least + spare, spare


def keys_of(values: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, text) of the equal-group keys of each text's set of distinct shingles."""
    sizes = np.diff(bounds)
    floors = band_floors(percent, int(sizes.max(initial=1)))
    groups, spare = group_counts(floors, percent)
    band = np.searchsorted(floors, sizes, "right") - 1
    keys, texts = [], []
    for below in (0, 1):
        some = np.flatnonzero((sizes > 0) & (band >= below))
        attempt = 0
        while len(some):
            scheme = band[some] - below
            count = groups[scheme]
            base = np.concatenate(([0], np.cumsum(count)))
            at = np.concatenate([np.arange(bounds[t], bounds[t + 1]) for t in some]) if len(some) < len(sizes) else np.arange(len(values))
            owner = np.repeat(np.arange(len(some)), sizes[some])
            h = mix(values[at] ^ np.uint64(0xC2B2AE3D27D4EB4F * (2 * attempt + 1) % 2**64))
            slot = base[owner] + ((h >> np.uint64(32)) * count[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            total = np.zeros(base[-1], dtype=np.uint64)
            np.add.at(total, slot, h)
            held = np.bincount(slot, minlength=base[-1])
            of = np.repeat(np.arange(len(some)), count)
            number = np.arange(base[-1]) - base[of]
            tag = (scheme[of] * 4096 + attempt).astype(np.uint64) * np.uint64(0x100000001B3) + number.astype(np.uint64)
            full = held > 0
            keys.append(mix(total[full] ^ mix(tag[full])))
            texts.append(some[of[full]])
            some = some[np.bincount(of[~full], minlength=len(some)) > spare[scheme]]
            attempt += 1
    return np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *texts])


def packed(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """A hashed bitmap of each text's set, about two bits or more for each member; one folds into a shorter one by halves."""
    sizes = np.diff(bounds)
    bits = np.full(len(sizes), 64, dtype=np.int64)
    while (short := (bits < 2 * sizes) & (bits < MOST_BITS)).any():
        bits[short] *= 2
    base = np.concatenate(([0], np.cumsum(bits)))
    flat = np.zeros(base[-1], dtype=bool)
    flat[np.repeat(base[:-1], sizes) + (values & (np.repeat(bits, sizes) - 1).astype(np.uint64)).astype(np.int64)] = True
    data = np.packbits(flat).tobytes()
    return [data[s // 8 : e // 8] for s, e in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def folded(bitmap: bytes, words: int) -> np.ndarray:
    """A bitmap as that of so many 64-bit words, which it has at least."""
    return np.bitwise_or.reduce(np.frombuffer(bitmap, np.uint64).reshape(-1, words), axis=0)


def may_link(n: int, bitmap: bytes, m: int, other: bytes, percent: int) -> bool:
    """False only where two sets of n and m members can't link."""
    words = min(len(bitmap), len(other)) // 8
    a, b = folded(bitmap, words), folded(other, words)
    most = min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))
    return 100 * most >= percent * (n + m - most)


def likely(n: np.ndarray, maps: list[bytes], side: np.ndarray, comp: np.ndarray, percent: int) -> np.ndarray:
    """Numbers of what pairs of a tile connect that may link and aren't connected yet; -1 where a set is in no such pair."""
    order = np.argsort(n, kind="stable")
    n, maps, side, comp = n[order], [maps[i] for i in order], side[order], comp[order]
    size, group, hit = len(n), np.arange(len(n)), np.zeros(len(n), dtype=bool)
    words, both, marks, low, now = np.array([len(x) // 8 for x in maps]), len(set(side.tolist())) > 1, None, 0, 0
    for i in range(size - 1):
        end = int(np.searchsorted(n, 100 * n[i] // percent, "right"))
        j = np.arange(i + 1, end)
        j = j[comp[j] != comp[i]]
        if both:
            j = j[side[j] != side[i]]
        if not len(j):
            continue
        if words[i] != now:  # bitmaps grow with the sets
            now, low = words[i], i
            last = int(np.searchsorted(words, now, "right")) - 1
            top = int(np.searchsorted(n, 100 * n[last] // percent, "right"))
            marks = np.stack([folded(x, now) for x in maps[low:top]])
        own, others = marks[i - low], marks[j - low]
        most = np.minimum(n[i] - np.bitwise_count(own & ~others).sum(axis=1, dtype=np.int64), n[j] - np.bitwise_count(~own & others).sum(axis=1, dtype=np.int64))
        j = j[100 * most >= percent * (n[i] + n[j] - most)]
        hit[i] |= len(j) > 0
        hit[j] = True
        for g in set(group[j].tolist()) - {group[i]}:
            group[group == g] = group[i]
    out = np.empty(size, dtype=np.int64)
    out[order] = np.where(hit, group, -1)
    return out


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in word_chunks(batch.column(1), lower=True):
            v, b = distinct_by_text(*shingles(w, k))
            digests = []
            for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9):
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(v ^ np.uint64(c)))))
                digests.append((total[b[1:]] - total[b[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first, w.count), pa.array(np.diff(b).astype(np.int64)), *map(pa.array, digests), pa.array(packed(v, b), pa.binary())], names=["doc_id", "n_shingles", "s1", "s2", "bits"])


_PACKET = "bucket int, edge boolean, keys binary, ids binary"


def smallest_of_keys(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys with their smallest id, and edges (id, hub) that connect all ids of each key.

    An id's hub is the smallest id of most of its keys; its keys' other smallest ids are connected with the hub.
    """
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    low = ids[first][np.cumsum(first) - 1]
    other = low != ids
    a, b = ids[other], low[other]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    a, b, times = a[at], b[at], np.diff(np.append(at, len(a)))
    order = np.lexsort((b, -times, a))
    a, b = a[order], b[order]
    best = np.ones(len(a), dtype=bool)
    best[1:] = a[1:] != a[:-1]
    hub = b[best][np.cumsum(best) - 1]
    more = ~best
    pairs = np.unique(np.stack((np.maximum(b[more], hub[more]), np.minimum(b[more], hub[more])), axis=1), axis=0)
    return keys[first], ids[first], np.concatenate((a[best], pairs[:, 0])), np.concatenate((b[best], pairs[:, 1]))


def others_of_keys(keys: np.ndarray, ids: np.ndarray, distinct: np.ndarray, smallest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One more id of each key that has several; distinct keys, sorted, come with their smallest id."""
    at = np.searchsorted(distinct, keys)
    several = np.flatnonzero(smallest[at] != ids)
    other = np.full(len(distinct), -1, dtype=np.int64)
    other[at[several]] = several
    found = other >= 0
    return distinct[found], ids[other[found]]


def shared_bits(bucket: int, keys: np.ndarray, buckets: int, bits: int) -> tuple[int, bytes]:
    """Of the bitmap of keys, by their first bits, the bytes of one bucket, and the number of the first."""
    ends = [-(-(i << 32) // buckets) >> (32 - bits) for i in (bucket, bucket + 1)]
    first = ends[0] // 8
    held = np.zeros(8 * (ends[1] // 8 + 1 - first), dtype=bool)
    held[(keys >> np.uint64(64 - bits)).astype(np.int64) - 8 * first] = True
    return first, np.packbits(held).tobytes()


def _packets(batches: Iterator[pa.RecordBatch], k: int, percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Keys in packets by bucket; equal keys of a packet are already tied to the smallest id (as a combiner does)."""
    held_keys: list[np.ndarray] = []
    held_ids: list[np.ndarray] = []
    made = TaskContext.get().partitionId()  # tasks begin with buckets of their own

    def flush() -> pa.RecordBatch:
        nonlocal made
        keys, ids, a, b = smallest_of_keys(np.concatenate(held_keys), np.concatenate(held_ids))
        more, other = others_of_keys(np.concatenate(held_keys), np.concatenate(held_ids), keys, ids)
        order = np.argsort(np.concatenate((keys, more)), kind="stable")
        keys, ids = np.concatenate((keys, more))[order], np.concatenate((ids, other))[order]
        held_keys.clear()
        held_ids.clear()
        edge = np.searchsorted(((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1).astype(np.uint64))
        rows = [(i, False, keys[s:e].tobytes(), ids[s:e].tobytes()) for i, (s, e) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if e > s]
        if len(a):
            rows.append((made % buckets, True, a.tobytes(), b.tobytes()))
        made += 1
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "edge", "keys", "ids"])

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for w in word_chunks(batch.column(1), lower=True):
            keys, text = keys_of(*distinct_by_text(*shingles(w, k)), percent)
            held_keys.append(keys)
            held_ids.append(ids[text + w.first].astype(np.int64))
            if sum(map(len, held_keys)) >= PACKET_KEYS:
                yield flush()
    if sum(map(len, held_keys)):
        yield flush()


_TIED = "a binary, b binary, first long, shared binary"


def _tie(pdf: pd.DataFrame, buckets: int, bits: int) -> pd.DataFrame:
    """Edges of one bucket of keys, in a row, and which keys several ids have."""
    load = lambda rows, name, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in rows[name])])
    new, old = pdf[~pdf["edge"]], pdf[pdf["edge"]]
    keys, ids = load(new, "keys", np.uint64), load(new, "ids", np.int64)
    distinct, smallest, a, b = smallest_of_keys(keys, ids)
    first, shared = shared_bits(int(pdf["bucket"].iloc[0]), others_of_keys(keys, ids, distinct, smallest)[0], buckets, bits)
    return pd.DataFrame({"a": [np.concatenate((a, load(old, "keys", np.int64))).tobytes()], "b": [np.concatenate((b, load(old, "ids", np.int64))).tobytes()], "first": [first], "shared": [shared]})


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different edges of a task's buckets: ids that share many keys are tied in each bucket, and leave the task once."""
    held: list[np.ndarray] = []

    def different() -> pa.RecordBatch:
        a, b = np.unique(np.concatenate(held, axis=1), axis=1)
        held[:] = [np.stack((a, b))]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0), batch.column(1), strict=True):
            held.append(np.stack((np.frombuffer(a.as_buffer(), np.int64), np.frombuffer(b.as_buffer(), np.int64))))
            if sum(x.shape[1] for x in held) >= PACKET_KEYS:
                made = different()
                if made.num_rows >= PACKET_KEYS // 2:
                    yield made
                    held.clear()
    if held:
        yield different()


def _arrays(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in word_chunks(batch.column(0), lower=True):
            v, b = distinct_by_text(*shingles(w, k))
            yield pa.RecordBatch.from_arrays([pa.array([v[s:e].tobytes() for s, e in zip(b[:-1], b[1:], strict=True)], pa.binary()), *(batch.column(i).slice(w.first, w.count) for i in range(1, batch.num_columns))], names=["shingles", *batch.schema.names[1:]])


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A hashed bitmap of each set, all of one length, about two bits for each member of the largest."""
    bits = 64
    while bits < min(8192, 2 * max(map(len, sets))):
        bits *= 2
    out = np.zeros((len(sets), bits), dtype=bool)
    for i, s in enumerate(sets):
        out[i, (s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def forest(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int, connected: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what the links of a tile connect; side tells two blocks of a tile apart (all equal: one block); connected numbers what is connected before."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, sets, side = ids[order], [sets[i] for i in order], side[order]
    comp = np.arange(len(sets)) if connected is None else np.unique(connected[order], return_inverse=True)[1]
    n, marks = np.array([len(s) for s in sets]), bitmaps(sets)
    links, both = [], len(set(side.tolist())) > 1
    for i in range(len(sets) - 1):
        j = np.arange(i + 1, int(np.searchsorted(n, 100 * n[i] // percent, "right")))
        j = j[comp[j] != comp[i]]
        if both:
            j = j[side[j] != side[i]]
        if not len(j):
            continue
        only_i = np.bitwise_count(marks[i] & ~marks[j]).sum(axis=1, dtype=np.int64)
        only_j = np.bitwise_count(~marks[i] & marks[j]).sum(axis=1, dtype=np.int64)
        most = np.minimum(n[i] - only_i, n[j] - only_j)
        for x in j[100 * most >= percent * (n[i] + n[j] - most)]:
            if comp[x] == comp[i]:
                continue
            at = np.searchsorted(sets[x], sets[i])
            overlap = np.count_nonzero(sets[x][np.minimum(at, n[x] - 1)] == sets[i])
            if 100 * overlap >= percent * (n[i] + n[x] - overlap):
                links.append((int(ids[i]), int(ids[x])))
                comp[comp == comp[x]] = comp[i]
    return links


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    overlap = np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)
    return 100 * overlap >= percent * (len(a) + len(b) - overlap)


def _unpack(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column]


def _tile(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of a tile of (rep, own, comp, shingles)."""
    found = forest(pdf["rep"].to_numpy(), _unpack(pdf["shingles"]), pdf["own"].to_numpy(), percent, pdf["comp"].to_numpy())
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


_CARD = "rep long, comp long, own long, x long, y long, z long, n long, bits binary"
_LIKELY = "rep long, comp long, own long, x long, y long"


def _likely(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of tiles, whose rows come one after the other, what has to be compared: it is named by its members, so that it is the same from whatever tile."""
    held: pa.Table | None = None

    def groups(rows: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
        rep, comp, own, x, y, z, n = (rows.column(i).to_numpy() for i in range(7))
        maps = rows.column(7).to_pylist()
        new = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])))
        edge = [*np.flatnonzero(new).tolist(), len(rep)]
        rest = len(rep) if last else edge[-2]
        at, group = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s, e in zip(edge[:-1], edge[1:], strict=True):
            if s < rest and e - s > 1:
                found = likely(n[s:e], maps[s:e], own[s:e], comp[s:e], percent)
                at.append(s + np.flatnonzero(found >= 0))
                group.append(s + found[found >= 0])
        rows_of, (_, of) = np.concatenate(at), np.unique(np.concatenate(group), return_inverse=True)
        named = []
        for c in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)):
            total = np.zeros(int(of.max(initial=-1)) + 1, dtype=np.uint64)
            np.add.at(total, of, mix(rep[rows_of].astype(np.uint64) ^ mix(own[rows_of].astype(np.uint64) + c)))
            named.append(pa.array(total[of].view(np.int64)))
        out = pa.RecordBatch.from_arrays([pa.array(rep[rows_of]), pa.array(comp[rows_of]), pa.array(own[rows_of]), *named], names=[x.split()[0] for x in _LIKELY.split(", ")])
        return out, rows.slice(rest).combine_chunks()

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held.cast(rows.schema), rows])
        if len(rows):
            out, held = groups(rows, False)
            yield out
    if held is not None and len(held):
        yield groups(held, True)[0]


def _alike(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, n, bits, m, others) that may link."""
    for batch in batches:
        n, bits, m, others = (batch.column(i).to_pylist() for i in range(2, 6))
        passed = [may_link(*x, percent) for x in zip(n, bits, m, others, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))


def _star(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links of a hub (the row with own) with some of those that share a key with it."""
    hub = pdf[pdf["own"]]
    ones, near = _unpack(hub["shingles"]), pdf[~pdf["own"]]
    linked = [r for r, x in zip(near["rep"], _unpack(near["shingles"]), strict=True) if any(links(x, one, percent) for one in ones)]
    return pd.DataFrame({"a": linked, "b": [hub["rep"].iloc[0]] * len(linked)}, dtype="int64")


def _shared_keys(batches: Iterator[pa.RecordBatch], k: int, percent: int, marked: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(doc_id, keys): of a text's keys those that are marked as common to several."""
    bits = np.uint64(64 - (8 * len(marked)).bit_length() + 1)
    for batch in batches:
        for w in word_chunks(batch.column(1), lower=True):
            keys, text = keys_of(*distinct_by_text(*shingles(w, k)), percent)
            at = keys >> bits
            some = (marked[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0
            keys, text = keys[some], text[some]
            order = np.argsort(text, kind="stable")
            parts = np.split(keys[order], np.searchsorted(text[order], np.arange(1, w.count)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first, w.count), pa.array([x.tobytes() for x in parts], pa.binary())], names=["doc_id", "keys"])


def _one_a_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rep, comp) of (keys, rep, comp)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            keys = [np.frombuffer(x, np.int64) for x in part.column(0).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(keys)), [len(x) for x in keys]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *(part.column(c).take(row) for c in ("rep", "comp"))], names=["key", "rep", "comp"])


def _arrays_of(docs: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """(rep, shingles): sets of the documents that are in reps; rows that repeat an id may differ in text."""
    return docs.join(reps.select("rep").distinct(), F.col("doc_id") == F.col("rep")).select("text", "rep").mapInArrow(lambda it: _arrays(it, k), "shingles binary, rep long").dropDuplicates(["rep", "shingles"])


def _by_hubs(cards: DataFrame, shared: DataFrame, docs: DataFrame, k: int, percent: int, tile: int) -> DataFrame:
    """Links (a, b) among pairs (a, b) of sets, b being a's hub, of which bitmaps let few pass.  A hub's set is sent once for every `tile` of its pairs."""
    one, two = cards.select(F.col("rep").alias("a"), "n", "bits"), cards.select(F.col("rep").alias("b"), F.col("n").alias("m"), F.col("bits").alias("others"))
    pairs = shared.join(one, "a").join(two, "b").select("a", "b", "n", "bits", "m", "others")
    shared = kept(pairs.mapInArrow(lambda it: _alike(it, percent), "a long, b long").distinct(), "likely-hubs")
    sets = kept(_arrays_of(docs, shared.select(F.col("a").alias("rep")).union(shared.select("b")), k), "sets-of-hubs")
    slots = shared.groupBy("b").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("slots"))
    near = shared.join(slots, "b").select(F.col("a").alias("rep"), F.col("b").alias("hub"), F.pmod(F.xxhash64("a"), F.col("slots")).cast("int").alias("slot"), F.lit(False).alias("own"))
    hubs = slots.select(F.col("b").alias("rep"), F.col("b").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"), F.lit(True).alias("own"))
    rows = near.union(hubs).join(sets.select("rep", "shingles"), "rep")
    return rows.groupBy("hub", "slot").applyInPandas(lambda pdf: _star(pdf, percent), "a long, b long")


def _by_keys(keys: DataFrame, tile: int) -> DataFrame:
    """Tiles (rep, comp, own, x, y, z) of sets that share a key and aren't connected; keys has (key, rep, comp) of families that aren't connected yet."""
    parts = keys.groupBy("key", "comp").agg(F.count("*").alias("n"))
    per = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("n").alias("total"), F.max(F.struct("n", "comp")).alias("most")).where("parts > 1")
    rows = keys.join(per.select("key", "total", F.col("most.comp").alias("largest")), "key")
    few_sets = rows.where(F.col("total") <= tile).groupBy("key").agg(F.array_sort(F.collect_set(F.struct("rep", "comp"))).alias("sets")).select("sets").distinct()  # one tile for all keys of the same sets
    nothing = F.lit(-1).cast("long")
    few_sets = few_sets.select(F.xxhash64("sets").alias("x"), F.xxhash64("sets", F.lit(1)).alias("z"), F.explode("sets").alias("s")).select("s.rep", "s.comp", nothing.alias("own"), "x", nothing.alias("y"), "z")
    # keys that many sets share go together if they have their largest part in common, so that two sets don't meet once for each key
    hot = rows.where(F.col("total") > tile).select("largest", "rep", "comp").distinct()
    big = F.col("comp") == F.col("largest")
    blocks = lambda test: F.ceil(F.count_if(test) / F.lit(tile)).cast("int")
    hot = hot.join(hot.groupBy("largest").agg(blocks(big).alias("many"), blocks(~big).alias("few")), "largest")
    hot = hot.withColumn("mine", F.pmod(F.xxhash64("rep"), F.when(big, F.col("many")).otherwise(F.col("few"))).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    # (y, z): a block of the rest with a block of the largest part (from 0) or with one of the rest (below 0)
    of_big = F.transform(every(F.col("few")), lambda i: F.struct(i.alias("y"), F.col("mine").alias("z")))
    of_rest = F.concat(
        F.transform(every(F.col("many")), lambda i: F.struct(F.col("mine").alias("y"), i.alias("z"))),
        F.transform(every(F.col("few")), lambda i: F.struct(F.least("mine", i).alias("y"), (-1 - F.greatest("mine", i)).alias("z"))),
    )
    own = F.when(big, F.lit(-2)).otherwise(F.col("mine")).cast("long").alias("own")
    dealt = hot.select("rep", "comp", own, F.col("largest").alias("x"), F.explode(F.when(big, of_big).otherwise(of_rest)).alias("p"))
    dealt = dealt.select("rep", "comp", "own", "x", F.col("p.y").cast("long").alias("y"), F.col("p.z").cast("long").alias("z"))
    return few_sets.union(dealt)


def _marked(tied: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of keys that several documents have, from those of the buckets; 32 MB at most."""
    out = np.zeros((1 << bits) // 8 + 1, dtype=np.uint8)
    for r in tied.select("first", "shared").toLocalIterator():
        part = np.frombuffer(r["shared"], np.uint8)[: len(out) - r["first"]]
        out[r["first"] : r["first"] + len(part)] |= part
    return out[:-1]


def ngram_jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row.

    Words are runs of bytes other than white space, in lower-case A-Z; a document's set has its
    distinct k-word shingles, or its whole sequence where it has fewer words.  Documents link when
    100 * |intersection| >= percent * |union|.  component_id is the smallest doc_id reachable.
    Null and empty texts have an empty set and link with nothing.  Ids should be distinct; rows
    that repeat an id are nodes of one name, each with a result row.  Rows without id link with
    nothing and have a null component.  Other columns are ignored.  Components are found in rounds,
    as many as the logarithm of the longest chain of links; 60 rounds without an end are an error.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = kept(docs.mapInArrow(lambda it: _sets(it, k), "doc_id long, n_shingles long, s1 long, s2 long, bits binary"), "sizes-of-sets")
    # a set has about a key for every 100 / (100 - percent) shingles in each of two schemes, of 16 bytes with the id
    size = sets.agg(F.sum(F.lit(64) + F.col("n_shingles") * (32 * (100 - percent) // 100 + 4))).first()[0] or 0
    buckets = max(partitions(docs), size // KEY_BUCKET_BYTES + 1)
    bits = min(MOST_KEY_BITS, max(16, int(size // 8).bit_length()))
    packets = docs.where("doc_id is not null").mapInArrow(lambda it: _packets(it, k, percent, buckets), _PACKET)
    tied = kept(packets.groupBy("bucket").applyInPandas(lambda pdf: _tie(pdf, buckets, bits), _TIED), "tied-keys")
    edges = kept(tied.select("a", "b").mapInArrow(_edges, "a long, b long").distinct(), "shared-keys")
    families = components(edges).select(F.col("node").alias("doc_id"), F.col("component").alias("family"))
    # a document whose copy repeats its id may be in a family without edges of its own
    members = kept(sets.where("doc_id is not null and n_shingles > 0").drop("bits").join(families, "doc_id", "left").withColumn("family", F.coalesce("family", "doc_id")), "members")
    # stored, so that the join below deals both sides anew and Spark can split a large group of copies
    reps = kept(members.groupBy("family", "s1", "s2").agg(F.min("doc_id").alias("rep")), "different-sets")
    wide = reps.groupBy("family").agg(F.count("*").alias("total")).where("total > 1")
    laid = reps.join(wide, "family").select("family", F.col("rep").alias("doc_id"), "total")
    cards = kept(laid.join(sets.where("n_shingles > 0"), "doc_id").select(F.col("doc_id").alias("rep"), "family", "total", F.col("n_shingles").alias("n"), "bits").distinct(), "bitmaps")  # rows that repeat an id may differ in text
    nothing = F.lit(0).cast("long")
    tiles = cards.where(F.col("total") <= tile).select("rep", F.col("rep").alias("comp"), F.lit(-1).cast("long").alias("own"), F.col("family").alias("x"), nothing.alias("y"), nothing.alias("z"), "n", "bits")
    large, known = cards.where(F.col("total") > tile), None
    if not large.isEmpty():
        named = members.join(reps, ["family", "s1", "s2"]).join(large.select("rep"), "rep", "left_semi").select("doc_id", "rep")
        shared = edges.join(named.toDF("a", "x"), "a").join(named.toDF("b", "y"), "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        known = kept(_by_hubs(large, kept(shared, "hubs"), docs, k, percent, tile), "links-with-hubs")
        comps = kept(large.select("rep", "family").distinct().join(components(known).toDF("rep", "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep")), "connected-by-hubs")
        open_ = comps.groupBy("family").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("family")
        apart = kept(comps.join(open_, "family", "left_semi").select("rep", "comp"), "open-families")
        marked = docs.sparkSession.sparkContext.broadcast(_marked(tied, bits))
        rows = docs.where("doc_id is not null").mapInArrow(lambda it: _shared_keys(it, k, percent, marked.value), "doc_id long, keys binary").where(F.length("keys") > 0)
        keys = kept(rows.join(apart, F.col("doc_id") == F.col("rep")).select("keys", "rep", "comp").mapInArrow(_one_a_row, "key long, rep long, comp long").distinct(), "keys-of-families")
        marked.destroy()  # the keys are stored
        tiles = tiles.union(_by_keys(keys, tile).join(large.select("rep", "n", "bits"), "rep").select(tiles.columns))
    met = tiles.repartition("x", "y", "z").sortWithinPartitions("x", "y", "z").mapInArrow(lambda it: _likely(it, percent), _LIKELY)
    met = kept(met.distinct(), "likely-links")
    # texts move again to those that pass only
    arrays = kept(_arrays_of(docs, met, k), "sets-of-likely-links")
    found = met.join(arrays, "rep").groupBy("x", "y").applyInPandas(lambda pdf: _tile(pdf, percent), "a long, b long")
    found = found.union(known) if known is not None else found
    joined = components(found).select(F.col("node").alias("rep"), F.col("component"))
    named = members.select("doc_id", "family", "s1", "s2").join(reps, ["family", "s1", "s2"]).join(joined, "rep", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    return sets.select("doc_id", "n_shingles").join(named, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)
), r AS (
  SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.node
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.root) AS component_id
FROM documents d JOIN r ON r.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n
"""
