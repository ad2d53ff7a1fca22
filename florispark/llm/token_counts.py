"""Token counts: pieces are counted once per distinct pre-token, then summed by document.

1. Each task packs its documents into blocks of a bounded number of bytes: the block's distinct
   pre-tokens, and for each document which of them it has and how often.
2. A shuffle by pre-token brings the blocks' equal pre-tokens together, and a sort side by side;
   each is encoded once, only the number of its pieces is kept, and it goes to all blocks that
   have the pre-token.
3. The numbers are gathered by block (whose size is bounded) and summed over each document's
   frequencies.  No ids are kept or moved.

A pre-token meets a task once per block that has it, so a very common one is no hot key.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, from_planes, planes, text_bytes
from .pretoken import encoder

BLOCK_BYTES = 48 << 20
_BLOCK = "block string, ids array<long>, n_bytes array<long>, bounds binary, pid binary, freq binary, words binary"


def token_counts(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", context: int = 2048, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of docs.

    n_tokens is the length of the library's encoding without added special tokens; special
    strings inside a text count one each, as the library does by default.  Null texts count as
    empty, with 0 tokens.  Repeated rows and null ids are kept, one result row for each row.
    Other columns of docs are ignored; an empty table gives an empty result.
    """
    blocks = cut(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lambda it: _count(it, vocab_path, block_bytes), _BLOCK))
    vocab = blocks.select("block", "words").mapInArrow(_unpack, "block string, pid int, pretoken string")
    pieces = vocab.repartition("pretoken").sortWithinPartitions("pretoken").mapInArrow(lambda it: _pieces(it, vocab_path), "block string, pn long")
    counts = pieces.groupBy("block").agg(F.collect_list("pn").alias("pn"))
    return blocks.drop("words").join(counts, "block", "left").mapInArrow(lambda it: _sum(it, context), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def _count(batches: Iterator[pa.RecordBatch], path: str, block_bytes: int) -> Iterator[pa.RecordBatch]:
    pretokens = encoder(path).pretokens
    pack = zstandard.ZstdCompressor(level=1).compress
    vocab: defaultdict[str, int] = defaultdict()
    vocab.default_factory = vocab.__len__
    ids: list[int | None] = []
    sizes: list[int] = []
    pid: list[np.ndarray] = []
    freq: list[np.ndarray] = []
    held = made = 0

    def block() -> pa.RecordBatch:
        nonlocal made, held
        made += 1
        bounds = np.cumsum([0, *map(len, pid)]).astype("<i8")
        from pyspark import TaskContext

        row = {
            "block": f"{TaskContext.get().partitionId()}-{made}",
            "ids": list(ids),
            "n_bytes": list(sizes),
            "bounds": pack(bounds.tobytes()),
            "pid": pack(planes(np.concatenate([np.zeros(0, "<u4"), *pid]))),
            "freq": pack(planes(np.concatenate([np.zeros(0, "<u4"), *freq]))),
            "words": pack("\n".join(vocab).encode()),
        }
        for x in (vocab, ids, sizes, pid, freq):
            x.clear()
        held = 0
        return pa.RecordBatch.from_pylist([row], schema=pa.schema([("block", pa.string()), ("ids", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())), ("bounds", pa.binary()), ("pid", pa.binary()), ("freq", pa.binary()), ("words", pa.binary())]))

    for batch in batches:
        _, ends = text_bytes(batch.column(1))
        for key, text, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), np.diff(ends).tolist(), strict=True):
            found = Counter(pretokens(text or ""))
            ids.append(key)
            sizes.append(size)
            number = np.fromiter(map(vocab.__getitem__, found), "<u4", len(found))
            order = np.argsort(number)
            pid.append(np.diff(number[order], prepend=np.uint32(0)))  # gaps between sorted numbers
            freq.append(np.fromiter(found.values(), "<u4", len(found))[order])
            held += size
            if held >= block_bytes:
                yield block()
    if ids:
        yield block()


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            # no pre-token holds a line break, as white space is in none
            if not (text := zstandard.decompress(packed).decode()):
                continue
            words = pa.array(text.split("\n"), pa.string())
            for at in range(0, len(words), 50_000):
                part = words.slice(at, 50_000)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(part), pa.string()), pa.array(np.arange(at, at + len(part), dtype=np.int32)), part], names=["block", "pid", "pretoken"])


def _pieces(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Of sorted pre-tokens, the number of pieces, packed with the pre-token's number in its block."""
    enc = encoder(path)
    for batch in batches:
        words = batch.column(2).dictionary_encode()
        n = np.array([len(x) for x in enc.ids(words.dictionary.to_pylist())], dtype=np.int64)[words.indices.to_numpy()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((batch.column(1).to_numpy().astype(np.int64) << 32) + n)], names=["block", "pn"])


def _sum(batches: Iterator[pa.RecordBatch], context: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            bounds = np.frombuffer(zstandard.decompress(row["bounds"]), "<i8")
            gap, freq = (from_planes(zstandard.decompress(row[x])).astype(np.int64) for x in ("pid", "freq"))
            pid = np.cumsum(gap)  # of all documents; each begins anew
            pid -= np.repeat(np.concatenate(([0], pid))[bounds[:-1]], np.diff(bounds))
            pn = np.array(row["pn"] or [], dtype=np.int64)
            n = np.zeros(len(pn), dtype=np.int64)
            n[pn >> 32] = pn & 0xFFFFFFFF
            total = np.concatenate(([0], np.cumsum(n[pid] * freq)))
            tokens = total[bounds[1:]] - total[bounds[:-1]]
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(row["n_bytes"], pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > context)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
