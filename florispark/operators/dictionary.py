"""Dictionary matching: all entries of a vocabulary in one pass over the texts, by an Aho-Corasick automaton.

The automaton is built once from the vocabulary, whose size is checked, and sent to the tasks; a vocabulary
beyond the bound is dealt into several, each of which gets a pass.  Texts go through it in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BYTES = 32 << 20
TEXT_BYTES = 256 << 10
_MATCH = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("entry", pa.string()), ("kind", pa.string()), ("value", pa.string())]))
MATCHES = "array<struct<start:int,end:int,entry:string,kind:string,value:string>>"


def automaton(entries: list[tuple[str, str, str, bool]]):
    """Of (entry, kind, value, whole): whether the entry has to end where a word does."""
    import ahocorasick

    a = ahocorasick.Automaton()
    held: dict[str, list] = {}
    for entry, kind, value, whole in entries:
        held.setdefault(entry, []).append((entry, kind, value, whole))
    for entry, all_ in held.items():
        a.add_word(entry, sorted(all_, key=str))
    if held:
        a.make_automaton()
    return a


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def found(a, text: str, longest: bool) -> list[dict]:
    """Matches that begin, and for whole entries end, at a word's bounds, in order; longest: none within or across another, the first and then the longest stay."""
    out = []
    if len(a):
        for last, entries in a.iter(text):
            for entry, kind, value, whole in entries:
                start, end = last + 1 - len(entry), last + 1
                if start and _word(text[start - 1]) and _word(text[start]):
                    continue
                if whole and end < len(text) and _word(text[end]) and _word(text[end - 1]):
                    continue
                out.append((start, -end, entry, kind, value))
    out.sort(key=lambda m: (m[0], m[1], m[3], m[4] or ""))
    kept, at = [], 0
    for start, end, entry, kind, value in out:
        same = bool(kept) and (kept[-1]["start"], kept[-1]["end"]) == (start, -end)
        if not longest or start >= at or same:
            kept.append({"start": start, "end": -end, "entry": entry, "kind": kind, "value": value})
            at = max(at, -end)
    return kept


def matches(texts: DataFrame, text: str, vocabulary: DataFrame, name: str = "matches", longest: bool = True, upper: bool = False, most_bytes: int = MOST_BYTES) -> DataFrame:
    """texts with a column of the entries that are found in `text`, with places in it.

    vocabulary has entry, kind, value and whole.  Null texts have none; null and empty entries are left out;
    an entry may have several kinds and values.  upper: texts and entries are compared in upper case, places are those of the upper-case text.
    With longest, entries of several passes compete as those of one do.
    """
    v = vocabulary.select(F.upper("entry").alias("entry") if upper else F.col("entry"), "kind", "value", "whole").where("entry <> ''").distinct()
    size = v.agg(F.coalesce(F.sum(F.octet_length("entry") + 64), F.lit(0))).first()[0]
    parts = size // most_bytes + 1
    out = texts
    for i in range(parts):
        share = v if parts == 1 else v.where(F.pmod(F.xxhash64("entry"), F.lit(parts)) == i)
        entries = [tuple(r) for r in share.collect()]  # most_bytes at most, as it was summed above
        out = _pass(out, text, entries, f"{name}_{i}", longest and parts == 1, upper)
    if parts > 1:
        every = F.array_sort(F.concat(*(f"{name}_{i}" for i in range(parts))))
        out = out.withColumn(name, _without_overlap(every) if longest else every).drop(*(f"{name}_{i}" for i in range(parts)))
    return out.withColumnRenamed(f"{name}_0", name)


def _without_overlap(m):
    """The first and then the longest of matches in order; those of one place stay together."""
    ranked = F.array_sort(F.transform(m, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind"), x["value"].alias("value"), x["entry"].alias("entry"))))
    none = F.array().cast("array<struct<start:int,back:int,kind:string,value:string,entry:string>>")
    last = lambda held: F.try_element_at(held, F.lit(-1))
    free = lambda held, x: (F.size(held) == 0) | (x["start"] >= -last(held)["back"]) | ((x["start"] == last(held)["start"]) & (x["back"] == last(held)["back"]))
    kept = F.aggregate(ranked, none, lambda held, x: F.when(free(held, x), F.concat(held, F.array(x))).otherwise(held))
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), (-x["back"]).alias("end"), x["entry"].alias("entry"), x["kind"].alias("kind"), x["value"].alias("value")))


def _pass(texts: DataFrame, text: str, entries: list, name: str, longest: bool, upper: bool) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(entries)
    schema = texts.select("*", F.lit(None).cast(MATCHES).alias(name)).schema
    at = texts.columns.index(text)
    return texts.mapInArrow(lambda it: _matched(it, at, sent.value, longest, upper, name), schema)


def _pieces(batch: pa.RecordBatch, at: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, few at a time: their texts have most_bytes at most, or there is one row."""
    ends, first = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(at)), 0).cast(pa.int64())).to_numpy(), 0
    while first < len(ends):
        end = max(first + 1, int(ends.searchsorted((ends[first - 1] if first else 0) + most_bytes, "right")))
        yield batch.slice(first, end - first)
        first = end


def _matched(batches: Iterator[pa.RecordBatch], at: int, entries: list, longest: bool, upper: bool, name: str) -> Iterator[pa.RecordBatch]:
    """Batches with a column of matches; those of TEXT_BYTES of texts are held as Python's objects at a time."""
    a = automaton(entries)
    for batch in batches:
        for part in _pieces(batch, at, TEXT_BYTES):
            rows = [found(a, x.as_py().upper() if upper else x.as_py(), longest) if x.is_valid else [] for x in part.column(at)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, _MATCH)], names=[*part.schema.names, name])
