"""Structure keys and figures from line notation.

Texts become arrays of atoms and bonds in Arrow batches; the rest is DataFrame functions.  An atom's
label is refined by its neighbours' labels, as many times as there are atoms.  For the key this is done once for each
atom, marked as the root, in rows of their own; the sorted results are the structure, whatever way it was spelled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florispark.functions import notation
from florispark.session import cut, dealt

MOST_ROWS = 50_000  # of a join's side in one task, each of some hundred bytes
_ATOM = pa.struct([("element", pa.string()), ("hydrogens", pa.int32()), ("charge", pa.int32()), ("isotope", pa.int32()), ("aromatic", pa.bool_()), ("chiral", pa.int32()), ("near", pa.list_(pa.int32()))])
_BOND = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("order", pa.int32()), ("aromatic", pa.bool_()), ("ring", pa.bool_())])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [notation.parse(x.as_py()) or (None, None) for x in batch.column(0)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in rows], pa.list_(_ATOM)), pa.array([b for _, b in rows], pa.list_(_BOND))], names=["notation", "atoms", "bonds"])


def parsed(notations: DataFrame, column: str) -> DataFrame:
    """(notation, atoms, bonds) of each distinct text; both are null where it can't be read."""
    return notations.select(F.col(column).cast("string").alias("notation")).where("notation is not null").distinct().mapInArrow(_parsed, f"notation string, {notation.SCHEMA}")


def refined(labels: Column) -> Column:
    """Labels, each hashed with the sorted labels of its neighbours, once for each atom; needs the column atoms."""
    near = lambda a: F.filter(a["near"], lambda x: x >= 0)
    once = lambda held: F.transform("atoms", lambda a, i: F.xxhash64(F.get(held, i), F.array_sort(F.transform(near(a), lambda x: F.get(held, x)))))
    return F.aggregate(F.sequence(F.lit(1), F.size("atoms")), labels, lambda held, _: once(held))


def handedness() -> Column:
    """Of each atom: 0, or 1 or 2 for the sense of its neighbours in order of their labels, if these differ; needs atoms and labels."""
    of = lambda x: F.when(x >= 0, F.get("labels", x)).otherwise(F.lit(0).cast("long"))
    crossed = lambda n: F.aggregate(F.transform(n, lambda x, i: F.size(F.filter(n, lambda y, j: (j > i) & (y < x)))), F.lit(0), lambda s, x: s + x)

    def sense(a: Column) -> Column:
        n = F.transform(a["near"], of)
        return F.when((a["chiral"] == 0) | (F.size(F.array_distinct(n)) < F.size(n)) | (F.size(n) != 4), 0).otherwise((a["chiral"] + crossed(n)) % 2 + 1)

    return F.transform("atoms", sense)


def structure_keys(notations: DataFrame, column: str) -> DataFrame:
    """(notation, full_key, connectivity_key) of each distinct text that can be read.

    connectivity_key tells structures apart by elements, bonds between them (of any order) and hydrogens at each atom, so
    that aromatic and alternating spellings are one; full_key by charges, isotopes and handedness of
    centres with four different neighbours as well.  Keys are 256-bit hashes of 64-bit labels.  Double bonds'
    directions and moving hydrogens aren't seen.
    """
    held = cut(parsed(notations, column).where("atoms is not null"))
    plain = F.transform("atoms", lambda a: F.xxhash64(a["element"], a["hydrogens"]))
    exact = F.transform("atoms", lambda a: F.xxhash64(a["element"], a["hydrogens"], a["charge"], a["isotope"]))
    handed = F.transform("exact", lambda x, i: F.xxhash64(x, F.get("sense", i)))
    told = held.withColumn("plain", plain).withColumn("exact", exact).withColumn("labels", refined(F.col("exact"))).withColumn("sense", handedness()).withColumn("full", handed)
    kinds = F.array(*(F.struct(F.lit(n).alias("kind"), F.col(n).alias("labels")) for n in ("full", "plain")))
    rows = told.select("notation", "atoms", F.explode(kinds).alias("k")).select("notation", "atoms", "k.kind", "k.labels").withColumn("root", F.explode(F.sequence(F.lit(0), F.size("atoms") - 1)))
    marked = F.transform("labels", lambda x, i: F.xxhash64(x, i == F.col("root")))
    # the bonds of the end result are in the labels; a hash of each root's is enough
    seen = rows.select("notation", "kind", F.xxhash64(F.array_sort(refined(marked))).alias("seen"))
    keys = seen.groupBy("notation", "kind").agg(F.sha2(F.to_json(F.sort_array(F.collect_list("seen"))), 256).alias("key"))
    return keys.groupBy("notation").agg(*(F.max(F.when(F.col("kind") == k, F.col("key"))).alias(n) for k, n in (("full", "full_key"), ("plain", "connectivity_key"))))


def structure_figures(notations: DataFrame, column: str) -> DataFrame:
    """(notation, formula, heavy, rings, donors, acceptors, rotatable, fsp3) of each distinct text; null figures where it can't be read.

    formula: carbon, hydrogen, then others by name, net charge last.  rings: bonds less atoms and
    plus parts.  donors: N and O that have hydrogen; acceptors: all N and O.  rotatable: single bonds outside
    rings between atoms that each have another neighbour.  fsp3: share of carbons with single bonds only.
    """
    df, c = parsed(notations, column), F.col
    heavy = F.filter("atoms", lambda a: a["element"] != "H")
    total = lambda arr, f: F.aggregate(arr, F.lit(0), lambda s, x: s + f(x))
    hydrogens = total("atoms", lambda a: a["hydrogens"]) + F.size("atoms") - F.size(heavy)
    names = F.array_sort(F.array_distinct(F.transform(heavy, lambda a: a["element"])))
    number = lambda n: F.when(n > 1, n.cast("string")).otherwise("")
    count = lambda e: F.size(F.filter("atoms", lambda a: a["element"] == e))
    carbon = count(F.lit("C"))
    h = F.when(hydrogens > 0, F.concat(F.lit("H"), number(hydrogens))).otherwise("")
    others = F.array_join(F.transform(F.filter(names, lambda e: e != "C"), lambda e: F.concat(e, number(count(e)))), "")
    net = total("atoms", lambda a: a["charge"])
    charge = F.when(net > 0, F.concat(F.lit("+"), number(net))).when(net < 0, F.concat(F.lit("-"), number(-net))).otherwise("")
    formula = F.concat(F.when(carbon > 0, F.concat(F.lit("C"), number(carbon))).otherwise(""), h, others, charge)
    # parts: every atom takes the least number that its neighbours have, until none can change
    least = lambda held: F.transform("atoms", lambda a, i: F.array_min(F.concat(F.array(F.get(held, i)), F.transform(F.filter(a["near"], lambda x: x >= 0), lambda x: F.get(held, x)))))
    own = F.when(F.size("atoms") > 0, F.sequence(F.lit(0), F.size("atoms") - 1))
    parts = F.size(F.array_distinct(F.aggregate(F.sequence(F.lit(1), F.size("atoms")), own, lambda held, _: least(held))))
    polar = lambda a: a["element"].isin("N", "O")
    degree = lambda i: F.size(F.filter(F.get("atoms", i)["near"], lambda x: x >= 0))
    turning = F.filter("bonds", lambda b: (b["order"] == 1) & ~b["aromatic"] & ~b["ring"] & (degree(b["a"]) > 1) & (degree(b["b"]) > 1))
    flat = F.array_distinct(F.flatten(F.transform(F.filter("bonds", lambda b: (b["order"] > 1) | b["aromatic"]), lambda b: F.array(b["a"], b["b"]))))
    sp3 = F.size(F.filter(F.transform("atoms", lambda a, i: (a["element"] == "C") & ~F.array_contains(flat, i)), lambda x: x))
    known = c("atoms").isNotNull()
    figures = {"formula": formula, "heavy": F.size(heavy), "rings": F.size("bonds") - F.size("atoms") + parts, "donors": F.size(F.filter("atoms", lambda a: polar(a) & (a["hydrogens"] > 0))), "acceptors": F.size(F.filter("atoms", polar)), "rotatable": F.size(turning), "fsp3": F.when(carbon > 0, sp3 / carbon).otherwise(0.0)}
    return df.select("notation", *(F.when(known, f).alias(n) for n, f in figures.items()))


def verified(expected: DataFrame, candidates: DataFrame, key: str, order: str, column: str) -> DataFrame:
    """(key, notation, via) for each of expected's (key, full_key, connectivity_key): the first candidate with its full key, else the first
    with its connectivity, else null: via is 'full', 'planar', 'mismatch' or, without candidates that can be read, 'none'."""
    rows = candidates.count()
    c = candidates.select(key, order, F.col(column).alias("notation")).join(structure_keys(candidates, column).toDF("notation", "_f", "_c"), "notation")
    # rows are wide with keys that pack to next to nothing: dealt by their number, and neither side is sent whole
    j = dealt(expected, rows, key, most=MOST_ROWS).join(dealt(c, rows, key, most=MOST_ROWS).hint("merge"), key, "left")
    via = F.when(F.col("_f") == F.col("full_key"), 0).when(F.col("_c") == F.col("connectivity_key"), 1).when(F.col("_f").isNotNull(), 2).otherwise(3)
    best = j.groupBy(key).agg(F.min(F.struct(via.alias("via"), F.col(order).alias("order"), "notation")).alias("m"))
    names = F.array(*(F.lit(x) for x in ("full", "planar", "mismatch", "none")))
    return best.select(key, F.when(F.col("m.via") < 2, F.col("m.notation")).alias("notation"), F.get(names, F.col("m.via")).alias("via"))
