"""Structures: keys, figures and verification over line notations that are put together from ingredients, each spelled in several ways."""

from __future__ import annotations

from pyspark.sql import functions as F

from florispark.operators import structure as S
from florispark.session import cut

from .domain import ingredient, query

# an amino acid with a side chain of a + 1 carbons that ends in a ring (b = 0), a hydroxyl group (b = 1) or nothing; s is its hand
PARAMS = "p AS (SELECT ref_no, size % 5 AS a, size % 3 AS b, ref_no % 2 AS s, size % 10 <> 9 AS whole FROM ing )"


def _spelled(spark, sf):
    i = ingredient(spark, sf)
    a, b, s = F.col("size") % 5, F.col("size") % 3, F.col("ref_no") % 2
    chain = F.repeat(F.lit("C"), (a + 1).cast("int"))
    end = lambda ring: F.when(b == 0, ring).when(b == 1, "O").otherwise("")
    mark = lambda hand: F.when(hand == 0, "@@").otherwise("@")
    forth = lambda hand: F.concat(F.lit("N[C"), mark(hand), F.lit("H]("), chain, end("c1ccccc1"), F.lit(")C(=O)O"))
    back = F.concat(F.lit("OC(=O)[C"), mark(s), F.lit("H](N)"), chain, end("C2=CC=CC=C2"))
    whole = F.col("size") % 10 != 9
    return i.select("ref_no", F.when(whole, forth(s)).otherwise(F.concat(F.lit("C1"), chain)).alias("one"), back.alias("two"), forth(1 - s).alias("mirror"))


@query(
    "graph_structure_keys",
    f"""WITH {PARAMS}, c AS (SELECT *, a + 3 + CASE b WHEN 0 THEN 6 ELSE 0 END AS nc, 4 + 2 * (a + 1) + CASE b WHEN 0 THEN 5 ELSE 1 END AS nh, 2 + (b = 1)::INT AS no FROM p)
SELECT ref_no, CASE WHEN whole THEN 'C' || nc || 'H' || nh || 'NO' || no END AS formula, CASE WHEN whole THEN nc + 1 + no END AS heavy, CASE WHEN whole THEN (b = 0)::INT END AS rings,
 CASE WHEN whole THEN 2 + (b = 1)::INT END AS donors, CASE WHEN whole THEN 1 + no END AS acceptors, CASE WHEN whole THEN 2 + a + (b = 0)::INT - (b = 2)::INT END AS rotatable,
 CASE WHEN whole THEN (a + 2) / CAST(nc AS DOUBLE) END AS fsp3, CASE WHEN whole THEN true END AS respelled_full, CASE WHEN whole THEN false END AS mirrored_full, CASE WHEN whole THEN true END AS mirrored_connectivity,
 CASE WHEN whole THEN count(*) OVER (PARTITION BY whole, a, b, s) END AS n_full, CASE WHEN whole THEN count(*) OVER (PARTITION BY whole, a, b) END AS n_connectivity FROM c""",
)
def structure_keys(spark, sf):
    """Two spellings of a structure have one key, its mirror image another but the same connectivity; figures by the notation; what can't be read is null."""
    rows = _spelled(spark, sf)
    spellings = rows.select(F.explode(F.array("one", "two", "mirror")).alias("x")).distinct()
    keys, figures = cut(S.structure_keys(spellings, "x")), S.structure_figures(rows, "one").withColumnRenamed("notation", "one")
    for c in ("one", "two", "mirror"):
        rows = rows.join(keys.toDF(c, f"{c}_full", f"{c}_connectivity"), c, "left")
    held = rows.join(figures, "one", "left")
    same = lambda a, b: F.col(a) == F.col(b)
    for kind in ("full", "connectivity"):
        held = held.join(held.where(f"one_{kind} is not null").groupBy(f"one_{kind}").agg(F.count("*").alias(f"n_{kind}")), f"one_{kind}", "left")
    return held.select("ref_no", "formula", "heavy", "rings", "donors", "acceptors", "rotatable", "fsp3", same("one_full", "two_full").alias("respelled_full"), same("one_full", "mirror_full").alias("mirrored_full"), same("one_connectivity", "mirror_connectivity").alias("mirrored_connectivity"), "n_full", "n_connectivity")


@query(
    "rec_structure_verified",
    f"""WITH {PARAMS} SELECT ref_no, CASE WHEN ref_no % 7 = 0 THEN 'none' WHEN ref_no % 3 = 0 THEN 'full' WHEN ref_no % 3 = 1 THEN 'planar' ELSE 'mismatch' END AS via,
 CASE WHEN ref_no % 7 = 0 OR ref_no % 3 = 2 THEN NULL WHEN ref_no % 3 = 0 THEN 'OC(=O)[C' || CASE s WHEN 0 THEN '@@' ELSE '@' END || 'H](N)' || repeat('C', a + 1) || (['C2=CC=CC=C2', 'O', ''])[b + 1]
  ELSE 'N[C' || CASE s WHEN 1 THEN '@@' ELSE '@' END || 'H](' || repeat('C', a + 1) || (['c1ccccc1', 'O', ''])[b + 1] || ')C(=O)O' END AS notation FROM p WHERE whole""",
)
def verified(spark, sf):
    """A recomputed key against the one on file: the first candidate with the same key, else the first with its connectivity."""
    rows = _spelled(spark, sf)
    expected = rows.join(S.structure_keys(rows, "one").withColumnRenamed("notation", "one"), "one").select("ref_no", "full_key", "connectivity_key")
    n = F.col("ref_no")
    candidates = F.when(n % 7 == 0, F.array(F.lit("C("))).when(n % 3 == 0, F.array("mirror", "two")).when(n % 3 == 1, F.array("mirror")).otherwise(F.array(F.lit("CCO")))
    return S.verified(expected, rows.select("ref_no", F.posexplode(candidates).alias("n", "x")), "ref_no", "n", "x")


@query("rpt_structures_read", "SELECT size % 10 <> 9 AS readable, count(*) AS n FROM ing GROUP BY 1")
def read(spark, sf):
    rows = _spelled(spark, sf)
    return rows.join(S.parsed(rows, "one").withColumnRenamed("notation", "one"), "one").groupBy(F.col("atoms").isNotNull().alias("readable")).agg(F.count("*").alias("n"))
