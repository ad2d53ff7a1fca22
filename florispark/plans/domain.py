"""The domain's tables as views of the relational test tables, for Spark and, as CTEs, for the oracle.

ingredient: part; extract: its plant-derived rows; edge: supplier (species) has part (compound), with
orders as references and returned ones as validated.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florispark.session import dealt
from florispark.sources.readers import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
# fixed values: restriction annexes by p_size
ROMAN = ("II", "III", "IV", "V", "VI", "VII")

CTE = {
    "ing": """SELECT CAST(p_partkey AS BIGINT) AS ref_no, p_name AS name, p_brand AS family, p_type AS ord, CAST(p_size AS BIGINT) AS size, p_retailprice AS price,
 string_split(p_name, ' ') AS functions, p_size <= 25 AS is_bio,
 CASE WHEN p_size % 7 = 0 THEN (['II','III','IV','V','VI','VII'])[p_size % 6 + 1] || '/' || p_size END AS restriction FROM part""",
    "edge": """SELECT CAST(l_suppkey AS BIGINT) AS species, CAST(l_partkey AS BIGINT) AS compound, count(DISTINCT l_orderkey) AS n_refs, bool_or(l_returnflag = 'R') AS validated
 FROM lineitem GROUP BY 1, 2""",
    "species": "SELECT CAST(s_suppkey AS BIGINT) AS species, n_name AS family, r_name AS kingdom FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
}


def ingredient(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    annex = F.get(F.array(*map(F.lit, ROMAN)), F.col("p_size") % 6)
    return p.select(
        F.col("p_partkey").cast("long").alias("ref_no"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("family"),
        F.col("p_type").alias("ord"),
        F.col("p_size").cast("long").alias("size"),
        F.col("p_retailprice").alias("price"),
        F.split("p_name", " ").alias("functions"),
        (F.col("p_size") <= 25).alias("is_bio"),
        F.when(F.col("p_size") % 7 == 0, F.concat_ws("/", annex, F.col("p_size").cast("string"))).alias("restriction"),
    )


def edges(spark: SparkSession, sf: str, *by: str) -> DataFrame:
    """The edges, dealt by some columns for what comes next."""
    li = table(spark, sf, "lineitem")
    rows = li.count()
    li = li.select(F.col("l_suppkey").cast("long").alias("species"), F.col("l_partkey").cast("long").alias("compound"), "l_orderkey", "l_returnflag")
    e = dealt(li, rows, "species", "compound").groupBy("species", "compound").agg(F.countDistinct("l_orderkey").alias("n_refs"), F.bool_or(F.col("l_returnflag") == "R").alias("validated"))
    return dealt(e, rows, *by) if by else e


def edges_dealt(by: tuple[str, ...], spark: SparkSession, sf: str) -> DataFrame:
    return edges(spark, sf, *by)


def placed_edges(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """Edges with the families of their species, dealt by species, and a bound on their number."""
    return edges(spark, sf, "species").join(species(spark, sf).hint("merge"), "species"), table(spark, sf, "lineitem").count()


def species(spark: SparkSession, sf: str) -> DataFrame:
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(F.col("s_suppkey").cast("long").alias("species"), F.col("n_name").alias("family"), F.col("r_name").alias("kingdom"))


def used_by(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (category, family, species): functions of the ingredients that a species supplies."""
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("long").alias("species"), F.col("l_partkey").cast("long").alias("ref_no"))
    rows = li.count()
    e = dealt(dealt(li, rows, "species", "ref_no").distinct(), rows, "ref_no")
    i = ingredient(spark, sf).select("ref_no", F.explode("functions").alias("category"))
    # a species' kingdom and family follow once its categories are told apart
    pairs = dealt(e.join(i.hint("merge"), "ref_no").select("category", "species"), rows, "species").distinct()
    return pairs.join(species(spark, sf).distinct(), "species").select("category", "family", "kingdom", "species")


CTE["used"] = """SELECT DISTINCT category, s.family, s.kingdom, s.species FROM (SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS species, CAST(l_partkey AS BIGINT) AS ref_no FROM lineitem) e
 JOIN (SELECT ref_no, unnest(functions) AS category FROM ing) i USING (ref_no) JOIN species s USING (species)"""


def query(name: str, oracle: str | None = None, recursive: bool = False) -> Callable[[Query], Query]:
    """Registers a query, and its oracle with the CTEs that it names in front."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            need: list[str] = []
            for t in ("ing", "edge", "species", "used"):
                if f" {t} " in f" {oracle} ".replace("\n", " ").replace(")", " ").replace(",", " "):
                    need.append(t)
            if "used" in need:
                need = ["ing", *[x for x in need if x not in ("ing", "species", "used")], "species", "used"]
            head = ", ".join(f"{t} AS ({CTE[t]})" for t in need)
            body = oracle.strip()
            if body.startswith("WITH "):
                body = f"WITH {'RECURSIVE ' if recursive else ''}{head + ', ' if head else ''}{body[5:]}"
            elif head:
                body = f"WITH {head} {body}"
            ORACLES[name] = body
        return f

    return add


def same(name: str, sql: str, edges_by: tuple[str, ...] = ()) -> None:
    """A query whose text both engines read; Spark gets the tables that it names as frames, edges dealt by some columns."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        make = {"ing": ingredient, "edge": partial(edges_dealt, edges_by), "species": species, "used": used_by}
        text, frames = sql, {}
        for t in (*make, "part", "supplier", "nation", "region", "customer", "orders", "lineitem", "events", "documents", "labels", "conversations", "pages"):
            for before in ("FROM ", "JOIN "):
                if f"{before}{t}\n" in text or f"{before}{t} " in text or f"{before}{t})" in text or text.endswith(f"{before}{t}"):
                    frames[t] = make[t](spark, sf) if t in make else table(spark, sf, t)
                    for after in ("\n", " ", ")"):
                        text = text.replace(f"{before}{t}{after}", f"{before}{{{t}}}{after}")
                    if text.endswith(f"{before}{t}"):
                        text = text.removesuffix(t) + f"{{{t}}}"
        return spark.sql(text, **frames)

    query(name, sql)(run)
