"""Join, window and set queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from florispark.functions.text import first_words, norm_name
from florispark.operators import relational as R
from florispark.operators.cleaning import aliases
from florispark.sources.readers import table

from .domain import edges, ingredient, query, same, species, used_by

same("join_inner_using", "SELECT i.family, count(*) AS n FROM ing i JOIN edge e ON e.compound = i.ref_no GROUP BY i.family")
same("join_left_fanout", "SELECT s.species, count(e.compound) AS n, max(e.n_refs) AS most FROM species s LEFT JOIN edge e ON e.species = s.species GROUP BY s.species")
same("join_left_extra_on", "SELECT i.ref_no, i.name, e.species FROM ing i LEFT JOIN edge e ON e.compound = i.ref_no AND e.n_refs >= 2 AND e.species = 3")
same("join_multi_key", "SELECT l.l_partkey AS part, l.l_suppkey AS supplier, count(*) AS n FROM lineitem l JOIN edge e ON e.compound = l.l_partkey AND e.species = l.l_suppkey WHERE e.n_refs >= 2 GROUP BY l.l_partkey, l.l_suppkey")
same("join_anti_leftnull", "SELECT i.ref_no, i.name FROM ing i LEFT JOIN (SELECT DISTINCT compound FROM edge WHERE n_refs >= 2) b ON b.compound = i.ref_no WHERE b.compound IS NULL")
same("join_semi_exists", "SELECT s.species, s.family FROM species s WHERE EXISTS (SELECT 1 FROM edge e WHERE e.species = s.species AND e.n_refs >= 2)")
same("join_case_in_subquery", "SELECT family, count(DISTINCT CASE WHEN ref_no IN (SELECT compound FROM edge WHERE n_refs >= 2) THEN ref_no END) AS well_known, count(DISTINCT ref_no) AS n FROM ing GROUP BY family")


@query("join_anti_notin", "SELECT ref_no, name FROM ing WHERE ref_no NOT IN (SELECT compound FROM edge WHERE n_refs >= 2)")
def anti_notin(spark, sf):
    return R.not_in(ingredient(spark, sf), edges(spark, sf).where("n_refs >= 2"), "ref_no", "compound").select("ref_no", "name")


@query("join_left_unnest", "SELECT ref_no, fn FROM (SELECT ref_no, CASE WHEN is_bio THEN functions END AS f FROM ing ) t LEFT JOIN LATERAL (SELECT unnest(f) AS fn) u ON true")
def left_unnest(spark, sf):
    return ingredient(spark, sf).select("ref_no", F.explode_outer(F.when(F.col("is_bio"), F.col("functions"))).alias("fn"))


@query("join_double_lateral", "SELECT fn, word, count(*) AS n FROM (SELECT ref_no, fn, unnest(string_split(ord || ' ' || family, ' ')) AS word FROM (SELECT ref_no, ord, family, unnest(functions) AS fn FROM ing )) GROUP BY fn, word")
def double_lateral(spark, sf):
    f = ingredient(spark, sf).select("ord", "family", F.explode("functions").alias("fn"))
    return f.select("fn", F.explode(F.split(F.concat_ws(" ", "ord", "family"), " ")).alias("word")).groupBy("fn", "word").agg(F.count("*").alias("n"))


@query("join_tie_max", "WITH g AS (SELECT family, ord, count(*) AS n FROM ing GROUP BY family, ord) SELECT family, ord, n FROM g WHERE n = (SELECT max(n) FROM g h WHERE h.family = g.family)")
def tie_max(spark, sf):
    return R.max_rows(ingredient(spark, sf).groupBy("family", "ord").agg(F.count("*").alias("n")), ["family"], "n").select("family", "ord", "n")


@query(
    "join_ranked_union",
    """WITH r AS (SELECT 0 AS rank, s.species, l.l_partkey AS compound, l.l_orderkey AS doi, l.l_returnflag = 'R' AS v FROM lineitem l JOIN species s ON s.species = l.l_suppkey WHERE l.l_linenumber <= 3
 UNION ALL SELECT 1, s.species, l.l_partkey, l.l_orderkey, l.l_returnflag = 'R' FROM lineitem l JOIN species s ON s.species + 1 = l.l_suppkey WHERE l.l_linenumber >= 3
 UNION ALL SELECT 2, s.species, l.l_partkey, l.l_orderkey, l.l_returnflag = 'R' FROM lineitem l JOIN species s ON s.species + 2 = l.l_suppkey)
SELECT species, compound, count(DISTINCT doi) AS n_references, bool_or(v) AS validated, (['name', 'synonym', 'infraspecific'])[min(rank) + 1] AS via FROM r GROUP BY species, compound""",
)
def ranked_union(spark, sf):
    """Evidence credited over three paths of names, the best one named."""
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("long").alias("k"), F.col("l_partkey").alias("compound"), F.col("l_orderkey").alias("doi"), (F.col("l_returnflag") == "R").alias("v"), "l_linenumber")
    s = species(spark, sf).select("species")
    path = lambda d, shift: d.join(s.withColumn("k", F.col("species") + shift), "k").drop("k", "l_linenumber")
    return R.ranked_union([("name", path(li.where("l_linenumber <= 3"), 0)), ("synonym", path(li.where("l_linenumber >= 3"), 1)), ("infraspecific", path(li, 2))], ["species", "compound"], "doi", "v")


@query("join_normalised_name", "SELECT a.c_custkey AS a, b.s_suppkey AS b FROM customer a JOIN supplier b ON lower(replace(a.c_name, 'Customer', 'org')) = lower(replace(b.s_name, 'Supplier', 'ORG'))")
def normalised_name(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("a"), norm_name(F.replace("c_name", F.lit("Customer"), F.lit(" org"))).alias("k"))
    b = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("b"), norm_name(F.replace("s_name", F.lit("Supplier"), F.lit("ORG"))).alias("k"))
    return a.join(b, "k").select("a", "b")


@query("join_prefix_two_words", "WITH o AS (SELECT ref_no, name || ' var' || (ref_no % 3) AS org FROM ing ) SELECT DISTINCT i.name AS alias, o.org FROM o JOIN ing i ON split_part(o.org, ' ', 1) || ' ' || split_part(o.org, ' ', 2) = i.name")
def prefix_two(spark, sf):
    ing = ingredient(spark, sf)
    o = ing.select(F.concat("name", F.lit(" var"), (F.col("ref_no") % 3).cast("string")).alias("org"))
    return o.join(ing.select(F.col("name").alias("alias")).distinct(), first_words(F.col("org"), 2) == F.col("alias")).select("alias", "org").distinct()


@query("join_prefix_exists", "WITH a AS (SELECT DISTINCT split_part(name, ' ', 1) AS w FROM ing ), b AS (SELECT DISTINCT name FROM ing WHERE is_bio) SELECT w FROM a WHERE EXISTS (SELECT 1 FROM b WHERE b.name LIKE a.w || ' %')")
def prefix_exists(spark, sf):
    ing = ingredient(spark, sf)
    a = ing.select(F.split_part("name", F.lit(" "), F.lit(1)).alias("w")).distinct()
    return R.prefix_exists(a, ing.where("is_bio"), "w", "name").select("w")


@query("join_genus_bridge", "WITH u AS (SELECT DISTINCT family, ord FROM ing WHERE is_bio), k AS (SELECT DISTINCT ord, name FROM ing WHERE NOT is_bio AND name NOT IN (SELECT name FROM ing WHERE is_bio AND length(name) % 2 = 0)) SELECT family, count(DISTINCT name) AS n FROM k JOIN u USING (ord) GROUP BY family")
def genus_bridge(spark, sf):
    ing = ingredient(spark, sf)
    u = ing.where("is_bio").select("family", "ord").distinct()
    k = ing.where("not is_bio").join(ing.where("is_bio and length(name) % 2 = 0").select("name").distinct(), "name", "left_anti").select("ord", "name").distinct()
    return k.join(u, "ord").groupBy("family").agg(F.countDistinct("name").alias("n"))


ALIASES = """WITH n AS (SELECT DISTINCT name AS species FROM ing WHERE is_bio),
 s AS (SELECT DISTINCT name AS species, family || ' ' || (ref_no % 4000) AS alias, CASE WHEN ref_no % 3 = 0 THEN 'EXACT' ELSE 'FUZZY' END AS match_type, 'SYNONYM' AS status, ref_no % 5 AS accepted_key, size % 5 AS own_key FROM ing WHERE is_bio),
 v AS (SELECT DISTINCT species, alias FROM s WHERE match_type = 'EXACT' AND status = 'SYNONYM' AND accepted_key = own_key AND alias LIKE '% %' AND alias NOT IN (SELECT species FROM n))"""


@query("alias_build", ALIASES + " SELECT species, species AS alias, 'name' AS via FROM n UNION ALL SELECT species, alias, 'synonym' FROM v WHERE alias IN (SELECT alias FROM v GROUP BY alias HAVING count(*) = 1)")
def alias_build(spark, sf):
    ing = ingredient(spark, sf).where("is_bio")
    syn = ing.select(F.col("name").alias("species"), F.concat("family", F.lit(" "), (F.col("ref_no") % 4000).cast("string")).alias("alias"), F.when(F.col("ref_no") % 3 == 0, "EXACT").otherwise("FUZZY").alias("match_type"), F.lit("SYNONYM").alias("status"), (F.col("ref_no") % 5).alias("accepted_key"), (F.col("size") % 5).alias("own_key"))
    return aliases(ing.select(F.col("name").alias("species")).distinct(), syn)


@query("win_first_per_key", "SELECT l_partkey AS part, l_orderkey AS ord, l_linenumber AS line FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) = 1")
def first_per_key(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_orderkey").alias("ord"), F.col("l_linenumber").alias("line"))
    return li.groupBy("part").agg(F.min(F.struct("ord", "line")).alias("m")).select("part", "m.*")


@query("win_seq_in_group", "SELECT o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS entry_seq FROM orders")
def seq(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).cast("long").alias("entry_seq"))


@query("win_topk", "SELECT category, family, n FROM (SELECT category, family, count(DISTINCT species) AS n FROM used GROUP BY category, family) QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, family) <= 3")
def topk(spark, sf):
    g = used_by(spark, sf).groupBy("category", "family").agg(F.countDistinct("species").alias("n"))
    return R.top_per_group(g, ["category"], [F.desc("n"), F.asc("family")], 3).select("category", "family", "n")


@query("win_dense_index", "SELECT fn, n, row_number() OVER (ORDER BY n DESC, fn) - 1 AS index FROM (SELECT fn, count(*) AS n FROM (SELECT unnest(functions) AS fn FROM ing ) GROUP BY fn)")
def dense(spark, sf):
    return R.dense_index(ingredient(spark, sf).select(F.explode("functions").alias("fn")), "fn").withColumn("index", F.col("index").cast("long"))


@query(
    "set_snapshot_diff",
    """WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS n FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), w AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN 'NEW' ELSE lower(o_orderpriority) END AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
 s AS (SELECT min(k) AS lo, max(k) AS hi FROM o)
SELECT count(*) FILTER (o.k IS NOT NULL AND w.k IS NOT NULL) AS in_both, count(*) FILTER (w.k IS NULL) AS only_old, count(*) FILTER (o.k IS NULL) AS only_new, count(*) FILTER (o.k IS NULL AND w.k BETWEEN (SELECT lo FROM s) AND (SELECT hi FROM s)) AS new_in_old_range,
 count(*) FILTER (lower(o.n) <> lower(w.n)) AS renamed FROM o FULL JOIN w ON o.k = w.k""",
)
def snapshots(spark, sf):
    o = table(spark, sf, "orders")
    old = o.where("o_orderdate < timestamp '1999-01-01'").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("n"))
    new = o.where("o_orderdate >= timestamp '1997-01-01'").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 9 == 0, "NEW").otherwise(F.lower("o_orderpriority")).alias("n"))
    return R.snapshot_diff(old, new, "k", "n")


@query(
    "set_reg_then_now",
    """WITH o AS (SELECT DISTINCT restriction, family FROM ing WHERE restriction IS NOT NULL AND size <= 35), w AS (SELECT DISTINCT restriction, family FROM ing WHERE restriction IS NOT NULL AND size >= 14)
SELECT 'new' AS kind, restriction, count(*) AS families FROM w WHERE restriction NOT IN (SELECT restriction FROM o) GROUP BY restriction UNION ALL
SELECT 'gone', restriction, count(*) FROM o WHERE restriction NOT IN (SELECT restriction FROM w) GROUP BY restriction""",
)
def then_now(spark, sf):
    r = ingredient(spark, sf).where("restriction is not null")
    o, w = (r.where(c).select("restriction", "family").distinct() for c in ("size <= 35", "size >= 14"))
    only = lambda kind, a, b: a.join(b.select("restriction").distinct(), "restriction", "left_anti").groupBy(F.lit(kind).alias("kind"), "restriction").agg(F.count("*").alias("families"))
    return only("new", w, o).unionByName(only("gone", o, w))


same("set_union_keys", "SELECT ref_no FROM ing WHERE is_bio UNION SELECT compound FROM edge WHERE n_refs >= 2")
same("set_union_all", "SELECT 'ing' AS src, count(*) AS n FROM ing UNION ALL SELECT 'edge', count(*) FROM edge")


@query("set_token_overlap", "SELECT ref_no FROM ing WHERE list_has_any(functions, ['ring', 'red'])")
def overlap(spark, sf):
    return ingredient(spark, sf).where(F.arrays_overlap("functions", F.array(F.lit("ring"), F.lit("red")))).select("ref_no")


same("srt_multi_key", "SELECT ref_no, family, size FROM ing ORDER BY size DESC NULLS LAST, family, ref_no LIMIT 40")
