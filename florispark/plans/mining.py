"""Mining queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from florispark.operators import graph as G
from florispark.operators import mining as M
from florispark.operators import reachability as R
from florispark.session import dealt
from florispark.sources.readers import table

from .domain import edges, ingredient, placed_edges, query, same, species, used_by


@query(
    "mine_concentration",
    """WITH p AS (SELECT category, family, count(DISTINCT species) AS n FROM used GROUP BY category, family), t AS (SELECT *, sum(n) OVER (PARTITION BY category) AS total FROM p)
SELECT category, family, n, CAST(total AS BIGINT) AS total, CAST(n AS DOUBLE) * 100 / total AS pct, row_number() OVER (PARTITION BY category ORDER BY n DESC, family) AS rank FROM t WHERE total >= 20 QUALIFY rank <= 3""",
)
def concentration(spark, sf):
    return M.concentration(used_by(spark, sf), "category", "family", "species").withColumn("rank", F.col("rank").cast("long"))


@query(
    "mine_gaps",
    """WITH u AS (SELECT p_brand AS genus, p_type AS family, p_name AS member, CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END AS category FROM part WHERE length(p_name) % 2 = 0),
 k AS (SELECT DISTINCT p_brand AS genus, p_name AS member FROM part WHERE p_size > 30),
 s AS (SELECT category, family, count(DISTINCT member) AS n_used FROM u GROUP BY category, family HAVING count(DISTINCT member) >= 5),
 c AS (SELECT family, count(DISTINCT k.member) AS n_candidates FROM k JOIN (SELECT DISTINCT genus, family FROM u) b USING (genus) WHERE k.member NOT IN (SELECT member FROM u WHERE member IS NOT NULL) GROUP BY family)
SELECT category, s.family, n_used, n_candidates FROM s JOIN c ON s.family = c.family""",
)
def gaps(spark, sf):
    """Organisms in use are one part of the table and the wider catalogue is another: what isn't in use has to be elsewhere."""
    p = table(spark, sf, "part").select(F.col("p_brand").alias("genus"), F.col("p_type").alias("family"), F.col("p_name").alias("member"), "p_size", "p_partkey", F.when(F.col("p_size") % 2 == 0, "even").otherwise("odd").alias("category"))
    return M.gaps(p.where("length(member) % 2 = 0"), p.where("p_size > 30").select("genus", "member").distinct(), "category", "family", "member", "genus")


same(
    "mine_blind_spots",
    """SELECT i.family, count(*) AS extracts, count(*) FILTER (WHERE i.restriction IS NULL) AS unrestricted, count(DISTINCT CASE WHEN i.restriction IS NULL THEN i.name END) AS unrestricted_names
 FROM ing i WHERE i.is_bio AND i.family IN (SELECT family FROM ing WHERE is_bio AND restriction IS NOT NULL GROUP BY family HAVING count(*) >= 3) GROUP BY i.family HAVING count(*) >= 10""",
)
same("mine_convergent", "SELECT category, count(DISTINCT kingdom) AS orders, count(DISTINCT family) AS families, count(DISTINCT species) AS species FROM used GROUP BY category HAVING count(DISTINCT species) >= 10")


@query(
    "mine_niche",
    """WITH f AS (SELECT ref_no, family, ord, unnest(functions) AS fn FROM ing ), g AS (SELECT fn, ord, count(DISTINCT family) AS n_sp FROM f GROUP BY fn, ord),
 t AS (SELECT fn, count(*) AS orders, CAST(sum(n_sp) AS BIGINT) AS species, max(n_sp) AS m FROM g GROUP BY fn HAVING count(*) <= 6 AND sum(n_sp) >= 2)
SELECT t.fn, t.orders, t.species, g.ord, g.n_sp FROM t JOIN g ON g.fn = t.fn AND g.n_sp = t.m""",
)
def niche(spark, sf):
    """Niche categories with their dominant groups, ties included."""
    f = ingredient(spark, sf).select("family", "ord", F.explode("functions").alias("fn"))
    g = f.groupBy("fn", "ord").agg(F.countDistinct("family").alias("n_sp"))
    t = g.groupBy("fn").agg(F.count("*").alias("orders"), F.sum("n_sp").alias("species"), F.max("n_sp").alias("m")).where("orders <= 6 and species >= 2")
    return t.join(g, "fn").where("n_sp = m").select("fn", "orders", "species", "ord", "n_sp")


@query("mine_richness", "SELECT s.family, count(DISTINCT s.species) AS species, count(DISTINCT e.compound) AS compounds, CAST(count(*) AS DOUBLE) / count(DISTINCT s.species) AS per_species FROM species s JOIN edge e ON e.species = s.species GROUP BY s.family HAVING count(DISTINCT s.species) >= 2")
def richness(spark, sf):
    """Of each family its species, distinct compounds and pairs; each is counted over groups of its own, so that no task tells them all apart."""
    j, rows = placed_edges(spark, sf)
    of_species = j.groupBy("family", "species").agg(F.count("*").alias("n")).groupBy("family").agg(F.countDistinct("species").alias("species"), F.sum("n").alias("n"))
    compounds = dealt(j.select(F.col("family").alias("_f"), "compound"), rows, "_f", "compound").distinct().groupBy("_f").agg(F.count("compound").alias("compounds"))
    return of_species.where("species >= 2").join(compounds, F.col("family").eqNullSafe(F.col("_f"))).select("family", "species", "compounds", (F.col("n").cast("double") / F.col("species")).alias("per_species"))



@query(
    "mine_sharing",
    "SELECT family, count(*) AS total, count(*) FILTER (n >= 2) AS shared, max(n) AS most FROM (SELECT s.family, e.compound, count(DISTINCT s.species) AS n FROM species s JOIN edge e ON e.species = s.species GROUP BY s.family, e.compound) GROUP BY family HAVING count(*) >= 50",
)
def sharing(spark, sf):
    j, rows = placed_edges(spark, sf)
    return M.sharing(dealt(j.select("family", "species", "compound"), rows, "family", "compound"), "family", "species", "compound")


@query(
    "mine_part_function",
    """WITH f AS (SELECT ord AS part, unnest(functions) AS fn FROM ing ), c AS (SELECT part, fn, count(*) AS n FROM f GROUP BY part, fn)
SELECT part, count(*) AS functions, string_agg(fn, '|' ORDER BY fn) FILTER (r <= 5) AS first_names FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY fn) AS r FROM c) GROUP BY part HAVING count(*) >= 5""",
)
def part_function(spark, sf):
    g = ingredient(spark, sf).select(F.col("ord").alias("part"), F.explode("functions").alias("fn")).groupBy("part").agg(F.countDistinct("fn").alias("functions"), F.array_sort(F.collect_set("fn")).alias("names"))
    return g.where("functions >= 5").select("part", "functions", F.array_join(F.slice("names", 1, 5), "|").alias("first_names"))


PAIRS = """e AS (SELECT DISTINCT l_suppkey AS o, l_partkey AS i FROM lineitem), n AS (SELECT o, count(*) AS n FROM e GROUP BY o HAVING count(*) >= 10),
 pairs AS (SELECT a.o AS a, b.o AS b, count(*) AS shared, na.n AS n_a, nb.n AS n_b FROM e a JOIN e b ON a.i = b.i AND a.o < b.o JOIN n na ON na.o = a.o JOIN n nb ON nb.o = b.o GROUP BY 1, 2, 4, 5),
 sim AS (SELECT *, CAST(shared AS DOUBLE) / (n_a + n_b - shared) AS jaccard FROM pairs WHERE shared >= 5 AND CAST(shared AS DOUBLE) / (n_a + n_b - shared) >= 0.15)"""


def _pairs(spark, sf):
    """Species (suppliers) whose sets of compounds (parts) are alike, over all of lineitem."""
    return M.similar_pairs(table(spark, sf, "lineitem"), "l_suppkey", "l_partkey")


@query("mine_jaccard", f"WITH {PAIRS} SELECT a, b, shared, n_a, n_b, jaccard FROM sim")
def jaccard(spark, sf):
    return _pairs(spark, sf).select("a", "b", "shared", "n_a", "n_b", "jaccard")


@query(
    "mine_neighbor_coherence",
    f"""WITH {PAIRS}, sym AS (SELECT a, b, jaccard FROM sim UNION ALL SELECT b, a, jaccard FROM sim), g AS (SELECT s_suppkey AS o, s_nationkey % 4 AS g FROM supplier),
 k AS (SELECT a, ga.g AS ga, gb.g AS gb FROM sym JOIN g ga ON ga.o = a JOIN g gb ON gb.o = b QUALIFY row_number() OVER (PARTITION BY a ORDER BY jaccard DESC, b DESC, gb.g DESC) <= 5)
SELECT ga AS grp, count(DISTINCT a) AS members, count(*) AS neighbours, count(*) FILTER (ga = gb) AS same FROM k GROUP BY ga HAVING count(DISTINCT a) >= 3""",
)
def coherence(spark, sf):
    g = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("o"), (F.col("s_nationkey") % 4).alias("grp"))
    return M.neighbour_coherence(_pairs(spark, sf), g, "o", "grp")


@query("idx_compound", "WITH j AS (SELECT e.compound, s.species, s.family FROM edge e JOIN species s ON s.species = e.species), f AS (SELECT compound, family, count(*) AS n, row_number() OVER (PARTITION BY compound ORDER BY count(*) DESC, family) AS r FROM j GROUP BY compound, family) SELECT a.compound, n_sp, n_fam, top_fam FROM (SELECT compound, count(DISTINCT species) AS n_sp, count(DISTINCT family) AS n_fam FROM j GROUP BY compound HAVING count(DISTINCT species) >= 2) a JOIN (SELECT compound, string_agg(family || ':' || n, '|' ORDER BY r) AS top_fam FROM f WHERE r <= 10 GROUP BY compound) t ON t.compound = a.compound")
def compound_index(spark, sf):
    """Compounds of two species or more, with their ten most frequent families."""
    j = edges(spark, sf).join(species(spark, sf), "species")
    per = j.groupBy("compound", "family").agg(F.count("*").alias("n"))
    top = per.groupBy("compound").agg(F.sum("n").alias("n_sp"), F.count("*").alias("n_fam"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "family"))).alias("t"))
    names = F.array_join(F.transform(F.slice("t", 1, 10), lambda x: F.concat_ws(":", x["family"], (-x["m"]).cast("string"))), "|")
    return top.where("n_sp >= 2").select("compound", "n_sp", "n_fam", names.alias("top_fam"))


same(
    "idx_species_compound",
    """SELECT e.species, count(*) AS n, count(*) FILTER (WHERE c.n_sp = 1) AS own, count(*) FILTER (WHERE c.n_sp > 1) AS shared FROM edge e
 JOIN (SELECT compound, count(DISTINCT species) AS n_sp FROM edge GROUP BY compound) c ON c.compound = e.compound GROUP BY e.species""",
)


@query("idx_planar", "SELECT block, count(*) AS n, string_agg(CAST(ref_no AS VARCHAR), '|' ORDER BY ref_no) AS siblings FROM (SELECT ref_no, split_part(name || '-' || ref_no, '-', 1) AS block FROM ing ) GROUP BY block HAVING count(*) >= 2")
def planar(spark, sf):
    k = ingredient(spark, sf).select("ref_no", F.split_part(F.concat_ws("-", "name", F.col("ref_no").cast("string")), F.lit("-"), F.lit(1)).alias("block"))
    g = k.groupBy("block").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("ref_no")).alias("s")).where("n >= 2")
    return g.select("block", "n", F.array_join(F.transform("s", lambda x: x.cast("string")), "|").alias("siblings"))


@query("idx_via_names", "SELECT species, string_agg(part, '|' ORDER BY n DESC, part) AS via FROM (SELECT l_suppkey AS species, strftime(l_shipdate, '%Y-%m') AS part, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY species ORDER BY n DESC, part) <= 8) GROUP BY species")
def via_names(spark, sf):
    """Of each species, the eight names that bring most distinct compounds."""
    g = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("species"), F.date_format("l_shipdate", "yyyy-MM").alias("part")).agg(F.countDistinct("l_partkey").alias("n"))
    s = g.groupBy("species").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "part"))).alias("t"))
    return s.select("species", F.array_join(F.transform(F.slice("t", 1, 8), lambda x: x["part"]), "|").alias("via"))


@query("idx_item_only", "SELECT i.name, min(i.ref_no) AS first_ref FROM ing i WHERE i.ref_no NOT IN (SELECT compound FROM edge WHERE n_refs >= 2) GROUP BY i.name")
def item_only(spark, sf):
    i = ingredient(spark, sf)
    return i.join(edges(spark, sf).where("n_refs >= 2").select(F.col("compound").alias("ref_no")), "ref_no", "left_anti").groupBy("name").agg(F.min("ref_no").alias("first_ref"))


same("mine_coverage", "SELECT i.family, count(DISTINCT i.ref_no) AS n, count(DISTINCT CASE WHEN i.ref_no IN (SELECT compound FROM edge) THEN i.ref_no END) AS exact_hits, count(DISTINCT CASE WHEN i.ref_no IN (SELECT compound FROM edge WHERE validated) THEN i.ref_no END) AS validated_hits FROM ing i WHERE i.is_bio GROUP BY i.family")


@query("mine_fuzzy_risk", "SELECT ref_no, name, family FROM ing WHERE size % 4 = 1 AND split_part(name, ' ', -1) <> split_part(family || ' ring', ' ', -1)")
def fuzzy_risk(spark, sf):
    last = lambda c: F.element_at(F.split(c, " "), -1)
    return ingredient(spark, sf).where((F.col("size") % 4 == 1) & (last(F.col("name")) != last(F.concat("family", F.lit(" ring"))))).select("ref_no", "name", "family")


# ---- hierarchies: each part below those of half and, for some, a third of its number

DAG = "dag AS (SELECT p_partkey AS child, p_partkey // 2 AS parent FROM part WHERE p_partkey > 1 UNION SELECT p_partkey, p_partkey // 3 FROM part WHERE p_partkey > 2 AND p_partkey % 7 = 0)"
UP = f"{DAG}, up AS (SELECT child AS node, parent AS ancestor FROM dag WHERE parent > 0 UNION SELECT up.node, dag.parent FROM up JOIN dag ON dag.child = up.ancestor WHERE dag.parent > 0)"


def _dag(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("child"))
    two = p.where("child > 1").withColumn("parent", F.floor(F.col("child") / 2).cast("long"))
    return two.union(p.where("child > 2 and child % 7 = 0").withColumn("parent", F.floor(F.col("child") / 3).cast("long"))).where("parent > 0").distinct()


def _roles(spark, sf):
    return table(spark, sf, "part").where("p_partkey > 0 and p_partkey % 5 = 0").select(F.col("p_partkey").alias("node"), F.concat(F.lit("r"), (F.col("p_partkey") % 11).cast("string")).alias("role"))


ROLES = "roles AS (SELECT p_partkey AS node, 'r' || (p_partkey % 11) AS role FROM part WHERE p_partkey > 0 AND p_partkey % 5 = 0)"


@query("graph_descendants", f"WITH {DAG}, down AS (SELECT child AS node FROM dag WHERE parent = 3 UNION SELECT dag.child FROM down JOIN dag ON dag.parent = down.node) SELECT node FROM down", recursive=True)
def descend(spark, sf):
    return G.descendants(_dag(spark, sf), 3)


@query("graph_inherit", f"WITH {UP}, {ROLES}, a AS (SELECT node, role FROM roles UNION SELECT up.node, role FROM up JOIN roles ON roles.node = up.ancestor) SELECT node, count(*) AS roles, min(role) AS first_role FROM a GROUP BY node", recursive=True)
def inherit(spark, sf):
    a = G.inherited(_roles(spark, sf), G.ancestors(_dag(spark, sf)), "node", "role")
    return a.groupBy("node").agg(F.count("*").alias("roles"), F.min("attribute").alias("first_role"))


@query("graph_map_inherit", f"WITH {UP}, m AS (SELECT p_partkey AS node, p_type AS f FROM part WHERE p_partkey BETWEEN 1 AND 40), a AS (SELECT node, f FROM m UNION SELECT up.node, f FROM up JOIN m ON m.node = up.ancestor) SELECT node, string_agg(f, '|' ORDER BY f) AS functions FROM a GROUP BY node", recursive=True)
def map_inherit(spark, sf):
    m = table(spark, sf, "part").where("p_partkey between 1 and 40").select(F.col("p_partkey").alias("node"), F.col("p_type").alias("f"))
    a = G.inherited(m, G.ancestors(_dag(spark, sf)), "node", "f")
    return a.groupBy("node").agg(F.array_join(F.array_sort(F.collect_set("attribute")), "|").alias("functions"))


@query("graph_category", f"WITH {UP}, s AS (SELECT node, ancestor FROM up UNION SELECT child, child FROM dag) SELECT node, coalesce(min(CASE ancestor WHEN 4 THEN 0 WHEN 5 THEN 1 WHEN 6 THEN 2 END), 3) AS category FROM s GROUP BY node", recursive=True)
def category(spark, sf):
    d = _dag(spark, sf)
    got = G.first_root(d.select("child").distinct(), G.ancestors(d), [4, 5, 6], "child")
    return got


# ---- a deep hierarchy: runs of fifty, each part below the one before it, each run below a part of a fiftieth of its number; some are below a third of theirs as well

DEEP = "deep AS (SELECT p_partkey AS child, CASE WHEN p_partkey % 50 = 1 THEN p_partkey // 50 ELSE p_partkey - 1 END AS parent FROM part WHERE p_partkey > 1 UNION SELECT p_partkey, p_partkey // 3 FROM part WHERE p_partkey > 2 AND p_partkey % 35 = 0)"
ABOVE = f"{DEEP}, above AS (SELECT child AS node, parent AS ancestor FROM deep WHERE parent > 0 UNION SELECT above.node, deep.parent FROM above JOIN deep ON deep.child = above.ancestor WHERE deep.parent > 0)"


def _deep(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("child"))
    run = p.where("child > 1").withColumn("parent", F.when(F.col("child") % 50 == 1, F.floor(F.col("child") / 50).cast("long")).otherwise(F.col("child") - 1))
    return run.union(p.where("child > 2 and child % 35 = 0").withColumn("parent", F.floor(F.col("child") / 3).cast("long"))).where("parent > 0")


@query("reach_below", f"WITH {DEEP}, down AS (SELECT child AS node FROM deep WHERE parent = 2 UNION SELECT deep.child FROM down JOIN deep ON deep.parent = down.node) SELECT node FROM down", recursive=True)
def reach_below(spark, sf):
    return R.below(2, R.labels(_deep(spark, sf)))


@query("reach_inherit", f"WITH {ABOVE}, {ROLES}, a AS (SELECT node, role FROM roles UNION SELECT above.node, role FROM above JOIN roles ON roles.node = above.ancestor) SELECT node, count(*) AS roles, min(role) AS first_role FROM a GROUP BY node", recursive=True)
def reach_inherit(spark, sf):
    a = R.inherited(_roles(spark, sf), R.labels(_deep(spark, sf)), "node", "role")
    return a.groupBy("node").agg(F.count("*").alias("roles"), F.min("attribute").alias("first_role"))


@query("reach_category", f"WITH {ABOVE}, n AS (SELECT child AS node FROM deep WHERE parent > 0 UNION SELECT parent FROM deep WHERE parent > 0), s AS (SELECT node, ancestor FROM above UNION SELECT node, node FROM n) SELECT node, coalesce(min(CASE ancestor WHEN 40 THEN 0 WHEN 20 THEN 1 WHEN 3 THEN 2 END), 3) AS category FROM s GROUP BY node", recursive=True)
def reach_category(spark, sf):
    return R.first_root(R.labels(_deep(spark, sf)), [40, 20, 3])


@query(
    "graph_match_tiers",
    """WITH k AS (SELECT p_brand || '-' || CASE WHEN p_size % 3 = 0 THEN 'U' ELSE 'S' END AS key FROM part GROUP BY 1), t AS (SELECT DISTINCT p_brand || '-U' AS key, p_type AS role FROM part WHERE p_size % 3 = 0 AND p_brand < 'Brand#2')
SELECT key, role, 0 AS tier FROM k JOIN t USING (key) UNION SELECT k.key, t.role, 1 FROM k JOIN t ON split_part(k.key, '-', 1) = split_part(t.key, '-', 1) WHERE k.key NOT IN (SELECT key FROM t)""",
)
def tiers(spark, sf):
    p = table(spark, sf, "part")
    k = p.select(F.concat("p_brand", F.lit("-"), F.when(F.col("p_size") % 3 == 0, "U").otherwise("S")).alias("key")).distinct()
    t = p.where("p_size % 3 = 0 and p_brand < 'Brand#2'").select(F.concat("p_brand", F.lit("-U")).alias("key"), F.col("p_type").alias("role")).distinct()
    return G.two_tier_match(k, t, "key", F.split_part("key", F.lit("-"), F.lit(1)), "role")


@query(
    "eval_agreement",
    """WITH l AS (SELECT ref_no, unnest(functions) AS fn FROM ing ), s AS (SELECT ref_no, unnest([split_part(name, ' ', 1), CASE WHEN is_bio THEN 'ring' ELSE 'box' END]) AS fn FROM ing ), j AS (SELECT DISTINCT s.ref_no, s.fn, l.fn IS NOT NULL AS hit FROM s LEFT JOIN l ON l.ref_no = s.ref_no AND l.fn = s.fn)
SELECT fn, count(*) AS suggested, count(*) FILTER (hit) AS agreed FROM j GROUP BY fn""",
)
def agreement(spark, sf):
    i = ingredient(spark, sf)
    lab = i.select("ref_no", F.explode("functions").alias("fn")).withColumn("hit", F.lit(True)).distinct()
    sug = i.select("ref_no", F.explode(F.array(F.split_part("name", F.lit(" "), F.lit(1)), F.when(F.col("is_bio"), "ring").otherwise("box"))).alias("fn")).distinct()
    return sug.join(lab, ["ref_no", "fn"], "left").groupBy("fn").agg(F.count("*").alias("suggested"), F.count_if("hit").alias("agreed"))
