"""The lookup surface, run on literal requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from florispark.operators import graph as G
from florispark.operators import relational as R
from florispark.operators import serving as S
from florispark.operators.search_index import SearchIndex
from florispark.session import shared_folder

from .domain import ORACLES, edges, ingredient, query, same, species, used_by

REQUESTS = ["12", " 7 ", "c-0000000031", "Red Ring", "SMALL BOX", "nothing"]
VALUES = ", ".join(f"('{x}')" for x in REQUESTS)


def _items(spark, sf):
    return ingredient(spark, sf).withColumn("cas", F.concat(F.lit("c-"), F.lpad((F.col("ref_no") % 500).cast("string"), 10, "0")))


@query(
    "api_lookup",
    f"""WITH q(query) AS (VALUES {VALUES}), it AS (SELECT *, 'c-' || lpad(CAST(ref_no % 500 AS VARCHAR), 10, '0') AS cas FROM ing ),
 h AS (SELECT query, ref_no, name, 0 AS t, ref_no AS o FROM q JOIN it ON trim(query) = CAST(ref_no AS VARCHAR) UNION ALL SELECT query, ref_no, name, 1, ref_no FROM q JOIN it ON trim(query) = cas UNION ALL SELECT query, ref_no, name, 2, -ref_no FROM q JOIN it ON upper(trim(query)) = upper(name)),
 b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY query ORDER BY t, o) = 1)
SELECT q.query, b.ref_no, b.name FROM q LEFT JOIN b ON b.query = q.query""",
)
def lookup(spark, sf):
    return S.lookup(spark.createDataFrame([(x,) for x in REQUESTS], "query string"), _items(spark, sf))


@query(
    "api_search",
    """WITH h AS (SELECT ref_no, name, family, CASE WHEN lower(name) = 'red ring' THEN 3 WHEN contains(lower(name), 'red ring') THEN 2 WHEN contains(lower(family), 'red ring') OR contains(lower(ord), 'red ring') THEN 1 ELSE 0 END AS score FROM ing WHERE is_bio),
 f AS (SELECT * FROM h WHERE score > 0 ORDER BY name, ref_no LIMIT 100) SELECT ref_no, name, CAST(score AS BIGINT) AS score FROM f ORDER BY score DESC, name, ref_no LIMIT 20""",
)
def search(spark, sf):
    return S.search(ingredient(spark, sf), " Red Ring", ["family", "ord"], F.col("is_bio")).select("ref_no", "name", "score")


@query("api_species", "WITH c AS (SELECT compound, count(DISTINCT species) AS n_sp FROM edge GROUP BY compound) SELECT s.species, s.family, count(e.compound) AS compound_count, count(*) FILTER (c.n_sp = 1) AS own, CASE WHEN count(e.compound) = 0 THEN 'no compound data' END AS note FROM species s LEFT JOIN edge e ON e.species = s.species AND e.n_refs >= 2 LEFT JOIN c ON c.compound = e.compound GROUP BY s.species, s.family")
def species_info(spark, sf):
    e = edges(spark, sf)
    c = e.groupBy("compound").agg(F.countDistinct("species").alias("n_sp"))
    j = species(spark, sf).join(e.where("n_refs >= 2"), "species", "left").join(c, "compound", "left")
    g = j.groupBy("species", "family").agg(F.count("compound").alias("compound_count"), F.count_if(F.col("n_sp") == 1).alias("own"))
    return g.withColumn("note", F.when(F.col("compound_count") == 0, "no compound data"))


@query("api_family", "WITH x AS (SELECT * FROM ing WHERE lower(family) = lower('brand#7')), f AS (SELECT fn, count(*) AS n FROM (SELECT unnest(functions) AS fn FROM x) GROUP BY fn ORDER BY n DESC, fn LIMIT 10) SELECT count(DISTINCT name) AS names, count(*) AS n, CAST(count(restriction) * 1000 // count(*) AS BIGINT) AS restricted_permille, (SELECT string_agg(fn || ':' || n, '|' ORDER BY n DESC, fn) FROM f) AS top_functions FROM x")
def family_info(spark, sf):
    x = ingredient(spark, sf).where(F.lower("family") == "brand#7")
    top = x.select(F.explode("functions").alias("fn")).groupBy("fn").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "fn").limit(10)
    top = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "fn"))).alias("t")).select(F.array_join(F.transform("t", lambda v: F.concat_ws(":", v["fn"], (-v["m"]).cast("string"))), "|").alias("top_functions"))
    g = x.agg(F.countDistinct("name").alias("names"), F.count("*").alias("n"), F.floor(F.count("restriction") * 1000 / F.count("*")).alias("restricted_permille"))
    return g.crossJoin(F.broadcast(top))


@query("api_regulation", "SELECT ref_no, coalesce(CASE split_part(restriction, '/', 1) WHEN 'II' THEN 'II (Prohibited)' WHEN 'III' THEN 'III (Restricted)' WHEN 'IV' THEN 'IV (Colorants)' WHEN 'V' THEN 'V (Preservatives)' WHEN 'VI' THEN 'VI (UV filters)' END, split_part(restriction, '/', 1)) AS annex, split_part(restriction, '/', 2) AS entry FROM ing WHERE ref_no IN (0, 6, 13, 20, 27, 34, 500)")
def regulation(spark, sf):
    from florispark.functions.text import regulation_parts

    return ingredient(spark, sf).where(F.col("ref_no").isin(0, 6, 13, 20, 27, 34, 500)).withColumn("p", regulation_parts(F.col("restriction"))).select("ref_no", "p.annex", "p.entry")


LABELS = ["Red Ring", "redring", " small  box", "ring", "a red ring here", "", "zzz", "BLUE WIDGET"]
LIST = ", ".join(f"({i}, '{x}')" for i, x in enumerate(LABELS))


@query(
    "api_analyze_list",
    f"""WITH q(position, label) AS (VALUES {LIST}), l AS (SELECT *, upper(trim(label)) AS u FROM q WHERE trim(label) <> ''),
 m AS (SELECT position, max(ref_no) AS ref_no, 1 AS tier FROM l JOIN ing ON upper(name) = u GROUP BY position),
 m2 AS (SELECT position, min(ref_no) AS ref_no, 2 AS tier FROM l JOIN ing ON replace(upper(name), ' ', '') = replace(u, ' ', '') WHERE position NOT IN (SELECT position FROM m) GROUP BY position),
 m3 AS (SELECT position, ref_no, 3 AS tier FROM l JOIN ing ON contains(upper(name), u) OR contains(u, upper(name)) WHERE position NOT IN (SELECT position FROM m UNION ALL SELECT position FROM m2) QUALIFY row_number() OVER (PARTITION BY position ORDER BY name, ref_no) = 1),
 a AS (SELECT * FROM m UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3)
SELECT CAST(l.position AS BIGINT) AS position, l.label, a.ref_no, i.name, CAST(a.tier AS BIGINT) AS tier FROM l LEFT JOIN a ON a.position = l.position LEFT JOIN ing i ON i.ref_no = a.ref_no""",
)
def analyze(spark, sf):
    return S.match_list(spark.createDataFrame(list(enumerate(LABELS)), "position long, label string"), ingredient(spark, sf))



def _index(spark, sf):
    return SearchIndex.build(ingredient(spark, sf), ["family", "ord"], shared_folder(spark, "search-index"))


@query("api_search_indexed")
def search_indexed(spark, sf):
    """The search above from a stored index."""
    return _index(spark, sf).search(" Red Ring", ["family", "ord"], F.col("is_bio")).select("ref_no", "name", "score")


@query("api_analyze_indexed")
def analyze_indexed(spark, sf):
    """The list above from a stored index."""
    return _index(spark, sf).match_list(spark.createDataFrame(list(enumerate(LABELS)), "position long, label string"))


ORACLES |= {"api_search_indexed": ORACLES["api_search"], "api_analyze_indexed": ORACLES["api_analyze_list"]}


@query("api_list_summary", f"WITH q(label) AS (VALUES {', '.join(f'({chr(39)}{x}{chr(39)})' for x in LABELS if x)}), h AS (SELECT label, max(ref_no) AS ref_no FROM q LEFT JOIN ing ON upper(name) = upper(trim(label)) GROUP BY label) SELECT i.family, count(*) AS n FROM h JOIN ing i ON i.ref_no = h.ref_no GROUP BY i.family")
def list_summary(spark, sf):
    q = spark.createDataFrame([(x,) for x in LABELS if x], "label string").withColumn("k", F.upper(F.trim("label")))
    i = ingredient(spark, sf)
    h = q.join(i.groupBy(F.upper("name").alias("k")).agg(F.max("ref_no").alias("ref_no")), "k")
    return h.join(i.select("ref_no", "family"), "ref_no").groupBy("family").agg(F.count("*").alias("n"))


@query(
    "api_ego_graph",
    """WITH sp AS (SELECT 'species' AS kind, CAST(species AS VARCHAR) AS id, count(DISTINCT category) AS weight FROM used WHERE family = 'NATION_3' GROUP BY species),
 fn AS (SELECT 'function' AS kind, category AS id, count(DISTINCT species) AS weight FROM used WHERE family = 'NATION_3' GROUP BY category),
 co AS (SELECT 'compound' AS kind, CAST(e.compound AS VARCHAR) AS id, count(DISTINCT e.species) AS weight FROM edge e JOIN species s ON s.species = e.species WHERE s.family = 'NATION_3' GROUP BY e.compound),
 a AS (SELECT *, 30 AS cap FROM sp UNION ALL SELECT *, 15 FROM fn UNION ALL SELECT *, 20 FROM co)
SELECT kind, id, weight, rank FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY weight DESC, id) AS rank FROM a) WHERE rank <= cap""",
)
def ego(spark, sf):
    u = used_by(spark, sf).where("family = 'NATION_3'")
    e = edges(spark, sf).join(species(spark, sf).where("family = 'NATION_3'"), "species")
    count = lambda d, k, v: d.groupBy(F.col(k).alias("id")).agg(F.countDistinct(v).alias("weight"))
    return G.ego([("species", count(u, "species", "category"), 30), ("function", count(u, "category", "species"), 15), ("compound", count(e, "compound", "species"), 20)])


@query("api_browser", "SELECT ref_no, name, size, price FROM ing WHERE size BETWEEN 10 AND 30 AND price BETWEEN 900 AND 1500 AND contains(lower(name), 'ring') ORDER BY size DESC, ref_no LIMIT 24")
def browser(spark, sf):
    i = ingredient(spark, sf).withColumn("formula", F.col("ord"))
    return S.browse(i, {"size": (10, 30), "price": (900, 1500)}, [F.desc("size"), "ref_no"], "ring").select("ref_no", "name", "size", "price")


@query("api_paging", "SELECT ref_no, name FROM ing ORDER BY name, ref_no LIMIT 24 OFFSET 48")
def paging(spark, sf):
    return S.page(ingredient(spark, sf).select("ref_no", "name"), ["name", "ref_no"], 2)


@query("api_quota", "WITH b AS (SELECT 'compound' AS kind, ref_no FROM ing WHERE size = 4 AND NOT restriction IS NOT NULL ORDER BY ref_no LIMIT 5), a AS (SELECT 'ingredient' AS kind, ref_no FROM ing WHERE size = 9), n AS (SELECT count(*) AS n FROM b) SELECT kind, ref_no FROM b UNION ALL SELECT kind, ref_no FROM (SELECT *, row_number() OVER (ORDER BY ref_no) AS r FROM a) WHERE r <= 15 - (SELECT n FROM n)")
def quota(spark, sf):
    i = ingredient(spark, sf)
    part = lambda kind, cond: i.where(cond).select(F.lit(kind).alias("kind"), "ref_no")
    return S.quota(part("ingredient", "size = 9"), part("compound", "size = 4"), 15, 5, ["ref_no"])


@query("api_names_fallback", "SELECT ref_no, coalesce(CASE WHEN size % 3 = 0 THEN 'ja ' || name END, CASE WHEN size % 2 = 0 THEN 'en ' || name END) AS ja, CASE WHEN size % 5 = 0 THEN 'zh ' || name END AS zh FROM ing ")
def names(spark, sf):
    some = lambda tag, n: F.when(F.col("size") % n == 0, F.concat(F.lit(f"{tag} "), "name"))
    i = ingredient(spark, sf).select("ref_no", some("ja", 3).alias("name_ja"), some("en", 2).alias("name_en"), some("zh", 5).alias("name_zh"))
    return i.select("ref_no", S.localized("ja", ["en"]).alias("ja"), S.localized("zh", []).alias("zh"))


@query("api_two_layers", "SELECT i.ref_no, coalesce(CASE WHEN size < 20 THEN 'base' END, CASE WHEN size > 35 THEN 'add' END) AS layer FROM ing i")
def layers(spark, sf):
    i = ingredient(spark, sf)
    return R.two_layers(i.select("ref_no"), i.where("size < 20").select("ref_no", F.lit("base").alias("layer")), i.where("size > 35").select("ref_no", F.lit("add").alias("layer")), "ref_no", "layer")


@query("api_compound_roles", "WITH r AS (SELECT compound, CASE WHEN compound % 2 = 0 THEN 'even' ELSE 'odd' END AS role FROM edge WHERE n_refs >= 2 UNION SELECT compound, 'third' FROM edge WHERE compound % 3 = 0) SELECT compound, string_agg(role, '|' ORDER BY role) AS suggested FROM r GROUP BY compound")
def roles(spark, sf):
    e = edges(spark, sf)
    r = e.where("n_refs >= 2").select("compound", F.when(F.col("compound") % 2 == 0, "even").otherwise("odd").alias("role")).union(e.where("compound % 3 = 0").select("compound", F.lit("third")))
    return r.groupBy("compound").agg(F.array_join(F.array_sort(F.collect_set("role")), "|").alias("suggested"))


same("api_report_class", "SELECT CASE WHEN restriction LIKE 'II/%' THEN 'prohibited' WHEN restriction IS NOT NULL THEN 'restricted' WHEN is_bio THEN 'botanical' ELSE 'other' END AS class, count(*) AS n FROM ing GROUP BY CASE WHEN restriction LIKE 'II/%' THEN 'prohibited' WHEN restriction IS NOT NULL THEN 'restricted' WHEN is_bio THEN 'botanical' ELSE 'other' END")


@query(
    "api_answer_or_error",
    """WITH q(family) AS (VALUES ('Brand#3'), ('Brand#99')), h AS (SELECT family, '[' || string_agg('{"ref_no":' || ref_no || ',"size":' || size || '}', ',' ORDER BY ref_no) || ']' AS j FROM ing WHERE size = 3 GROUP BY family)
SELECT q.family, coalesce(h.j, '{"error":"not found: ' || q.family || '"}') AS json FROM q LEFT JOIN h ON h.family = q.family""",
)
def answer_or_error(spark, sf):
    q = spark.createDataFrame([("Brand#3",), ("Brand#99",)], "family string")
    return S.answer(ingredient(spark, sf).where("size = 3").select("family", "ref_no", "size"), q, "family")
