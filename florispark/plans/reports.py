"""Named reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from florispark.operators import relational as R
from florispark.operators.mining import concentration_curve
from florispark.sources.readers import table

from .domain import edges, ingredient, query, same, species, used_by


@query("rpt_composition_share", "SELECT kind, count(*) AS n, CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct FROM (SELECT CASE WHEN is_bio THEN 'plant' ELSE 'synthetic' END AS kind FROM ing ) GROUP BY kind")
def composition(spark, sf):
    return R.share_of_total(ingredient(spark, sf), F.when(F.col("is_bio"), "plant").otherwise("synthetic"), "kind")


same("rpt_kingdom_counts", "SELECT coalesce(kingdom, 'unknown') AS kingdom, count(*) AS n, count(DISTINCT family) AS families FROM species GROUP BY coalesce(kingdom, 'unknown')")


@query(
    "rpt_function_split",
    """WITH f AS (SELECT ref_no, is_bio, unnest(functions) AS fn FROM ing ),
 b AS (SELECT fn, count(*) AS n_bio FROM f WHERE is_bio GROUP BY fn), s AS (SELECT fn, count(*) AS n_syn FROM f WHERE NOT is_bio AND fn <> 'ring' GROUP BY fn)
SELECT coalesce(b.fn, s.fn) AS fn, coalesce(n_bio, 0) AS n_bio, coalesce(n_syn, 0) AS n_syn, CAST(n_bio AS DOUBLE) / nullif(n_syn, 0) AS ratio
FROM b FULL JOIN s ON b.fn = s.fn WHERE coalesce(n_bio, 0) + coalesce(n_syn, 0) >= 20""",
)
def function_split(spark, sf):
    ing = ingredient(spark, sf)
    bio = ing.where("is_bio").select("ref_no")
    f = ing.select("ref_no", F.explode("functions").alias("fn"))
    b = f.join(bio, "ref_no", "left_semi").groupBy("fn").agg(F.count("*").alias("n_bio"))
    s = f.join(bio, "ref_no", "left_anti").where("fn <> 'ring'").groupBy("fn").agg(F.count("*").alias("n_syn"))
    j = b.join(s, "fn", "full").withColumn("ratio", F.try_divide(F.col("n_bio").cast("double"), F.col("n_syn")))
    return j.na.fill(0, ["n_bio", "n_syn"]).where("n_bio + n_syn >= 20")


@query(
    "rpt_dominant_part",
    """WITH g AS (SELECT p_brand AS family, l_returnflag || l_linestatus AS part, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
 t AS (SELECT *, sum(n) OVER (PARTITION BY family) AS total FROM g)
SELECT family, part, n, CAST(total AS BIGINT) AS total, CAST(n AS DOUBLE) * 100 / total AS pct FROM t WHERE total >= 60 QUALIFY row_number() OVER (PARTITION BY family ORDER BY n DESC, part) = 1""",
)
def dominant_part(spark, sf):
    """The most frequent value of each group, and its share."""
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    g = li.join(p, li.l_partkey == p.p_partkey).groupBy(F.col("p_brand").alias("family"), F.concat("l_returnflag", "l_linestatus").alias("part")).agg(F.count("*").alias("n"))
    g = g.withColumn("total", F.sum("n").over(Window.partitionBy("family"))).where("total >= 60")
    return R.top_per_group(g, ["family"], [F.desc("n"), F.asc("part")]).select("family", "part", "n", "total", (F.col("n").cast("double") * 100 / F.col("total")).alias("pct"))


@query("rpt_multi_value_species", "SELECT family, count(DISTINCT list_sort(functions)) AS sets, count(*) AS n FROM ing GROUP BY family HAVING count(DISTINCT list_sort(functions)) >= 2 ORDER BY sets DESC, n DESC, family LIMIT 12")
def multi_value(spark, sf):
    g = ingredient(spark, sf).groupBy("family").agg(F.countDistinct(F.array_sort("functions")).alias("sets"), F.count("*").alias("n"))
    return g.where("sets >= 2").orderBy(F.desc("sets"), F.desc("n"), "family").limit(12)


same(
    "rpt_restriction_rate",
    """SELECT family, count(*) AS n, count(*) FILTER (WHERE restriction IS NOT NULL) AS restricted, count(DISTINCT ord) FILTER (WHERE restriction IS NOT NULL) AS orders_restricted,
 count(DISTINCT CASE WHEN is_bio THEN name END) AS bio_names, CAST(count(restriction) AS DOUBLE) / count(*) AS rate FROM ing GROUP BY family HAVING count(*) >= 10""",
)


@query(
    "rpt_restriction_concentration",
    "SELECT restriction, count(DISTINCT family) AS families, string_agg(DISTINCT family, ', ' ORDER BY family) AS names FROM ing WHERE restriction IS NOT NULL GROUP BY restriction HAVING count(DISTINCT family) >= 3",
)
def restriction_concentration(spark, sf):
    g = ingredient(spark, sf).where("restriction is not null").groupBy("restriction").agg(F.countDistinct("family").alias("families"), F.array_join(F.array_sort(F.collect_set("family")), ", ").alias("names"))
    return g.where("families >= 3")


same(
    "rpt_long_tail",
    """SELECT bucket, count(*) AS members, CAST(sum(n) AS BIGINT) AS total FROM (SELECT l_partkey, count(*) AS n, CASE WHEN count(*) <= 10 THEN '01-10' WHEN count(*) <= 25 THEN '11-25' WHEN count(*) <= 50 THEN '26-50' ELSE '51+' END AS bucket
 FROM lineitem GROUP BY l_partkey) AS g GROUP BY bucket""",
)


@query(
    "rpt_concentration_curve",
    """WITH g AS (SELECT l_partkey AS part, count(*) AS n FROM lineitem GROUP BY 1),
 r AS (SELECT row_number() OVER (ORDER BY n DESC, part) AS rank, part, n, sum(n) OVER (ORDER BY n DESC, part ROWS UNBOUNDED PRECEDING) AS running, sum(n) OVER () AS total, count(*) OVER () AS last FROM g)
SELECT rank, part, n, CAST(running AS BIGINT) AS running, CAST(running AS DOUBLE) * 100 / total AS pct FROM r WHERE rank IN (5, 10, 20, 50, 100) OR rank = last""",
)
def curve(spark, sf):
    df = concentration_curve(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("part")), "part", [5, 10, 20, 50, 100])
    return df.withColumn("rank", F.col("rank").cast("long"))


@query("rpt_rows_per_year", "SELECT CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n, CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct FROM orders GROUP BY 1")
def per_year(spark, sf):
    return R.share_of_total(table(spark, sf, "orders"), F.year("o_orderdate").cast("long"), "y")


same("rpt_label_granularity", "SELECT count(DISTINCT name) AS names, CAST(count(DISTINCT name) AS DOUBLE) / (SELECT count(*) FROM ing WHERE is_bio) AS per_extract FROM ing")


@query(
    "prof_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS blank, count(DISTINCT {c}) AS distinct_values, CAST(max(length(CAST({c} AS VARCHAR))) AS BIGINT) AS longest FROM customer"
        for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    ),
)
def prof(spark, sf):
    return R.profile(table(spark, sf, "customer"), ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])


same("rpt_discrepancy_pairs", "SELECT family, ord, count(*) AS n FROM ing WHERE restriction IS NOT NULL AND name <> '' AND family NOT IN ('Brand#1', 'Brand#2') AND size BETWEEN 10 AND 40 GROUP BY family, ord HAVING count(*) > 1")
same("rpt_status_distribution", "SELECT status, count(*) AS n, count(DISTINCT family) AS families FROM (SELECT family, CASE WHEN size % 10 = 0 THEN 'unresolved' WHEN is_bio THEN 'agree' ELSE 'auto' END AS status FROM ing) AS s GROUP BY status")
same("rpt_structure_coverage", "SELECT count(*) AS compounds, count(*) FILTER (WHERE n_refs >= 2) AS well_referenced, count(*) FILTER (WHERE validated) AS validated, count(DISTINCT compound) AS distinct_compounds, CAST(sum(n_refs) AS BIGINT) AS refs FROM edge", edges_by=("compound",))
same(
    "rpt_scalar_facts",
    """SELECT (SELECT count(*) FROM ing) AS ingredients, (SELECT count(*) FROM ing WHERE is_bio) AS extracts, (SELECT count(DISTINCT family) FROM species) AS families,
 (SELECT count(*) FROM edge) AS pairs, (SELECT count(DISTINCT compound) FROM edge) AS compounds, (SELECT count(*) FROM ing WHERE name LIKE '%ring%') AS like_ring""",
)
same("rpt_non_plant_groups", "SELECT CASE WHEN family IN ('NATION_0', 'NATION_1', 'NATION_2') THEN 'fungi' WHEN family IN ('NATION_3', 'NATION_4') THEN 'algae' ELSE 'plants' END AS grp, count(*) AS n FROM species GROUP BY CASE WHEN family IN ('NATION_0', 'NATION_1', 'NATION_2') THEN 'fungi' WHEN family IN ('NATION_3', 'NATION_4') THEN 'algae' ELSE 'plants' END")
same("rpt_pattern_counts", "SELECT count(*) FILTER (WHERE name LIKE '%ring%') AS has_word, count(*) FILTER (WHERE family LIKE 'Brand#1%') AS prefix, CAST(sum(CASE WHEN restriction IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS restricted, min(size) AS lo, max(size) AS hi FROM ing")


@query(
    "rpt_dossier_species",
    """SELECT s.species, min(s.family) AS family, min(s.kingdom) AS kingdom, count(DISTINCT e.compound) AS compounds, coalesce(string_agg(DISTINCT fn, '|' ORDER BY fn), '') AS functions
FROM species s LEFT JOIN edge e ON e.species = s.species LEFT JOIN (SELECT ref_no, unnest(functions) AS fn FROM ing ) f ON f.ref_no = e.compound GROUP BY s.species""",
)
def dossier(spark, sf):
    f = ingredient(spark, sf).select(F.col("ref_no").alias("compound"), F.explode_outer("functions").alias("fn"))
    j = species(spark, sf).join(edges(spark, sf), "species", "left").join(f, "compound", "left")
    return j.groupBy("species").agg(F.min("family").alias("family"), F.min("kingdom").alias("kingdom"), F.countDistinct("compound").alias("compounds"), F.array_join(F.array_sort(F.collect_set("fn")), "|").alias("functions"))


same("rpt_dossier_family", "SELECT family, count(*) AS species, count(DISTINCT kingdom) AS kingdoms FROM species GROUP BY family HAVING count(*) >= 1")


@query("rpt_dossier_function", "SELECT category, count(DISTINCT species) AS species, count(DISTINCT family) AS families, string_agg(DISTINCT kingdom, '|' ORDER BY kingdom) AS kingdoms FROM used GROUP BY category")
def dossier_function(spark, sf):
    return used_by(spark, sf).groupBy("category").agg(F.countDistinct("species").alias("species"), F.countDistinct("family").alias("families"), F.array_join(F.array_sort(F.collect_set("kingdom")), "|").alias("kingdoms"))


same("rpt_note_index", "SELECT s.species, s.family, count(*) AS extracts, round(CAST(count(DISTINCT e.compound) AS DOUBLE) / 7, 6) AS ratio FROM species s JOIN edge e ON e.species = s.species WHERE s.kingdom <> '' GROUP BY s.species, s.family HAVING count(*) >= 5 ORDER BY family, extracts DESC, species LIMIT 25", edges_by=("species",))


@query("rpt_list_size_median", "WITH g AS (SELECT species, count(*) AS n FROM edge GROUP BY species), s AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS i, count(*) OVER () AS c FROM g) SELECT n AS upper_median FROM s WHERE i = c // 2")
def median(spark, sf):
    return R.upper_median(edges(spark, sf).groupBy("species").agg(F.count("*").alias("n")), "n").withColumnRenamed("n", "upper_median")


@query("agg_most_common", "SELECT fn, count(*) AS n FROM (SELECT unnest(functions) AS fn FROM ing ) GROUP BY fn ORDER BY n DESC, fn LIMIT 7")
def most_common(spark, sf):
    return ingredient(spark, sf).select(F.explode("functions").alias("fn")).groupBy("fn").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "fn").limit(7)


same("rpt_annex_breakdown", "SELECT split_part(restriction, '/', 1) AS annex, count(*) AS n, count(DISTINCT family) AS families, count(*) FILTER (WHERE is_bio) AS plants FROM ing WHERE restriction IS NOT NULL GROUP BY split_part(restriction, '/', 1)")
same("rpt_family_normalisation", "SELECT before_names, after_names, before_names - after_names AS merged FROM (SELECT count(DISTINCT family) AS before_names, count(DISTINCT CASE WHEN family IN ('Brand#1', 'Brand#10', 'Brand#11') THEN 'Brand#1' ELSE family END) AS after_names FROM ing) AS s")
