"""More of the lookup and report surface: ego graphs of every centre, search filters, parts and processes, stated facts, names."""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import functions as F

from florispark.functions import text as T
from florispark.operators import graph as G
from florispark.operators import serving as S
from florispark.operators.relational import top_per_group
from florispark.session import dealt
from florispark.sources.readers import table

from .domain import edges, edges_dealt, ingredient, query, species, used_by

RANKED = "SELECT kind, id, weight, rank FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY weight DESC, id) AS rank FROM a) WHERE rank <= cap"


def _count(df, key, value):
    return df.groupBy(F.col(key).cast("string").alias("id")).agg(F.countDistinct(value).alias("weight"))


def _compounds(spark, sf, of):
    """Compounds of some species, weighted by all species that have them."""
    e = edges(spark, sf).select("species", "compound")
    some = e.join(of, "species", "left_semi").select("compound").distinct()
    return _count(e.join(some, "compound", "left_semi"), "compound", "species")


COMPOUNDS = "SELECT 'compound' AS kind, CAST(compound AS VARCHAR) AS id, count(DISTINCT species) AS weight FROM edge WHERE compound IN (SELECT compound FROM edge WHERE species IN (SELECT species FROM sp)) GROUP BY compound"


@query(
    "api_ego_function",
    f"""WITH sp AS (SELECT DISTINCT species FROM used WHERE category = 'ring'), fa AS (SELECT 'family' AS kind, family AS id, count(DISTINCT species) AS weight FROM used WHERE category = 'ring' GROUP BY family),
 it AS (SELECT 'ingredient' AS kind, CAST(ref_no AS VARCHAR) AS id, CASE WHEN restriction IS NULL THEN 0 ELSE 1 END AS weight FROM ing WHERE list_contains(functions, 'ring')), co AS ({COMPOUNDS}),
 a AS (SELECT *, 35 AS cap FROM fa UNION ALL SELECT *, 15 FROM it UNION ALL SELECT *, 15 FROM co) {RANKED}""",
)
def ego_function(spark, sf):
    """Families by members, ingredients with the regulated first, compounds by species."""
    u = used_by(spark, sf).where("category = 'ring'")
    items = ingredient(spark, sf).where(F.array_contains("functions", "ring")).select(F.col("ref_no").alias("id"), F.when(F.col("restriction").isNull(), 0).otherwise(1).alias("weight"))
    return G.ego([("family", _count(u, "family", "species"), 35), ("ingredient", items, 15), ("compound", _compounds(spark, sf, u.select("species").distinct()), 15)])


@query(
    "api_ego_ingredient",
    f"""WITH c AS (SELECT * FROM ing WHERE ref_no = 7), sp AS (SELECT DISTINCT species FROM edge WHERE compound = 7),
 fn AS (SELECT 'function' AS kind, f AS id, 1 AS weight FROM (SELECT DISTINCT unnest(functions) AS f FROM c)), fa AS (SELECT 'family' AS kind, family AS id, 1 AS weight FROM c),
 so AS (SELECT 'species' AS kind, CAST(min(species) AS VARCHAR) AS id, 1 AS weight FROM sp), re AS (SELECT 'ingredient' AS kind, CAST(ref_no AS VARCHAR) AS id, 1 AS weight FROM ing WHERE name IN (SELECT name FROM c) AND ref_no <> 7), co AS ({COMPOUNDS}),
 a AS (SELECT *, 1000000 AS cap FROM fn UNION ALL SELECT *, 1 FROM fa UNION ALL SELECT *, 1 FROM so UNION ALL SELECT *, 15 FROM re UNION ALL SELECT *, 12 FROM co) {RANKED}""",
)
def ego_ingredient(spark, sf):
    """All functions, the family, the source species, others of one name, compounds by species."""
    i, own = ingredient(spark, sf), F.col("ref_no") == 7
    one = lambda df, c: df.select(F.col(c).alias("id"), F.lit(1).alias("weight"))
    c, sources = i.where(own), edges(spark, sf).where("compound = 7").select("species").distinct()
    related = i.where(~own).join(c.select("name"), "name", "left_semi")
    return G.ego([
        ("function", one(c.select(F.explode("functions").alias("f")).distinct(), "f"), 1_000_000),
        ("family", one(c, "family"), 1),
        ("species", one(sources.agg(F.min("species").alias("s")), "s"), 1),
        ("ingredient", one(related, "ref_no"), 15),
        ("compound", _compounds(spark, sf, sources), 12),
    ])


@query(
    "api_ego_species",
    f"""WITH sp AS (SELECT 3 AS species), fn AS (SELECT 'function' AS kind, f AS id, count(DISTINCT ref_no) AS weight FROM (SELECT ref_no, unnest(functions) AS f FROM ing ) i JOIN edge e ON e.compound = i.ref_no WHERE e.species = 3 GROUP BY f), co AS ({COMPOUNDS}),
 a AS (SELECT *, 10 AS cap FROM fn UNION ALL SELECT *, 15 FROM co) {RANKED}""",
)
def ego_species(spark, sf):
    own = edges(spark, sf).where("species = 3").select("species", F.col("compound").alias("ref_no"))
    f = ingredient(spark, sf).select("ref_no", F.explode("functions").alias("f")).join(own, "ref_no")
    return G.ego([("function", _count(f, "f", "ref_no"), 10), ("compound", _compounds(spark, sf, own.select("species").distinct()), 15)])


@query(
    "api_ego_compound",
    f"""WITH sp AS (SELECT DISTINCT species FROM edge WHERE compound = 11), fn AS (SELECT 'function' AS kind, category AS id, count(DISTINCT species) AS weight FROM used WHERE species IN (SELECT species FROM sp) GROUP BY category),
 so AS (SELECT 'species' AS kind, CAST(species AS VARCHAR) AS id, n_refs AS weight FROM edge WHERE compound = 11), a AS (SELECT *, 10 AS cap FROM fn UNION ALL SELECT *, 20 FROM so) {RANKED}""",
)
def ego_compound(spark, sf):
    own = edges(spark, sf).where("compound = 11")
    u = used_by(spark, sf).join(own, "species", "left_semi")
    return G.ego([("function", _count(u, "category", "species"), 10), ("species", own.select(F.col("species").alias("id"), F.col("n_refs").alias("weight")), 20)])


SCORE = "CASE WHEN lower(name) = 'ring' THEN 3 WHEN contains(lower(name), 'ring') THEN 2 WHEN contains(lower(ord), 'ring') THEN 1 ELSE 0 END"


@query(
    "api_search_filters",
    f"""WITH h AS (SELECT *, {SCORE} AS score FROM ing ),
 a AS (SELECT 'function and family' AS request, ref_no, name, score, name AS o FROM h WHERE score > 0 AND list_contains(functions, 'red') AND family = 'Brand#7' ORDER BY name, ref_no LIMIT 50),
 b AS (SELECT 'restricted only' AS request, ref_no, name, score, name AS o FROM h WHERE score > 0 AND restriction IS NOT NULL ORDER BY name, ref_no LIMIT 50),
 c AS (SELECT 'unknown filters' AS request, ref_no, name, score, name AS o FROM h WHERE score > 0 ORDER BY name, ref_no LIMIT 50), u AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
SELECT request, ref_no, name, CAST(score AS BIGINT) AS score FROM u QUALIFY row_number() OVER (PARTITION BY request ORDER BY score DESC, name, ref_no) <= 10""",
)
def search_filters(spark, sf):
    i = ingredient(spark, sf)
    ask = lambda request, **how: S.search(i, "ring", ["ord"], limit=10, **how).select(F.lit(request).alias("request"), "ref_no", "name", "score")
    return ask("function and family", function="RED", family="brand#7").union(ask("restricted only", restricted_only=True)).union(ask("unknown filters", function="no such", family="none"))


# ---- parts and processes: words of a name are parts, its order is the process ----------------------

@query(
    "rpt_part_process_counts",
    """WITH x AS (SELECT * FROM ing WHERE is_bio) SELECT 'part' AS what, p AS value, count(*) AS n FROM (SELECT unnest(functions) AS p FROM x) GROUP BY p
UNION ALL SELECT 'process', ord, count(*) FROM x GROUP BY ord UNION ALL SELECT 'modifier', m, count(*) FROM (SELECT unnest(functions[2:]) AS m FROM x) GROUP BY m UNION ALL SELECT 'without restriction', '', count(*) FILTER (restriction IS NULL) FROM x""",
)
def part_process_counts(spark, sf):
    x = ingredient(spark, sf).where("is_bio")
    count = lambda what, df, c: df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "value", "n")
    parts, mods = x.select(F.explode("functions").alias("p")), x.select(F.explode(F.slice("functions", 2, 100)).alias("m"))
    none = x.agg(F.count_if(F.col("restriction").isNull()).alias("n")).select(F.lit("without restriction").alias("what"), F.lit("").alias("value"), "n")
    return count("part", parts, "p").union(count("process", x, "ord")).union(count("modifier", mods, "m")).union(none)


@query("rpt_family_part_sets", "SELECT family, array_to_string(list_sort(functions), '|') AS parts, count(*) AS n FROM ing WHERE is_bio GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY n DESC, family, parts LIMIT 12")
def family_part_sets(spark, sf):
    x = ingredient(spark, sf).where("is_bio").groupBy("family", F.array_join(F.sort_array("functions"), "|").alias("parts")).agg(F.count("*").alias("n"))
    return x.where("n >= 2").orderBy(F.desc("n"), "family", "parts").limit(12)


@query("rpt_many_part_sets", "SELECT ord, count(DISTINCT list_sort(functions)) AS sets, count(*) AS n FROM ing WHERE is_bio GROUP BY ord HAVING count(DISTINCT list_sort(functions)) >= 4 ORDER BY sets DESC, n DESC, ord LIMIT 12")
def many_part_sets(spark, sf):
    x = ingredient(spark, sf).where("is_bio").groupBy("ord").agg(F.countDistinct(F.sort_array("functions")).alias("sets"), F.count("*").alias("n"))
    return x.where("sets >= 4").orderBy(F.desc("sets"), F.desc("n"), "ord").limit(12)


def _dossier(rows, key, many):
    """(key, species, families, items, top_species, top_families): the 20 species with most items and the 15 families with most species.

    rows are some `many`.  Each count has groups of its own, whose members are in one task.
    """
    own = lambda of, value: dealt(rows.select(key, of, value), many, key, of).groupBy(key, of).agg(F.countDistinct(value).alias("n"))
    by_species = own("species", "ref_no")
    by_family = dealt(rows.select(key, "family", "species"), many, key, "species").distinct().groupBy(key, "family").agg(F.count("species").alias("n"))
    items = dealt(rows.select(key, "ref_no"), many, key, "ref_no").distinct().groupBy(key).agg(F.count("ref_no").alias("items"))

    def top(g, of, k, name):
        ranked = top_per_group(g, [key], [F.desc("n"), F.asc(of)], k)
        return ranked.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(of).alias("v")))), lambda x: F.concat_ws(":", x["v"].cast("string"), (-x["m"]).cast("string"))), "|").alias(name))

    stats = by_species.groupBy(key).agg(F.count("species").alias("species")).join(by_family.groupBy(key).agg(F.count("family").alias("families")), key).join(items, key)
    return stats.join(top(by_species, "species", 20, "top_species"), key).join(top(by_family, "family", 15, "top_families"), key)


def _dossier_sql(rows, key):
    return f"""WITH r AS ({rows}), s AS (SELECT {key}, count(DISTINCT species) AS species, count(DISTINCT family) AS families, count(DISTINCT ref_no) AS items FROM r GROUP BY {key}),
 a AS (SELECT {key}, species, count(DISTINCT ref_no) AS n FROM r GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY count(DISTINCT ref_no) DESC, species) <= 20),
 b AS (SELECT {key}, family, count(DISTINCT species) AS n FROM r GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY count(DISTINCT species) DESC, family) <= 15)
SELECT s.*, (SELECT string_agg(species || ':' || n, '|' ORDER BY n DESC, species) FROM a WHERE a.{key} = s.{key}) AS top_species, (SELECT string_agg(family || ':' || n, '|' ORDER BY n DESC, family) FROM b WHERE b.{key} = s.{key}) AS top_families FROM s"""


def _placed(spark, sf):
    li = table(spark, sf, "lineitem")
    rows = li.count()
    e = dealt(li.select(F.col("l_suppkey").cast("long").alias("species"), F.col("l_partkey").cast("long").alias("ref_no")), rows, "species", "ref_no").distinct()
    s = species(spark, sf).select("species", "family")
    return dealt(e, rows, "ref_no").hint("merge").join(ingredient(spark, sf).drop("family"), "ref_no").join(s, "species")


PLACED = "(SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS species, CAST(l_partkey AS BIGINT) AS ref_no FROM lineitem) e JOIN (SELECT ref_no, functions, ord FROM ing ) i USING (ref_no) JOIN (SELECT species, family FROM species ) s USING (species)"


@query("rpt_dossier_part", _dossier_sql(f"SELECT unnest(functions) AS part, species, family, ref_no FROM {PLACED}", "part"))
def dossier_part(spark, sf):
    words = ingredient(spark, sf).agg(F.ceil(F.avg(F.size("functions")))).first()[0] or 1
    return _dossier(_placed(spark, sf).select(F.explode("functions").alias("part"), "species", "family", "ref_no"), "part", table(spark, sf, "lineitem").count() * words)


@query("rpt_dossier_process", _dossier_sql(f"SELECT ord AS process, species, family, ref_no FROM {PLACED}", "process"))
def dossier_process(spark, sf):
    return _dossier(_placed(spark, sf).withColumnRenamed("ord", "process"), "process", table(spark, sf, "lineitem").count())


# label -> (table, expression): counts of rows, of distinct values, of rows and values under a condition
FACTS = {
    "ingredients": ("ing", "count(*)"),
    "extracts": ("ing", "count(CASE WHEN is_bio THEN 1 END)"),
    "synthetic": ("ing", "count(CASE WHEN NOT is_bio THEN 1 END)"),
    "restricted": ("ing", "count(restriction)"),
    "restricted extracts": ("ing", "count(CASE WHEN is_bio THEN restriction END)"),
    "restrictions": ("ing", "count(DISTINCT restriction)"),
    "names": ("ing", "count(DISTINCT name)"),
    "extract names": ("ing", "count(DISTINCT CASE WHEN is_bio THEN name END)"),
    "brands": ("ing", "count(DISTINCT family)"),
    "extract brands": ("ing", "count(DISTINCT CASE WHEN is_bio THEN family END)"),
    "orders": ("ing", "count(DISTINCT ord)"),
    "sizes": ("ing", "count(DISTINCT size)"),
    "annex II": ("ing", "count(CASE WHEN restriction LIKE 'II/%' THEN 1 END)"),
    "annex III": ("ing", "count(CASE WHEN restriction LIKE 'III/%' THEN 1 END)"),
    "with ring": ("ing", "count(CASE WHEN name LIKE '%ring%' THEN 1 END)"),
    "economy": ("ing", "count(CASE WHEN ord = 'ECONOMY' THEN 1 END)"),
    "small sizes": ("ing", "count(CASE WHEN size BETWEEN 1 AND 5 THEN 1 END)"),
    "pairs": ("edge", "count(*)"),
    "pair species": ("edge", "count(DISTINCT species)"),
    "pair compounds": ("edge", "count(DISTINCT compound)"),
    "validated pairs": ("edge", "count(CASE WHEN validated THEN 1 END)"),
    "validated compounds": ("edge", "count(DISTINCT CASE WHEN validated THEN compound END)"),
    "single references": ("edge", "count(CASE WHEN n_refs = 1 THEN 1 END)"),
    "well referenced": ("edge", "count(CASE WHEN n_refs >= 2 THEN 1 END)"),
    "most references": ("edge", "max(n_refs)"),
    "species": ("species", "count(*)"),
    "families": ("species", "count(DISTINCT family)"),
    "kingdoms": ("species", "count(DISTINCT kingdom)"),
    "categories": ("used", "count(DISTINCT category)"),
    "species in use": ("used", "count(DISTINCT species)"),
    "families in use": ("used", "count(DISTINCT family)"),
    "uses": ("used", "count(*)"),
    "references": ("orders", "count(*)"),
    "reference customers": ("orders", "count(DISTINCT o_custkey)"),
    "priorities": ("orders", "count(DISTINCT o_orderpriority)"),
    "rows": ("lineitem", "count(*)"),
    "returned rows": ("lineitem", "count(CASE WHEN l_returnflag = 'R' THEN 1 END)"),
    "referenced orders": ("lineitem", "count(DISTINCT l_orderkey)"),
    "customers": ("customer", "count(*)"),
}


@query("rpt_stated_facts", " UNION ALL ".join(f"SELECT '{label}' AS fact, CAST({sql} AS BIGINT) AS value FROM {t} " for label, (t, sql) in FACTS.items()))
def stated_facts(spark, sf):
    """39 scalar facts; those of one table are found in one pass over it.

    Its rows are dealt by the column that has most values, so that no task holds the distinct values of a whole split.
    """
    by = {"ing": "name", "orders": "o_custkey", "lineitem": "l_orderkey"}
    make = {"ing": ingredient, "edge": partial(edges_dealt, ("compound",)), "species": species, "used": used_by}
    out = None
    for t in dict.fromkeys(t for t, _ in FACTS.values()):
        own = {label: sql for label, (x, sql) in FACTS.items() if x == t}
        held = make[t](spark, sf) if t in make else table(spark, sf, t)
        if t in by:
            named = [c for c in held.columns if c == by[t] or any(re.search(rf"\b{c}\b", sql) for sql in own.values())]
            held = dealt(held.select(named), held.count(), by[t])
        one = held.agg(*(F.expr(sql).cast("long").alias(f"f{i}") for i, sql in enumerate(own.values())))
        pairs = ", ".join(f"'{label}', f{i}" for i, label in enumerate(own))
        rows = one.selectExpr(f"stack({len(own)}, {pairs}) as (fact, value)")
        out = rows if out is None else out.union(rows)
    return out


# ---- descriptions, names, citations --------------------------------------------------------------

GENUS = "upper(left(name, 1)) || split_part(substring(name, 2), ' ', 1)"
DESCRIPTION = f"""CASE size % 4 WHEN 0 THEN 'Oil of ' || {GENUS} || ' ' || split_part(name, ' ', 2) || ' (syn. Foo bar) L., Rosaceae' WHEN 1 THEN {GENUS} || ' ' || split_part(name, ' ', 2) || ' and Othera minor of Poaceae, Extract nono, Lamiaceae, see Laterus alba'
 WHEN 2 THEN 'Grown from ' || {GENUS} || ' ' || split_part(name, ' ', 2) || ' syn. Rosa alba' ELSE 'Root of ' || {GENUS} || ' ' || split_part(name, ' ', 2) || ', Palmae or Umbelliferae' END"""
FAMILIES = "(?:[A-Z][a-z]+aceae|Leguminosae|Labiatae|Compositae|Umbelliferae|Gramineae|Guttiferae|Palmae|Cruciferae)"


def _described(spark, sf):
    i, n = ingredient(spark, sf), F.col("size") % 4
    words = F.split("name", " ")
    g, e = F.initcap(words[0]), words[1]
    text = (
        F.when(n == 0, F.concat(F.lit("Oil of "), g, F.lit(" "), e, F.lit(" (syn. Foo bar) L., Rosaceae")))
        .when(n == 1, F.concat(g, F.lit(" "), e, F.lit(" and Othera minor of Poaceae, Extract nono, Lamiaceae, see Laterus alba")))
        .when(n == 2, F.concat(F.lit("Grown from "), g, F.lit(" "), e, F.lit(" syn. Rosa alba")))
        .otherwise(F.concat(F.lit("Root of "), g, F.lit(" "), e, F.lit(", Palmae or Umbelliferae")))
    )
    return i.select("ref_no", "size", g.alias("genus"), text.alias("descr"))


CANDIDATES = rf"""d AS (SELECT ref_no, size, {GENUS} AS genus, {DESCRIPTION} AS descr FROM ing ),
 f AS (SELECT *, regexp_extract_all(descr, '{FAMILIES}')[-1] AS fam, regexp_replace(regexp_replace(descr, '\(syn\.[^)]*\)', ' ', 'g'), '\bsyn\.[^,;]*$', ' ') AS clean FROM d),
 h AS (SELECT *, CASE WHEN fam IS NULL THEN clean ELSE regexp_extract(clean, '(?s)^(.*){FAMILIES}', 1) END AS head FROM f),
 c AS (SELECT *, list_filter(list_transform(regexp_extract_all(head, '[A-Z][a-z]+\s+[a-z][a-z-]+'), lambda x: regexp_replace(x, '\s+', ' ')), lambda x: NOT list_contains(['Oil', 'Extract', 'Grown', 'Root'], split_part(x, ' ', 1))) AS cands FROM h)"""
NOISE = ("Oil", "Extract", "Grown", "Root")


@query("txt_description_candidates", f"WITH {CANDIDATES} SELECT ref_no, fam AS family, array_to_string(cands, '|') AS candidates FROM c")
def description_candidates(spark, sf):
    d = _described(spark, sf).select("ref_no", T.description_candidates(F.col("descr"), noise=NOISE).alias("d"))
    return d.select("ref_no", "d.family", F.array_join(F.transform("d.candidates", lambda x: F.concat_ws(" ", x["genus"], x["epithet"])), "|").alias("candidates"))


@query(
    "txt_pick_candidate",
    f"""WITH {CANDIDATES}, g AS (SELECT ref_no, cands, CASE size % 3 WHEN 0 THEN genus WHEN 1 THEN genus || 'x' ELSE 'Zzzzzzzz' END AS want FROM c)
SELECT ref_no, coalesce(list_filter(cands, lambda x: split_part(x, ' ', 1) = want)[-1], list_filter(cands, lambda x: levenshtein(split_part(x, ' ', 1), want) <= 2)[-1], cands[-1]) AS picked FROM g""",
)
def pick_candidate(spark, sf):
    n = F.col("size") % 3
    want = F.when(n == 0, F.col("genus")).when(n == 1, F.concat("genus", F.lit("x"))).otherwise("Zzzzzzzz")
    p = T.pick_candidate(T.description_candidates(F.col("descr"), noise=NOISE)["candidates"], want)
    return _described(spark, sf).select("ref_no", p.alias("p")).select("ref_no", F.when(F.col("p").isNotNull(), F.concat_ws(" ", "p.genus", "p.epithet")).alias("picked"))


@query(
    "rec_display_names",
    r"""WITH p AS (SELECT ref_no, CASE WHEN size % 2 = 0 THEN [name, upper(family), size || ',2-di' || name, ord, 'the ' || name] ELSE [size || '-' || name, '3,4-' || family, repeat(name, 6)] END AS pool, upper(name) AS iupac FROM ing ),
 s AS (SELECT ref_no, list_filter(pool, lambda x: length(x) <= 40) AS ok, iupac FROM p),
 n AS (SELECT ref_no, ok, list_filter(list_filter(ok, lambda x: lower(x) <> lower(iupac)), lambda x: NOT (regexp_matches(x, '\d,\d') OR regexp_matches(x, '\d-[a-z]') OR length(x) > 48)) AS en, list_filter(ok, lambda x: NOT (regexp_matches(x, '\d,\d') OR regexp_matches(x, '\d-[a-z]') OR length(x) > 48)) AS plain FROM s)
SELECT ref_no, array_to_string(en[1:3], '|') AS en, array_to_string((CASE WHEN len(plain) > 0 THEN plain ELSE ok END)[1:4], '|') AS zh, array_to_string((CASE WHEN len(plain) > 0 THEN plain ELSE ok END)[1:5], '|') AS ja FROM n""",
)
def display_names(spark, sf):
    """Names by language: at most 3, 4 and 5, systematic ones only as a fallback, and never in the first."""
    s = F.col("size").cast("string")
    pool = F.when(F.col("size") % 2 == 0, F.array(F.col("name"), F.upper("family"), F.concat(s, F.lit(",2-di"), "name"), F.col("ord"), F.concat(F.lit("the "), "name"))).otherwise(F.array(F.concat_ws("-", s, "name"), F.concat(F.lit("3,4-"), "family"), F.repeat("name", F.lit(6))))
    i = ingredient(spark, sf).select("ref_no", pool.alias("pool"), F.upper("name").alias("iupac"))
    show = lambda *a, **k: F.array_join(T.display_names(F.col("pool"), *a, **k), "|")
    return i.select("ref_no", show(3, F.col("iupac")).alias("en"), show(4, fallback=True).alias("zh"), show(5, fallback=True).alias("ja"))


@query("txt_uncited", r"SELECT ref_no, raw FROM (SELECT ref_no, CASE size % 3 WHEN 0 THEN 'see annex III/' || size WHEN 1 THEN 'Suspected, no entry' ELSE 'Annex ' || size || '; pending' END AS raw FROM ing ) WHERE NOT regexp_matches(raw, '(?i)(?:annex\s+)?\b(VIII|VII|III|VI|IV|II|V|I)\s*/\s*(\d+[a-z]?)')")
def uncited(spark, sf):
    """The side table of rows whose text has no citation."""
    s = F.col("size").cast("string")
    raw = F.when(F.col("size") % 3 == 0, F.concat(F.lit("see annex III/"), s)).when(F.col("size") % 3 == 1, "Suspected, no entry").otherwise(F.concat(F.lit("Annex "), s, F.lit("; pending")))
    return ingredient(spark, sf).select("ref_no", raw.alias("raw")).where(F.size(T.citations(F.col("raw"))) == 0)


@query("srt_species_rank", "SELECT s.species, count(DISTINCT e.compound) AS items, CAST(coalesce(sum(e.n_refs), 0) AS BIGINT) AS refs, s.family FROM species s LEFT JOIN edge e ON e.species = s.species GROUP BY s.species, s.family ORDER BY items DESC, refs DESC, s.species LIMIT 50")
def species_rank(spark, sf):
    """Species by items, then references, then name."""
    g = species(spark, sf).join(edges(spark, sf, "species"), "species", "left").groupBy("species", "family").agg(F.countDistinct("compound").alias("items"), F.coalesce(F.sum("n_refs"), F.lit(0)).alias("refs"))
    return g.orderBy(F.desc("items"), F.desc("refs"), "species").limit(50)
