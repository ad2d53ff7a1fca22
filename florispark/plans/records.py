"""Record transforms over text columns; patterns are put in by concatenation of key columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from florispark.functions import text as T
from florispark.operators import cleaning as C
from florispark.operators import relational as R
from florispark.sources.readers import table

from .domain import ingredient, query

RAW = "(10000 + ref_no % 90000) || '-' || (10 + ref_no % 90) || '-' || (ref_no % 10)"


def _raw(df):
    n = F.col("ref_no")
    s = lambda x: x.cast("string")
    return F.concat(s(10000 + n % 90000), F.lit("-"), s(10 + n % 90), F.lit("-"), s(n % 10))


CAS_TEXT = f"CASE ref_no % 5 WHEN 0 THEN {RAW} WHEN 1 THEN {RAW} || ' (Generic); 56-81-5' WHEN 2 THEN '999999-99-4 / ' || {RAW} WHEN 3 THEN 'n/a' ELSE {RAW} || ', ' || {RAW} END"


@query(
    "txt_cas_split",
    rf"""WITH r AS (SELECT ref_no, {CAS_TEXT} AS raw FROM ing ), x AS (SELECT ref_no, regexp_replace(raw, '(?i)\(\s*generic\s*\)', ' ', 'g') AS t, regexp_matches(raw, '(?i)\(\s*generic\s*\)') AS g FROM r),
 f AS (SELECT *, list_filter(regexp_extract_all(t, '\d{{2,7}}-\d{{2}}-\d'), lambda v: v <> '999999-99-4') AS a FROM x)
SELECT ref_no, array_to_string(list_filter(a, lambda v, i: list_position(a, v) = i), '|') AS numbers, a[1] AS primary_no, g AS is_generic, nullif(trim(regexp_replace(regexp_replace(t, '\d{{2,7}}-\d{{2}}-\d', '', 'g'), '[;,/\s]+', ' ', 'g')), '') AS leftover FROM f""",
)
def cas(spark, sf):
    i = ingredient(spark, sf)
    raw, k = _raw(i), F.col("ref_no") % 5
    text = F.when(k == 0, raw).when(k == 1, F.concat(raw, F.lit(" (Generic); 56-81-5"))).when(k == 2, F.concat(F.lit("999999-99-4 / "), raw)).when(k == 3, "n/a").otherwise(F.concat(raw, F.lit(", "), raw))
    c = i.select("ref_no", T.split_cas(text).alias("c"))
    return c.select("ref_no", F.array_join("c.numbers", "|").alias("numbers"), F.col("c.primary").alias("primary_no"), "c.is_generic", "c.leftover")


@query(
    "txt_citations",
    r"""WITH r AS (SELECT ref_no, CASE ref_no % 4 WHEN 0 THEN 'see annex III/' || size || ' and V/' || (size + 1) || 'a' WHEN 1 THEN 'CMR1B II/' || size WHEN 2 THEN 'Suspected, no entry' ELSE 'viii / ' || size || '; Carc. 2' END AS raw FROM ing )
SELECT ref_no, array_to_string(list_transform(list_zip(regexp_extract_all(raw, '(?i)(?:annex\s+)?\b(VIII|VII|III|VI|IV|II|V|I)\s*/\s*(\d+[a-z]?)', 1), regexp_extract_all(raw, '(?i)(?:annex\s+)?\b(VIII|VII|III|VI|IV|II|V|I)\s*/\s*(\d+[a-z]?)', 2)), lambda v: upper(v[1]) || '/' || v[2]), ' ') AS cited,
 nullif(upper(regexp_extract(raw, '(?i)\bCMR\s*(1A|1B|2)\b', 1) || regexp_extract(raw, '(?i)\b(?:Carc|Muta|Repr)\.?\s*(1A|1B|2)\b', 1)), '') AS cmr FROM r""",
)
def citations(spark, sf):
    n, s = F.col("ref_no") % 4, F.col("size")
    st = lambda x: x.cast("string")
    raw = F.when(n == 0, F.concat(F.lit("see annex III/"), st(s), F.lit(" and V/"), st(s + 1), F.lit("a"))).when(n == 1, F.concat(F.lit("CMR1B II/"), st(s))).when(n == 2, "Suspected, no entry").otherwise(F.concat(F.lit("viii / "), st(s), F.lit("; Carc. 2")))
    return ingredient(spark, sf).select("ref_no", F.array_join(F.transform(T.citations(raw), lambda x: F.concat_ws("/", x["annex"], x["ref"])), " ").alias("cited"), T.cmr_class(raw).alias("cmr"))


@query(
    "txt_norm_name",
    r"SELECT ref_no, trim(lower(regexp_replace(replace(replace(' ' || org || ' ', ' × ', ' '), ' var. ', ' '), '\s+', ' ', 'g'))) AS norm FROM (SELECT ref_no, name || CASE WHEN ref_no % 2 = 0 THEN ' × Alba' ELSE ' var.  Rosea' END AS org FROM ing )",
)
def norm(spark, sf):
    org = F.concat("name", F.when(F.col("ref_no") % 2 == 0, " × Alba").otherwise(" var.  Rosea"))
    return ingredient(spark, sf).select("ref_no", T.norm_name(org).alias("norm"))


@query("txt_tokens", "SELECT ref_no, array_to_string(CASE WHEN w[1] IN ('RED', 'BLUE') THEN w[2:] ELSE w END, '|') AS tokens FROM (SELECT ref_no, regexp_split_to_array(replace(upper(name || '/' || family || ', ' || ord), '.', ''), '[\\s/,]+') AS w FROM ing )")
def toks(spark, sf):
    return ingredient(spark, sf).select("ref_no", F.array_join(T.tokens(F.concat("name", F.lit("/"), "family", F.lit(", "), "ord"), ["RED", "BLUE"]), "|").alias("tokens"))


@query("txt_binomial", "SELECT ref_no, upper(w[1][1]) || lower(w[1][2:]) AS genus, lower(w[2]) AS epithet FROM (SELECT ref_no, string_split(upper(name), ' ') AS w FROM ing ) WHERE w[1] NOT IN ('RED') AND w[2] NOT IN ('RING')")
def binom(spark, sf):
    b = ingredient(spark, sf).select("ref_no", T.binomial(T.tokens(F.col("name")), ["RED"], ["RING"]).alias("b")).where("b is not null")
    return b.select("ref_no", "b.genus", "b.epithet")


@query(
    "txt_markup_minify",
    r"""SELECT page_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<\?[^>]*\?>', '', 'g'), '(?s)<!--.*?-->', '', 'g'),
 '\s(class|id)=("[^"]*"|''[^'']*'')', '', 'g'), '[ \t\r\n]+', ' ', 'g'), '> <', '><', 'g'), ' ')) AS digest FROM pages""",
)
def minify(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.sha2(T.minify_markup(F.col("html")), 256).alias("digest"))


@query("txt_id_list", "SELECT ref_no, id FROM (SELECT ref_no, trim(unnest(string_split(ref_no || ' | x' || size || '|' || (ref_no + 1) || '|', '|'))) AS id FROM ing ) WHERE regexp_full_match(id, '\\d+')")
def ids(spark, sf):
    st = lambda x: x.cast("string")
    raw = F.concat(st(F.col("ref_no")), F.lit(" | x"), st(F.col("size")), F.lit("|"), st(F.col("ref_no") + 1), F.lit("|"))
    return ingredient(spark, sf).select("ref_no", F.explode(T.id_list(raw)).alias("id"))


@query(
    "txt_levenshtein_class",
    "SELECT a, b, CASE WHEN a = b THEN 'equal' WHEN levenshtein(a, b) = 1 THEN 'spelling_variant' WHEN levenshtein(a, b) <= 2 THEN 'near' ELSE 'other' END AS kind FROM (SELECT DISTINCT name AS a FROM ing ) x, (SELECT DISTINCT replace(name, 'i', 'ii') AS b FROM ing ) y WHERE split_part(a, ' ', 1) = replace(split_part(b, ' ', 1), 'ii', 'i')",
)
def lev(spark, sf):
    i = ingredient(spark, sf)
    first = lambda c: F.split_part(c, F.lit(" "), F.lit(1))
    a = i.select(F.col("name").alias("a")).distinct().withColumn("k", first(F.col("a")))
    b = i.select(F.replace("name", F.lit("i"), F.lit("ii")).alias("b")).distinct().withColumn("k", F.replace(first(F.col("b")), F.lit("ii"), F.lit("i")))
    d = F.levenshtein("a", "b")
    return a.join(b, "k").select("a", "b", F.when(F.col("a") == F.col("b"), "equal").when(d == 1, "spelling_variant").when(d <= 2, "near").otherwise("other").alias("kind"))


@query("txt_date_parse", "SELECT ref_no, CAST(try_strptime(nullif(trim(d), ''), '%d/%m/%Y') AS DATE) AS day FROM (SELECT ref_no, CASE WHEN ref_no % 6 = 0 THEN ' ' ELSE lpad(CAST(1 + ref_no % 28 AS VARCHAR), 2, '0') || '/' || lpad(CAST(1 + ref_no % 12 AS VARCHAR), 2, '0') || '/' || (2000 + size) END AS d FROM ing )")
def dates(spark, sf):
    n = F.col("ref_no")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    d = F.when(n % 6 == 0, " ").otherwise(F.concat_ws("/", two(1 + n % 28), two(1 + n % 12), (2000 + F.col("size")).cast("string")))
    return ingredient(spark, sf).select("ref_no", T.to_date_dmy(d).alias("day"))


@query("txt_list_split", "SELECT ref_no, array_to_string(list_filter(list_transform(string_split(l, ','), lambda x: trim(x)), lambda x: x <> ''), ' | ') AS functions FROM (SELECT ref_no, replace(name, ' ', ' ,, ') || ', ' || ord AS l FROM ing )")
def lists(spark, sf):
    raw = F.concat(F.replace("name", F.lit(" "), F.lit(" ,, ")), F.lit(", "), "ord")
    return ingredient(spark, sf).select("ref_no", T.join_list(T.split_list(raw)).alias("functions"))


@query("txt_regulation_parts", "SELECT ref_no, CASE WHEN regexp_matches(r, '^[IVX]+/') THEN regexp_extract(r, '^([IVX]+)/', 1) ELSE 'other' END AS prefix, CASE WHEN r LIKE '%/%' AND length(r) < 20 THEN coalesce(CASE split_part(r, '/', 1) WHEN 'II' THEN 'II (Prohibited)' WHEN 'III' THEN 'III (Restricted)' WHEN 'IV' THEN 'IV (Colorants)' WHEN 'V' THEN 'V (Preservatives)' WHEN 'VI' THEN 'VI (UV filters)' END, split_part(r, '/', 1)) END AS annex, CASE WHEN r LIKE '%/%' AND length(r) < 20 THEN split_part(r, '/', 2) END AS entry FROM (SELECT ref_no, CASE WHEN size % 7 = 0 THEN restriction ELSE 'note ' || size END AS r FROM ing )")
def reg_parts(spark, sf):
    i = ingredient(spark, sf).select("ref_no", F.coalesce("restriction", F.concat(F.lit("note "), F.col("size").cast("string"))).alias("r"))
    p = i.withColumn("p", T.regulation_parts(F.col("r")))
    return p.select("ref_no", T.restriction_prefix(F.col("r")).alias("prefix"), "p.annex", "p.entry")


@query("txt_safe_names", "SELECT ref_no, translate(name || '/' || family || ':x', '/:?', '-- ') AS file, regexp_replace(lower(left(family, 2)), '[^a-z0-9]', '_', 'g') AS chunk FROM ing ")
def safe(spark, sf):
    return ingredient(spark, sf).select("ref_no", T.safe_file_name(F.concat("name", F.lit("/"), "family", F.lit(":x"))).alias("file"), T.chunk_key(F.col("family")).alias("chunk"))


# ---- cleaning stages ----------------------------------------------------------------------------


@query(
    "clean_correction_chain",
    """WITH x AS (SELECT ref_no, family, CASE family WHEN 'Brand#1' THEN 'Brand#2' WHEN 'Brand#3' THEN 'Brand#4' END AS typo FROM ing ), y AS (SELECT *, coalesce(typo, family) AS f1 FROM x), z AS (SELECT *, CASE f1 WHEN 'Brand#2' THEN 'Renamed' WHEN 'Brand#5' THEN 'Split' END AS ren FROM y), w AS (SELECT *, coalesce(ren, f1) AS g FROM z)
SELECT ref_no, CASE WHEN g <> 'Split' THEN g END AS family_accepted, g = 'Split' AS family_needs_gbif, nullif(concat_ws('; ', 'typo: ' || family || '->' || typo, 'rename: ' || f1 || '->' || ren, CASE WHEN g = 'Split' THEN 'split: Split' END), '') AS family_correction FROM w""",
)
def chain(spark, sf):
    t = spark.createDataFrame([("Brand#1", "Brand#2"), ("Brand#3", "Brand#4")], "raw string, to string")
    r = spark.createDataFrame([("Brand#2", "Renamed"), ("Brand#5", "Split")], "raw string, to string")
    return C.correct_family(ingredient(spark, sf), t, r, ["Split"], "family").select("ref_no", "family_accepted", "family_needs_gbif", "family_correction")


@query("clean_scoped_typos", "WITH a AS (SELECT ref_no, ord, CASE WHEN split_part(name, ' ', 1) = 'red' THEN 'crimson' ELSE split_part(name, ' ', 1) END AS v, CASE WHEN split_part(name, ' ', 1) = 'red' THEN 'red->crimson' ELSE '' END AS l FROM ing ) SELECT ref_no, CASE WHEN v = 'crimson' AND ord = 'PROMO' THEN 'scarlet' ELSE v END AS word, CASE WHEN v = 'crimson' AND ord = 'PROMO' THEN l || '; crimson->scarlet' ELSE l END AS log FROM a")
def scoped(spark, sf):
    word, log = T.apply_rules(F.split_part("name", F.lit(" "), F.lit(1)), [("red", "crimson", None), ("crimson", "scarlet", "PROMO")], F.col("ord"))
    return ingredient(spark, sf).select("ref_no", word.alias("word"), log.alias("log"))


RECON = "SELECT ref_no, split_part(name, ' ', 1) AS ig, split_part(name, ' ', 2) AS ie, CASE WHEN size % 9 = 0 THEN 'other' ELSE split_part(name, ' ', 1) END AS dg, CASE size % 5 WHEN 0 THEN NULL WHEN 1 THEN split_part(name, ' ', 2) || 's' WHEN 2 THEN 'x' WHEN 3 THEN split_part(name, ' ', 2) ELSE 'zzzzz' END AS de FROM ing "


@query(
    "clean_reconcile",
    f"""WITH r AS ({RECON}), k AS (SELECT *, CASE WHEN ig = dg AND ie = de THEN 'agree' WHEN de IS NULL THEN 'desc_unparsed' WHEN de = 'x' THEN 'hybrid' WHEN ig = dg AND starts_with(de, ie) THEN 'inci_truncated'
 WHEN levenshtein(ig || ' ' || ie, dg || ' ' || de) = 1 THEN 'spelling_variant' WHEN ig = dg THEN 'species_mismatch' ELSE 'genus_mismatch' END AS kind FROM r)
SELECT ref_no, kind, CASE WHEN kind IN ('agree', 'hybrid', 'inci_truncated', 'spelling_variant') THEN dg || ' ' || de WHEN kind = 'desc_unparsed' THEN ig || ' ' || ie END AS species,
 CASE WHEN kind = 'agree' THEN 'both' WHEN kind = 'desc_unparsed' THEN 'inci' WHEN kind IN ('hybrid', 'inci_truncated', 'spelling_variant') THEN 'description' ELSE 'unresolved' END AS taxon_source FROM k""",
)
def recon(spark, sf):
    w = lambda n: F.split_part("name", F.lit(" "), F.lit(n))
    five = F.col("size") % 5
    r = ingredient(spark, sf).select("ref_no", w(1).alias("ig"), w(2).alias("ie"), F.when(F.col("size") % 9 == 0, "other").otherwise(w(1)).alias("dg"), F.when(five == 0, None).when(five == 1, F.concat(w(2), F.lit("s"))).when(five == 2, "x").when(five == 3, w(2)).otherwise("zzzzz").alias("de"))
    return C.reconcile(r, T.disagreement(*map(F.col, ("ig", "ie", "dg", "de"))), F.concat_ws(" ", "ig", "ie"), F.concat_ws(" ", "dg", "de")).select("ref_no", "kind", "species", "taxon_source")


@query(
    "clean_adjudicate",
    """WITH c AS (SELECT ref_no, CASE WHEN size % 4 = 0 THEN NULL ELSE ord END AS a, CASE WHEN size % 4 = 0 THEN 0 ELSE 80 + size % 20 END AS ca, CASE WHEN size % 3 = 0 THEN NULL WHEN size % 3 = 1 THEN ord ELSE 'SMALL' END AS b, CASE WHEN size % 3 = 0 THEN 0 ELSE 95 END AS cb FROM ing ),
 r AS (SELECT *, CASE WHEN a IS NULL AND b IS NULL THEN 'no_match' WHEN (ca > 0 AND ca < 90) OR (cb > 0 AND cb < 90) THEN 'weak_match' WHEN a IS NULL OR b IS NULL THEN 'one_side' WHEN a = b THEN 'same_name' ELSE 'two_species' END AS reason FROM c)
SELECT ref_no, reason, CASE WHEN reason IN ('one_side', 'same_name') THEN coalesce(a, b) END AS resolved_to FROM r""",
)
def adj(spark, sf):
    s = F.col("size")
    c = ingredient(spark, sf).select("ref_no", F.when(s % 4 != 0, F.col("ord")).alias("a"), F.when(s % 4 == 0, 0).otherwise(80 + s % 20).alias("ca"), F.when(s % 3 == 1, F.col("ord")).when(s % 3 == 2, "SMALL").alias("b"), F.when(s % 3 == 0, 0).otherwise(95).alias("cb"))
    return C.adjudicate(c, "a", "ca", "b", "cb").select("ref_no", "reason", "resolved_to")


@query("clean_match_guards", "SELECT ref_no, CASE WHEN size % 6 = 0 THEN 'no_species_match' WHEN size % 6 = 1 THEN 'rank' WHEN size % 6 = 2 THEN 'kingdom' END AS reason FROM ing ")
def guards(spark, sf):
    k = F.col("size") % 6
    reason = C.match_guard(F.when(k == 0, "HIGHERRANK").otherwise("EXACT"), F.when(k == 1, "GENUS").otherwise("SPECIES"), F.when(k == 2, "Viruses").otherwise("Plantae"))
    return ingredient(spark, sf).select("ref_no", reason.alias("reason"))


@query(
    "clean_taxonomy_attach",
    """WITH s AS (SELECT name, min(ord) AS family FROM ing WHERE size <= 8 GROUP BY name HAVING count(*) > 4), g AS (SELECT split_part(name, ' ', 1) AS name, max(ord) AS family FROM ing WHERE size > 45 GROUP BY 1)
SELECT i.ref_no, coalesce(s.family, g.family, i.family) AS family_final, CASE WHEN s.family IS NOT NULL THEN 'species' WHEN g.family IS NOT NULL THEN 'genus_fallback' WHEN i.family IS NOT NULL THEN 'offline' END AS family_source, s.family IS NOT NULL AS ok FROM ing i LEFT JOIN s ON s.name = i.name LEFT JOIN g ON g.name = split_part(i.name, ' ', 1)""",
)
def attach(spark, sf):
    i = ingredient(spark, sf).withColumn("genus", F.split_part("name", F.lit(" "), F.lit(1)))
    s = i.where("size <= 8").groupBy("name").agg(F.min("ord").alias("family"), F.count("*").alias("n")).where("n > 4")
    g = i.where("size > 45").groupBy(F.col("genus").alias("name")).agg(F.max("ord").alias("family"))
    return C.attach_taxonomy(i, s, g, "name", "genus").select("ref_no", "family_final", "family_source", "ok")


@query(
    "clean_parts",
    """WITH w AS (SELECT ref_no, string_split(upper(name || CASE WHEN size % 4 = 0 THEN ' SEED OIL' WHEN size % 4 = 1 THEN ' SEEDCAKE' ELSE ' WATER EXTRACT' END), ' ') AS w, size FROM ing )
SELECT ref_no, CASE WHEN size % 4 IN (0, 1) THEN 'seed' WHEN size % 4 = 2 THEN 'leaf' END AS plant_part, CASE size % 4 WHEN 0 THEN 'inci' WHEN 1 THEN 'process_implied' WHEN 2 THEN 'description' END AS part_source,
 CASE size % 4 WHEN 0 THEN 'oil' WHEN 1 THEN 'seedcake' ELSE 'water' END AS process, CASE size % 4 WHEN 0 THEN 'oil' WHEN 1 THEN 'seedcake' ELSE 'water,extract' END AS process_all FROM w""",
)
def parts(spark, sf):
    k = F.col("size") % 4
    i = ingredient(spark, sf)
    words = T.tokens(F.concat("name", F.when(k == 0, " SEED OIL").when(k == 1, " SEEDCAKE").otherwise(" WATER EXTRACT")))
    text = F.when(k == 2, "an extract of the dried young leafs of it").otherwise("an extract")
    got = C.parts_and_processes(i, words, text, {"SEED": "seed", "LEAF": "leaf", "WHOLE": "whole_plant"}, {"OIL": "oil", "SEEDCAKE": "seedcake", "WATER": "water", "EXTRACT": "extract"}, {"SEEDCAKE": "seed"}, ["HYDROLYZED"])
    return got.select("ref_no", F.array_join("plant_part", ",").alias("plant_part"), "part_source", "process", F.array_join("process_all", ",").alias("process_all"))


@query("rec_collapse_candidates", "SELECT source, lang, doc_id AS best, n_chars AS richness, others FROM (SELECT *, count(*) OVER (PARTITION BY source, lang) - 1 AS others FROM documents) QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) = 1")
def collapse(spark, sf):
    """Of the records of a key, the richest; the others are counted."""
    d = table(spark, sf, "documents").groupBy("source", "lang").agg(F.max(F.struct("n_chars", (-F.col("doc_id")).alias("m"))).alias("b"), (F.count("*") - 1).alias("others"))
    return d.select("source", "lang", (-F.col("b.m")).alias("best"), F.col("b.n_chars").alias("richness"), "others")


@query("rec_pick_name", "SELECT ref_no, array_to_string(list_filter(pool, lambda x, i: NOT starts_with(lower(x), split_part(lower(name), ' ', 1)) AND list_position(list_transform(pool, lambda y: lower(y)), lower(x)) = i)[1:2], '|') AS names FROM (SELECT ref_no, name, [family, upper(family), ord, lower(ord), name || ' x', 'Zz' || size] AS pool FROM ing )")
def pick(spark, sf):
    pool = F.array("family", F.upper("family"), "ord", F.lower("ord"), F.concat("name", F.lit(" x")), F.concat(F.lit("Zz"), F.col("size").cast("string")))
    return ingredient(spark, sf).select("ref_no", F.array_join(T.preferred_names(pool, F.col("name"), 2), "|").alias("names"))


@query("rec_systematic", "SELECT ref_no, regexp_matches(n, '\\d,\\d') OR regexp_matches(n, '\\d-[a-z]') OR length(n) > 48 AS systematic FROM (SELECT ref_no, CASE size % 3 WHEN 0 THEN size || ',2-di' || name WHEN 1 THEN name ELSE size || '-' || name END AS n FROM ing )")
def systematic(spark, sf):
    s = F.col("size")
    n = F.when(s % 3 == 0, F.concat(s.cast("string"), F.lit(",2-di"), "name")).when(s % 3 == 1, F.col("name")).otherwise(F.concat_ws("-", s.cast("string"), "name"))
    return ingredient(spark, sf).select("ref_no", T.is_systematic(n).alias("systematic"))


# ---- table maintenance --------------------------------------------------------------------------


@query("snk_update_from", "SELECT i.ref_no, i.name, CASE WHEN u.ref_no IS NOT NULL THEN u.family ELSE i.family END AS family, u.grade FROM ing i LEFT JOIN (SELECT ref_no, 'new ' || family AS family, size % 3 AS grade FROM ing WHERE size % 5 = 0) u ON u.ref_no = i.ref_no")
def update(spark, sf):
    i = ingredient(spark, sf)
    u = i.where("size % 5 = 0").select("ref_no", F.concat(F.lit("new "), "family").alias("family"), (F.col("size") % 3).alias("grade"))
    return R.update_from(i.select("ref_no", "name", "family"), u, "ref_no", ["family", "grade"])


@query("snk_delete_where", "SELECT ref_no, name FROM ing WHERE NOT (name NOT LIKE '% %' OR name IN (SELECT name FROM ing GROUP BY name HAVING count(*) > 40))")
def delete(spark, sf):
    i = ingredient(spark, sf)
    twice = i.groupBy("name").agg(F.count("*").alias("n")).where("n > 40").select("name")
    return i.where(F.contains("name", F.lit(" "))).join(twice, "name", "left_anti").select("ref_no", "name")


@query("snk_never_clobber", "SELECT o_orderkey AS k, CASE WHEN h.v IS NULL OR h.v IN ('auto', 'excluded') THEN 'made' ELSE h.v END AS v FROM orders LEFT JOIN (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'auto' WHEN 1 THEN 'excluded' ELSE 'human' END AS v FROM orders WHERE o_orderkey % 3 = 0) h ON h.k = o_orderkey")
def clobber(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    k = F.col("k") % 4
    human = o.where("k % 3 = 0").withColumn("v", F.when(k == 0, "auto").when(k == 1, "excluded").otherwise("human"))
    return R.never_clobber(o.withColumn("v", F.lit("made")), human, "k", "v", F.col("_was").isin("auto", "excluded"))


@query("snk_chunk_key", "SELECT chunk, count(*) AS n, min(name) AS first_name FROM (SELECT name, regexp_replace(lower(left(name, 2)), '[^a-z0-9]', '_', 'g') AS chunk FROM ing ) GROUP BY chunk")
def chunks(spark, sf):
    return ingredient(spark, sf).groupBy(T.chunk_key(F.col("name")).alias("chunk")).agg(F.count("*").alias("n"), F.min("name").alias("first_name"))


@query("snk_addon_delta", "SELECT ref_no FROM ing WHERE ref_no % 2 = 0 AND ref_no NOT IN (SELECT ref_no FROM ing WHERE size < 20) AND ref_no NOT IN (SELECT ref_no FROM ing WHERE is_bio)")
def delta(spark, sf):
    i = ingredient(spark, sf)
    return R.addon_delta(i.where("ref_no % 2 = 0").select("ref_no"), i.where("size < 20"), i.where("is_bio"), "ref_no")


@query("snk_json_documents", "SELECT ref_no, CASE WHEN restriction IS NULL THEN '{\"n\":\"' || name || '\",\"s\":' || size || '}' ELSE '{\"n\":\"' || name || '\",\"s\":' || size || ',\"re\":\"' || restriction || '\"}' END AS json FROM ing ")
def documents(spark, sf):
    from florispark.sources.sinks import json_documents

    return json_documents(ingredient(spark, sf).select("ref_no", F.col("name").alias("n"), F.col("size").alias("s"), F.col("restriction").alias("re")), "ref_no", ["n", "s", "re"])


@query(
    "chk_acceptance",
    """SELECT 'rows' AS label, count(*) > 0 AS ok, count(*) AS observed FROM ing UNION ALL SELECT 'unique keys', count(*) = count(DISTINCT ref_no), count(DISTINCT ref_no) FROM ing UNION ALL
SELECT 'broken links', count(*) = 0, count(*) FROM edge e WHERE e.compound NOT IN (SELECT ref_no FROM ing ) UNION ALL SELECT 'no loss', (SELECT count(*) FROM ing ) = count(*), count(*) FROM (SELECT ref_no FROM ing WHERE is_bio UNION ALL SELECT ref_no FROM ing WHERE NOT is_bio)""",
)
def acceptance(spark, sf):
    from .domain import edges

    i = ingredient(spark, sf)
    one = lambda d: d.agg(F.count("*").alias("observed"))
    o = F.col("observed")
    links = edges(spark, sf).join(i.select(F.col("ref_no").alias("compound")), "compound", "left_anti")
    return R.checks(
        [
            ("rows", one(i), o > 0),
            ("unique keys", i.agg(F.countDistinct("ref_no").alias("observed"), F.count("*").alias("n")), o == F.col("n")),
            ("broken links", one(links), o == 0),
            ("no loss", one(i.where("is_bio").unionAll(i.where("not is_bio"))).crossJoin(i.agg(F.count("*").alias("n"))), o == F.col("n")),
        ]
    )


@query(
    "rec_schema_normalise",
    "SELECT CAST(p_partkey AS VARCHAR) AS ref_no, nullif(trim(CASE WHEN p_size % 5 = 0 THEN '  ' ELSE p_name END), '') AS name, array_to_string(list_filter(list_transform(string_split(replace(p_name, ' ', ' | '), '|'), lambda x: trim(x)), lambda x: x <> ''), ',') AS functions, CASE WHEN p_size % 4 = 0 THEN DATE '2020-02-03' END AS updated FROM part",
)
def schema_normalise(spark, sf):
    from florispark.sources.readers import normalise_inventory

    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 5 == 0, "  ").otherwise(F.col("p_name")).alias("inci"), F.replace("p_name", F.lit(" "), F.lit(" | ")).alias("roles"), F.when(F.col("p_size") % 4 == 0, "03/02/2020").otherwise("").alias("day"))
    got = normalise_inventory(p, {"id": "ref_no", "inci": "name", "roles": "functions", "day": "updated"}, lists=["functions"], dates=["updated"])
    return got.withColumn("functions", F.array_join("functions", ","))


REGULATION = "reg AS (SELECT annex, entry, substance, row_number() OVER (PARTITION BY annex, entry ORDER BY substance) AS entry_seq FROM (SELECT DISTINCT split_part(restriction, '/', 1) AS annex, split_part(restriction, '/', 2) AS entry, name AS substance FROM ing WHERE restriction IS NOT NULL AND size < 40))"


@query(
    "view_extract_regulation",
    f"WITH {REGULATION} SELECT i.ref_no, i.name, split_part(i.restriction, '/', 1) AS annex, split_part(i.restriction, '/', 2) AS entry, reg.substance FROM ing i LEFT JOIN reg ON reg.annex = split_part(i.restriction, '/', 1) AND reg.entry = split_part(i.restriction, '/', 2) AND reg.entry_seq = 1 WHERE i.is_bio OR i.restriction IS NOT NULL",
)
def extract_regulation(spark, sf):
    """Plant-derived or restricted ingredients with their regulation's first entry: numbering within a key that isn't unique, then a join on it."""
    from pyspark.sql import Window

    part = lambda n: F.split_part("restriction", F.lit("/"), F.lit(n))
    i = ingredient(spark, sf).withColumn("annex", part(1)).withColumn("entry", part(2))
    reg = i.where("restriction is not null and size < 40").select("annex", "entry", F.col("name").alias("substance")).distinct()
    reg = reg.withColumn("entry_seq", F.row_number().over(Window.partitionBy("annex", "entry").orderBy("substance"))).where("entry_seq = 1").drop("entry_seq")
    return i.where("is_bio or restriction is not null").join(reg, ["annex", "entry"], "left").select("ref_no", "name", "annex", "entry", "substance")
