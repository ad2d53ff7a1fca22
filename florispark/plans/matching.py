"""Vocabularies over texts, sketches of columns, and checks in the pass that writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from florispark.operators import dictionary
from florispark.operators import relational as R
from florispark.session import cut, shared_folder
from florispark.sources.readers import table
from florispark.sources.versions import CheckFailed, VersionedTable

from .domain import ingredient, query

WORD = r"[\p{L}\p{N}_]+"


@query(
    "txt_dictionary",
    f"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS w FROM documents), r AS (SELECT w, row_number() OVER (ORDER BY count(*) DESC, w) AS r FROM w WHERE length(w) >= 4 GROUP BY w),
 p AS (SELECT DISTINCT left(w, 4) AS p FROM r WHERE r BETWEEN 81 AND 100), m AS (SELECT doc_id, count(*) FILTER (r <= 40) AS parts, count(*) FILTER (r BETWEEN 41 AND 80) AS processes, count(*) FILTER (left(w, 4) IN (SELECT p FROM p)) AS prefixes FROM w LEFT JOIN r USING (w) GROUP BY doc_id)
SELECT doc_id, coalesce(parts, 0) AS parts, coalesce(processes, 0) AS processes, coalesce(prefixes, 0) AS prefixes FROM documents LEFT JOIN m USING (doc_id)""",
)
def dictionary_matches(spark, sf):
    """Words of two kinds and beginnings of words, from the documents' own frequent words, found in all documents in one pass."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)).alias("w")).where(F.length("w") >= 4)
    top = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(100)
    r = R.ordered(top, [F.desc("n"), F.asc("w")]).drop("_running").withColumnRenamed("_rank", "r")
    kind = F.when(F.col("r") <= 40, "part").when(F.col("r") <= 80, "process").otherwise("prefix")
    vocabulary = r.select(F.when(F.col("r") <= 80, F.col("w")).otherwise(F.left("w", F.lit(4))).alias("entry"), kind.alias("kind"), F.lit("x").alias("value"), (F.col("r") <= 80).alias("whole")).distinct()
    got = dictionary.matches(docs, "text", cut(vocabulary), longest=False)
    of = lambda k: F.size(F.filter("matches", lambda m: m["kind"] == k)).cast("long")
    return got.select("doc_id", of("part").alias("parts"), of("process").alias("processes"), of("prefix").alias("prefixes"))


COLUMNS = {"lineitem": ("l_orderkey", "l_partkey", "l_returnflag"), "customer": ("c_custkey", "c_name", "c_mktsegment")}


@query(
    "prof_sketches",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS blank, CAST(max(length(CAST({c} AS VARCHAR))) AS BIGINT) AS longest, count(DISTINCT {c}) AS distinct_values, true AS within_bound FROM {t}" for t, cs in COLUMNS.items() for c in cs),
)
def sketched(spark, sf):
    """Profiles merged from sketches of parts of tables, beside the exact numbers of values, which they are to be within 4 % of."""
    out = None
    for t, cs in COLUMNS.items():
        df = table(spark, sf, t)
        parts = cut(R.sketches(df, cs, [F.pmod(F.xxhash64(cs[0]), F.lit(16)).alias("part")]))
        exact = R.profile(df, cs).select("column", F.col("distinct_values").alias("exact"))
        one = R.merged(parts).join(exact, "column").select("column", "rows", "blank", "longest", F.col("exact").alias("distinct_values"), (F.abs(F.col("distinct_values") - F.col("exact")) <= 0.04 * F.col("exact") + 0.5).alias("within_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@query("chk_on_write", "SELECT 'rows' AS label, true AS ok, count(*) AS observed FROM ing UNION ALL SELECT 'keys without value', true, count(*) FILTER (name IS NULL) FROM ing UNION ALL SELECT 'largest', true, max(size) FROM ing UNION ALL SELECT 'kept after a failure', true, count(*) FROM ing ")
def on_write(spark, sf):
    """A stage's checks from the job that writes it; one that fails leaves the rows that were there."""
    i = ingredient(spark, sf).select("ref_no", "name", "size")
    t = VersionedTable(spark, shared_folder(spark, "checked"))
    checks = {"rows": (F.count("*"), lambda n: n > 0), "keys without value": (F.count_if(F.col("name").isNull()), lambda n: n == 0), "largest": (F.max("size"), lambda n: n <= 50)}
    got = t.replace_checked(i, checks, ["ref_no"])
    try:
        t.replace_checked(i.withColumn("name", F.lit(None).cast("string")), checks)
        raise AssertionError("a check should have failed")
    except CheckFailed:
        rows = [(label, ok, int(n)) for label, (ok, n) in got.items()]
    return spark.createDataFrame(rows, "label string, ok boolean, observed long").union(t.read().agg(F.count("*").alias("n")).select(F.lit("kept after a failure"), F.lit(True), "n"))
