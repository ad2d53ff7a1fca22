"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Base counts are computed for every document.  The further rules are ordered on a sample of rows that
the base rules let through, chosen by hash in all parts of the table: each rule is timed there, many
times over and less what a job without a rule takes, and it is counted which rules reject which rows.
The first rule is that with the most rejections per second; the next is chosen by what it rejects of
the rows that are left, and so on.  The verdict is one CASE expression in that order, so a document
is tested no further than its first failing rule.  The order changes the work, never the verdict.

Repeated three-word windows are found without leaving the row: a window's hash and position are
packed in one integer, the integers are sorted, and windows whose neighbours have the same hash
are compared as text, which makes the count exact.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: what a word is, and the characters that count as symbols
SPACE = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
POSITION_BITS = 28

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(without(text, chars))).cast("long")


def rules() -> dict[str, Column]:
    """Each rule is true for documents that it rejects; integers only, so that every engine agrees."""
    c = F.col
    bullet = F.size(F.filter("_lines", lambda x: F.ltrim(x).rlike(r"^[-*•]")))
    ellipsis = F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[ \t\r]*\z")))
    return {
        "words_too_short": c("word_chars") * 10 < c("n_words") * 25,
        "words_too_long": c("word_chars") > c("n_words") * 12,
        "symbols": c("n_symbols") * 10 > c("n_words"),
        "shouting": count_of(c("_text"), "!?") * 4 > c("n_words"),
        "digits": count_of(c("_text"), "0123456789") * 10 > c("word_chars") * 3,
        "duplicate_lines": (c("n_dup_lines") > 2) & (c("n_dup_lines") * 10 > F.size("_lines") * 3),
        "bullets": bullet * 10 > F.size("_lines") * 9,
        "ellipses": ellipsis * 10 > F.size("_lines") * 3,
    }


def base_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: the base counts, and the columns _text and _lines that rules use."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"))
    df = df.withColumn("_words", F.array_remove(F.split("_text", SPACE), "")).withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD_CHAR)))
    at = F.when(F.size("_words") >= 3, F.sequence(F.lit(0).cast("long"), (F.size("_words") - 3).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    word = lambda i, k: F.get("_words", (i + k).cast("int"))
    packed = F.transform(at, lambda i: F.shiftleft(F.xxhash64(word(i, 0), word(i, 1), word(i, 2)), POSITION_BITS).bitwiseOR(i))
    df = df.withColumn("_packed", F.sort_array(packed))
    same = lambda x, i: F.shiftrightunsigned(x, POSITION_BITS).eqNullSafe(F.shiftrightunsigned(F.get("_packed", i), POSITION_BITS))
    df = df.withColumn("_maybe", F.filter("_packed", lambda x, i: same(x, i + 1) | same(x, i - 1)))
    place = lambda x: x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")
    windows = F.transform("_maybe", lambda x: F.struct(F.concat_ws(" ", word(place(x), 0), word(place(x), 1), word(place(x), 2)).alias("w"), place(x).alias("p")))
    df = df.withColumn("_windows", F.array_sort(windows))
    twice = F.filter("_windows", lambda x, i: x["w"].eqNullSafe(F.get("_windows", i + 1)["w"]) | x["w"].eqNullSafe(F.get("_windows", i - 1)["w"]))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))))
    return df.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(without(F.col("_text"), " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        count_of(F.col("_text"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
        "_text",
        "_lines",
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def sample_of(docs: DataFrame, rows: int, id_col: str, text_col: str) -> DataFrame:
    """About `rows` rows from all parts of docs, by a hash of id and text."""
    total = docs.count()
    if total <= rows:
        return docs
    return docs.where(F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 40)) < (rows << 40) // total)


def greedy(counts: dict[int, int], costs: list[float]) -> list[int]:
    """Order of rules: the next one rejects the most, per cost, of what those before it leave.  counts: rows by the set (bits) of rules that reject them."""
    order: list[int] = []
    while len(order) < len(costs):
        left = {mask: n for mask, n in counts.items() if not any(mask >> i & 1 for i in order)}
        rest = [i for i in range(len(costs)) if i not in order]
        order.append(max(rest, key=lambda i: (sum(n for mask, n in left.items() if mask >> i & 1) / costs[i], -costs[i], -i)))
    return order


def rule_order(sample: DataFrame, tests: dict[str, Column], times: int = 5) -> list[str]:
    """Names of the rules, in the order in which they should be tried, by a sample of base_counts()."""
    held = sample.persist()
    sample = held.where(~base_failed())  # not before: a filter pushed below the counts would repeat their expressions
    try:
        mask = sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests.values())), F.lit(0))
        counts = {r["mask"]: r["n"] for r in sample.groupBy(mask.alias("mask")).agg(F.count("*").alias("n")).collect()}  # a row for each set of rules at most
        many = sample.withColumn("_time", F.explode(F.sequence(F.lit(1), F.lit(times))))

        def seconds(test: Column) -> float:
            best = float("inf")
            for _ in range(2):
                began = time.perf_counter()
                many.agg(F.sum(F.when(test, 1).otherwise(0))).collect()
                best = min(best, time.perf_counter() - began)
            return best

        empty = seconds(F.col("_time") < 0)
        costs = [max(seconds(test) - empty, 1e-4) for test in tests.values()]
        return [list(tests)[i] for i in greedy(counts, costs)]
    finally:
        held.unpersist()


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 2000, order: list[str] | None = None) -> DataFrame:
    """(doc_id, the base counts, base_failed, kept) of each row.

    The sample that orders the rules has about sample_rows rows; pass an order to do without.
    Null and empty texts have no words, so they fail the base rules and aren't kept.  Repeated
    rows and null ids are kept, one result row for each; other columns are ignored.
    """
    df, tests = base_counts(docs, id_col, text_col), rules()
    if order is None:
        order = rule_order(base_counts(sample_of(docs, sample_rows, id_col, text_col), id_col, text_col), tests)
    verdict = F.when(base_failed(), False)
    for name in order:
        verdict = verdict.when(tests[name], False)
    return df.select("doc_id", *BASE, base_failed().alias("base_failed"), verdict.otherwise(True).alias("kept"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS tri
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, tri) AS c FROM g) WHERE c >= 2)
  GROUP BY doc_id
), b AS (
  SELECT d.doc_id, t, lines, len(lines) AS n_lines, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r ON d.doc_id = r.doc_id
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
         OR word_chars * 10 < n_words * 25
         OR word_chars > n_words * 12
         OR n_symbols * 10 > n_words
         OR (length(t) - length(regexp_replace(t, '[!?]', '', 'g'))) * 4 > n_words
         OR (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) * 10 > word_chars * 3
         OR (n_dup_lines > 2 AND n_dup_lines * 10 > n_lines * 3)
         OR len(list_filter(lines, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•]'))) * 10 > n_lines * 9
         OR len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*\z'))) * 10 > n_lines * 3) AS kept
FROM f
"""
