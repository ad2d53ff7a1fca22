"""Ids beyond 2**53 beside rows without id come back as they were, from every operator on documents, pages and conversations."""

import pytest

from florispark.llm import bpe, conversations, decontamination, importance, line_dedup, mixture, ngram_join, quality_classifier, quality_rules, substring_dedup, suffix_dedup, token_counts, warc
from florispark.llm.queries import vocab_path

BIG = 2**53
IDS = [BIG + 1, BIG + 3, BIG + 5, None, 7, BIG + 1]
TEXT = "some words that are in every document of this small table, and a few more of them. "


def docs(spark, long=False):
    rows = [(i, f"{TEXT * (400 if long else 2)} number {n % 5}") for n, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


OPERATORS = {
    "token_counts": lambda d: token_counts.token_counts(d, vocab_path()),
    "ngram_join": ngram_join.ngram_jaccard_components,
    "quality_rules": lambda d: quality_rules.quality_rules(d, order=list(quality_rules.rules())),
    "line_dedup": line_dedup.line_duplicates,
    "suffix_dedup": lambda d: suffix_dedup.remove_repeats(d, length=400, keep_first=False, digests=True),
    "substring_dedup": substring_dedup.repeated_passages,
    "decontamination": lambda d: decontamination.contamination(d, d.sparkSession.createDataFrame([(1, TEXT)], "item_id long, text string")),
    "bpe": lambda d: bpe.encoding_digests(d, vocab_path()),
    "mixture": lambda d: mixture.words_taken(d.selectExpr("*", "'s' as source")),
    "importance": lambda d: importance.resample(d, d.select("text")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_come_back(spark, name):
    got = [r.doc_id for r in OPERATORS[name](docs(spark)).select("doc_id").collect()]
    assert set(got) <= set(IDS)
    if name != "substring_dedup":
        assert sorted(got, key=str) == sorted(IDS, key=str)


def test_long_texts_and_copies(spark):
    got = {}
    for r in bpe.encoding_digests(docs(spark, long=True), vocab_path()).collect():
        got.setdefault(r.doc_id, []).append(r.n_tokens)
    assert sorted(map(str, got)) == sorted({str(i) for i in IDS}) and len(got[BIG + 1]) == 2
    twice = docs(spark, long=True).where("doc_id = 7").union(docs(spark, long=True).where("doc_id = 7"))
    assert len({tuple(r) for r in bpe.encoding_digests(twice, vocab_path()).collect()}) == 1 and bpe.encoding_digests(twice, vocab_path()).count() == 2


def test_classifier_pages_and_conversations(spark):
    labels = spark.createDataFrame([(i, n % 2, n % 2) for n, i in enumerate(IDS) if i], "doc_id long, quality int, toxic int")
    full = docs(spark).selectExpr("*", "'en' as lang", "'s' as source", "cast(length(text) as long) as n_chars")
    assert sorted((r.doc_id for r in quality_classifier.score(full, quality_classifier.train(full, labels)).collect()), key=str) == sorted(IDS, key=str)
    pages = docs(spark).selectExpr("doc_id as page_id", "'u' as url", "text as html")
    got = warc.archive_round_trip(spark, pages).collect()
    assert sorted((r.page_id for r in got), key=str) == sorted(IDS, key=str) and {r.refers_to for r in got} <= {*IDS, None}
    talk = docs(spark).selectExpr("doc_id as conv_id", "1 as turn", "'user' as role", "text")
    assert {r.conv_id for r in conversations.damage_and_audit(talk).collect()} == set(IDS)
