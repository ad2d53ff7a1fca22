"""Each stage of the corpus pipeline against brute force on a small fixture."""

import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tokenizers import Tokenizer  # noqa: E402

from florispark.llm.queries import vocab_path  # noqa: E402
from tests.llm.test_decontamination import grams  # noqa: E402
from tests.llm.test_line_dedup import brute as brute_lines  # noqa: E402
from tests.llm.test_ngram_join import brute as brute_components  # noqa: E402
from tests.llm.test_quality_classifier import corpus  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels, _ = corpus(700, 5)
    rng = random.Random(1)
    items = [(i, " ".join(rng.choices(["".join(rng.choices("bcdfg", k=4)) for _ in range(99)], k=25))) for i in range(6)]
    rows = [(i, t.replace(" ", "\n", 1) if i % 7 == 0 else t, lang, s, len(t)) for i, t, lang, s, _ in docs]
    for i in range(700, 760):
        t = rows[rng.randrange(700)][1].split(" ")
        t[rng.randrange(len(t))] = "other"
        rows.append((i, " ".join(t) if i % 2 else " ".join(t) + "\n" + items[i % 6][1] + " and more", "en", "host1", 3))
    rows += [(None, items[2][1] + " and other words of a row without id", "en", "host1", 3), (None, items[3][1] + " in a copy", "en", "host1", 3), (None, items[3][1] + " in a copy", "en", "host1", 3)]
    fresh = " ".join(rng.choices(["".join(rng.choices("etaoinsr", k=5)) for _ in range(300)], k=60))
    rows += [(None, fresh, "en", "host1", 3), (None, fresh + " more words here", "en", "host1", 3), (950, fresh + " end of it", "en", "host1", 3), (951, rows[9][1] + " x y z", "en", "host1", 1), (951, rows[11][1] + " y z x", "en", "host1", 1)]
    rows += [(None, "a text without id\nof two lines", None, None, None), (900, None, "en", "host1", 0), (901, "", "en", "host1", 0), rows[3]]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(*r, 1.5) for r in rows], SCHEMA + ", component_id double").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def key(r):
    return str(tuple(r))


def test_stages_and_run(spark, folder, tmp_path):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert [f.name for f in docs.schema] == ["doc_id", "text", "lang", "source", "n_chars", "component_id"]  # a column whose name clashes
        out.append(docs.collect())
    good, lined, single, clean, coded = out
    bad = {i for i, t, *_ in rows if i is not None and ("|" in (t or "") or "nasty" in (t or "") or "vile" in (t or "") or not t)}
    kept = {r.doc_id for r in good}
    assert len(bad & kept) + len({r[0] for r in rows} - bad - kept) < 0.05 * len(rows)  # a few hundred labels only

    # each distinct row is a document of its own, those without id first
    own = sorted({(r.doc_id, r.text) for r in good}, key=lambda x: (x[0] is not None, x[0] or 0))
    gone = {x: removed for x, (_, _, _, removed) in zip(own, brute_lines([(n, t) for n, (_, t) in enumerate(own)]), strict=True)}
    want = []
    for r in good:
        cut = {int(x) for x in gone[(r.doc_id, r.text)].split(",") if x}
        text = "\n".join(x for n, x in enumerate((r.text or "").split("\n")) if n not in cut) if cut else r.text
        if not cut or text.strip():
            want.append((r.doc_id, text, r.lang, r.source, len(text), 1.5))
    assert sorted(map(key, lined)) == sorted(map(key, want)) and len(lined) < len(good)

    order = sorted({(r.doc_id is None, r.doc_id or 0, r.text) for r in lined}, key=lambda x: x[:2])
    comp = brute_components({i: t for i, (_, _, t) in enumerate(order)}, 5, 80)
    firsts = {(None if none else i, t) for n, (none, i, t) in enumerate(order) if comp[n][1] == n}
    assert len(single) == len(firsts) and sum(r.doc_id is None for r in single) >= 2
    free = lambda pairs: sorted(str(i) for i, _ in pairs)  # noqa: E731  # which of the texts that share an id is first is by hash
    assert free((r.doc_id, r.text) for r in single) == free(firsts)

    is_dirty = lambda r: any(10 * len(grams(x) & grams(r.text)) >= 8 * len(grams(x)) for _, x in items)
    assert any(is_dirty(r) for r in single if r.doc_id is None) and any(is_dirty(r) for r in single if r.doc_id is not None)
    assert sorted(map(key, clean)) == sorted(key(r) for r in single if not is_dirty(r))

    tok = Tokenizer.from_file(vocab_path())
    want = []
    for r in clean:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(key, coded)) == sorted(map(key, want))
    assert sorted(map(key, corpus_pipeline.run(spark, path).collect())) == sorted(map(key, coded))


def test_stages_take_empty_tables(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_stages_called_on_their_own_bound_their_batches(spark):
    import corpus_pipeline

    before = {k: spark.conf.get(k) for k in corpus_pipeline.BATCH}
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    try:
        assert corpus_pipeline.STAGES[4][1](spark, docs, "").count() == 1
        assert {k: int(spark.conf.get(k)) for k in before} == corpus_pipeline.BATCH
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
