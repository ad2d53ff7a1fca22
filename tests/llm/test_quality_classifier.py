import random

import numpy as np

from florispark.llm import quality_classifier as qc


def corpus(n=1500, seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("etaoinsr", k=5)) for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        w = rng.choices(vocab, k=rng.randrange(20, 120))
        low, toxic = int(rng.random() < 0.2), int(rng.random() < 0.2)
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["nasty", "vile."])
        if low:
            w = [x for x in w[:10] for _ in range(8)] + ["|"] * 9
        source = "spamhost" if low and rng.random() < 0.8 else f"host{rng.randrange(5)}"
        docs.append((i, " ".join(w), rng.choice(["en", "de", None]), source, len(w)))
        if i % 2:
            labels.append((i, 1 - low, toxic))
    truth = {d[0]: (("|" in d[1]), ("nasty" in d[1] or "vile" in d[1])) for d in docs}
    return docs, labels, truth


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels, truth = corpus()
    odd = [(None, docs[1][1], None, None, None), (9001, None, "en", "host1", 0), (9002, "", "en", "host1", None), (9003, "word " * 100_000, "en", "host1", 500_000), docs[2]]
    df = spark.createDataFrame([(*d, 0.5) for d in docs + odd], SCHEMA + ", kept double")
    lab = spark.createDataFrame(labels + [(None, 1, 0), (1, None, None), (77_777, 0, 0), labels[3]], "doc_id long, quality int, toxic int")
    models = qc.train(df, lab)
    got = qc.score(df, models).collect()
    assert len(got) == len(docs) + len(odd)
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 9000 and r.doc_id % 2 == 0]
    right = [r.kept == (not any(truth[r.doc_id])) for r in unseen]
    assert np.mean(right) > 0.97
    by = {r.doc_id: r for r in got}
    assert not by[9001].kept and not by[9002].kept
    # the metadata view has learned its part, and only for the target that it knows of
    spam = {d[0] for d in docs if d[3] == "spamhost"}
    assert np.mean([r.meta_low_quality for r in unseen if r.doc_id in spam]) > 0.7
    assert np.std([r.meta_toxic for r in unseen]) < 0.1
    kept = qc.keep_good(df, models)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(r.doc_id for r in got if r.kept and r.doc_id is not None)


def test_pseudo_labels_help_a_view_with_few_labels():
    """The text view has few labels; what the metadata view is sure of in the others teaches it."""
    rng = np.random.default_rng(2)
    n = 1200
    y = (rng.random(n) < 0.5).astype(float)
    words = [np.unique(np.where(rng.random(40) < 0.25, 1000 + 500 * t + rng.integers(0, 60, 40), rng.integers(1, 400, 40)).astype(np.uint64)) for t in y.astype(int)]
    text = qc.Sample(words, np.zeros((n, 1)))
    meta = qc.Sample([np.zeros(0, np.uint64)] * n, (y * 4 + rng.normal(0, 0.6, n))[:, None])
    known = y.copy()
    known[240:] = np.nan
    part = np.array([qc.FIT, qc.CALIBRATE, qc.COMBINE])[np.arange(n) % 3]
    pool = np.arange(n) >= 240
    before = qc.fit_views(text, meta, known, part)
    p = qc.sigmoid(np.column_stack((text.logit(before["views"][0]), meta.logit(before["views"][1]))))
    counts = qc.sure_counts((text.h, text.of), (meta.h, meta.of), p, 0, 0.95)
    (_, view, keys, n1, n0) = counts[-1]
    assert view[0] == qc.TEXT and keys[0] == 0 and n1[0] + n0[0] > 600
    after = qc.fit_views(text, meta, known, part, (qc.log_odds(keys[1:], n1[1:], n0[1:], n1[0], n0[0]), qc.NOTHING))
    accuracy = [np.mean((text.logit(m["views"][0])[pool] > 0) == (y[pool] > 0)) for m in (before, after)]
    assert accuracy[1] > accuracy[0] + 0.03 and accuracy[1] > 0.85


def test_the_model_covers_all_documents_and_is_the_same_again(spark):
    docs, labels, _ = corpus()
    # words that no labelled document has go with the spam source
    docs = [(i, t + (" pillz" if s == "spamhost" and i % 2 == 0 else ""), lang, s, n) for i, t, lang, s, n in docs]
    rows = docs + [(3, "other text of this id", "en", "host1", 4), docs[7]]
    df, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    models = [qc.train(x, lab, sure=0.9) for x in (df.repartition(1), df.repartition(7))]
    got = [sorted((str(r.doc_id), r.kept, round(r.p_low_quality, 6), round(r.p_toxic, 6)) for r in qc.score(df, m).collect()) for m in models]
    assert got[0] == got[1]
    text = models[0]["low_quality"]["views"][0]
    taught = dict(zip(text.taught.keys.tolist(), text.taught.values.tolist()))
    import pyarrow as pa
    h = next(qc.word_chunks(pa.array(["pillz"]), lower=True)).hash[0]
    assert taught[int(h)] > 1 and int(h) not in text.weights.keys.tolist()


def test_without_labels_nothing_is_rejected(spark):
    docs, _, _ = corpus(40)
    df = spark.createDataFrame(docs, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in qc.score(df, qc.train(df, none)).collect())
    assert qc.score(df.where("false"), qc.train(df.where("false"), none)).count() == 0
