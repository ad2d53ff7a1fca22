import random
import re

from florispark.llm import decontamination


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_every_contaminated_document_is_found(spark):
    rng = random.Random(4)
    vocab = ["".join(rng.choices("abcdeé", k=4)) for _ in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 4, 5, 6, 9, 20, 38, 59, 400])))) for i in range(60)] + [(70, None), (71, ""), (72, "a " * 30)]
    docs = []
    for i in range(300):
        w = rng.choices(vocab, k=rng.randrange(0, 300))
        for _ in range(rng.choice([0, 1, 1, 2])):
            x = words(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                if x:
                    x[rng.randrange(len(x))] = "changed"
            if rng.random() < 0.3:
                x = x[: len(x) * 9 // 10]
            at = rng.randrange(len(w) + 1)
            w[at:at] = x
        docs.append((i, " ".join(w).upper() if i % 3 else "\n".join(w)))
    docs += [(900, None), (901, ""), (None, items[8][1]), (5, docs[5][1]), (902, "A " * 100)]
    want = []
    for d, t in docs:
        g = grams(t)
        for i, x in items:
            q = grams(x)
            if q and 100 * len(q & g) >= 80 * len(q):
                want.append((d, i, len(q), len(q & g)))
    assert len(want) > 50
    df = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(*x, 1) for x in items + items[:3]], "item_id long, text string, doc_id int")
    for size in (1 << 24, 4000):
        got = [tuple(r) for r in decontamination.contamination(df, bench, block_bytes=size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        clean = decontamination.remove_contaminated(df, bench, block_bytes=size)
        dirty = [grams(t) for _, t in docs]
        kept = [x for x, g in zip(docs, dirty, strict=True) if not any(grams(q) and 100 * len(grams(q) & g) >= 80 * len(grams(q)) for _, q in items)]
        assert clean.columns == df.columns and sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(kept, key=str)
    assert decontamination.contamination(df.where("false"), bench).count() == 0
    assert decontamination.contamination(df, bench.where("false")).count() == 0


def test_a_very_long_text(spark):
    item = " ".join(f"q{i}" for i in range(40))
    text = " ".join(f"w{i}" for i in range(150_000)) + " " + item + " end"
    df = spark.createDataFrame([(1, text), (2, "w " * 200_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "w w w w w w w")], "item_id long, text string")
    for size in (1 << 20, 10):
        got = sorted(tuple(r) for r in decontamination.contamination(df, bench, block_bytes=size).collect())
        assert got == [(1, 7, 36, 36), (2, 8, 1, 1)]
