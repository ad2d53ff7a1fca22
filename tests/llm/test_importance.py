import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from florispark.llm import importance

TEXTS = [
    None,
    "",
    " .,;\n",
    "One two, THREE; one-two three 4 five Élan élan ÉLAN straße 漢字 \U0001f600x a_b",
    "alpha beta gamma " * 12,
    " ".join(f"word{i % 7}" for i in range(200)),
    "x" * 5000,
    "\x00nul\x00in text\x7f and more " * 3,
    " ".join(f"t{i}" for i in range(25)),
]


def features(text, shortest, longest):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[i : i + n]) for n in range(shortest, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, n, percent=10, least=20, buckets=10_000):
    of = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(of, features(x, *n)[1]))
    for x in target:
        t.update(map(of, features(x, *n)[1]))
    S, T = float(sum(s.values())), float(sum(t.values()))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets))))
    out = []
    for i, x in docs:
        words, f = features(x, *n)
        weight = sum(gain(of(y)) for y in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: int(percent * len(able) // 100)])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize("n", [(1, 1), (1, 3), (2, 2)])
def test_against_brute_force(spark, n):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, f"{'alpha ' * (i % 9)}{TEXTS[5]} w{i}") for i in range(60)] + [(None, TEXTS[4]), (103, TEXTS[8]), (103, TEXTS[8]), (2**53 + 1, TEXTS[8])]
    target = ["Alpha beta, gamma", None, "word1 word2 word2 élan"]
    df = spark.createDataFrame([(i, t, 1, "r") for i, t in docs], "doc_id long, text string, weight int, rank string").repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted((tuple(r) for r in importance.resample(df, goal, ngrams=n).collect()), key=str)
    assert got == brute(docs, target, n)
    assert importance.resample(df.where("false"), goal).count() == 0
    assert len(importance.resample(df, goal.where("false"), ngrams=n).collect()) == len(docs)


def test_long_texts_are_cut_between_words_only(monkeypatch):
    text = " ".join(f"Word{i}, été" for i in range(300)) + " " + "y" * 500
    monkeypatch.setattr(importance, "PIECE_CHARS", 50)
    for n in ((1, 1), (1, 3)):
        f = importance.Features(*n, 1000)
        f_pieces = list(importance.pieces(text, 50))
        assert "".join(f_pieces) == text and len(f_pieces) > 20
        monkeypatch.setattr(importance, "pieces", lambda t: iter(f_pieces))
        words, count, buckets, counts = f.of(text)
        want = Counter(zlib.crc32(x.encode()) % 1000 for x in features(text, *n)[1])
        assert (words, count) == (features(text, *n)[0], sum(want.values())) and dict(zip(buckets.tolist(), counts.tolist())) == want
        monkeypatch.undo()


def test_draw_returns_the_rows(spark):
    df = spark.createDataFrame([(i, f"{TEXTS[5]} {i}", i) for i in range(100)], "doc_id long, text string, n int")
    goal = spark.createDataFrame([("word1",)], "text string")
    got = importance.draw(df, goal, percent=20)
    want = {r.doc_id for r in importance.resample(df, goal, percent=20).collect() if r.rank}
    assert len(want) == 20 and {r.doc_id for r in got.collect()} == want and got.columns == df.columns
