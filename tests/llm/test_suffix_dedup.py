import hashlib
import random

import numpy as np
import pytest

from florispark.llm import suffix_dedup
from florispark.llm.suffix_dedup import prefix_ranks, previous_factors, suffix_order


def brute(rows, length, keep_first):
    """Rows in order of id; with keep_first rows alike count once."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen = {}
    for i in order:
        data = (rows[i][1] or "").encode()
        for p in range(len(data) - length + 1):
            seen.setdefault(data[p : p + length], []).append((i, p))
    out = []
    for i, (key, text) in enumerate(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            at = seen[data[p : p + length]]
            if len(at) > 1 and (not keep_first or at[0] != (i, p)):
                gone[p : p + length] = True
        kept = data if not gone.any() else bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = int(gone[0]) + int((np.diff(gone.astype(int)) == 1).sum()) if len(gone) else 0
        out.append((key, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rng.randrange(6, 60)) for _ in range(9)]
    rows = []
    for i in range(120):
        parts = [prose(rng.randrange(0, 50))]
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            x = rng.choice(shared)
            a = rng.randrange(0, 10)
            parts += [x[a:] if rng.random() < 0.7 else x[: len(x) // 2] + "X" + x[len(x) // 2 :], prose(rng.randrange(0, 20))]
        rows.append((i, "".join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, "ab" * 200), (205, "c" * 75), (206, prose(30) + "ab" * 40), (207, shared[0] * 2), (None, shared[1]), (208, "short")]
    return rows


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("hot", [20_000, 2])
def test_removed_bytes_are_those_of_brute_force(spark, keep_first, hot):
    rows = corpus() + ([(5, corpus()[5][1])] if not keep_first else [])
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, id string")
    got = sorted(map(tuple, suffix_dedup.remove_repeats(df, 60, keep_first, digests=True, hot_contexts=hot).drop("n_repeated").collect()), key=str)
    want = sorted(brute(rows, 60, keep_first), key=str)
    assert sum(x[2] > 0 for x in want) > 30
    assert got == want


@pytest.mark.parametrize("hot", [20_000, 2])
def test_shorter_strings_are_counted(spark, hot):
    rows = corpus() + [(5, corpus()[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, suffix_dedup.remove_repeats(df, 60, False, digests=True, hot_contexts=hot, report_length=31).collect()), key=str)
    assert got == sorted(((*x, y[2]) for x, y in zip(brute(rows, 60, False), brute(rows, 31, False), strict=True)), key=str)
    assert sum(x[5] > x[2] for x in got) > 20


def test_texts_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "é" * 50 + "a"), (2, "é" * 50 + "b")], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, 100).collect()}
    assert (got[1].text, got[2].text) == ("é" * 50 + "a", "b") and got[2].removed[0].e == 100
    assert suffix_dedup.remove_repeats(df.where("false"), 100).count() == 0
    again = suffix_dedup.remove_repeats(df.union(df), 100, report_length=50).collect()  # rows alike are one text
    assert sorted((r.doc_id, r.text, r.n_repeated) for r in again) == [(1, "é" * 50 + "a", 100)] * 2 + [(2, "b", 100)] * 2
    assert suffix_dedup.remove_repeats(df.where("false"), 100, digests=True, report_length=50).count() == 0


def test_a_very_long_text(spark):
    rng = random.Random(9)
    body = "".join(rng.choices("abcdefghij ", k=700_000))
    rows = [(1, body + "é" * 300 + body[1000:2000]), (2, "x" * 10 + body[500_000:500_400] + "y")]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 400, False, digests=True, report_length=240).collect()}
    # the run of é repeats itself; 1,000 bytes are there twice, the second time next to it; 400 are shared
    assert (got[1].n_removed, got[1].n_spans, got[1].n_repeated) == (600 + 2 * 1000 + 400, 3, 3000)
    assert (got[2].n_removed, got[2].n_repeated) == (400, 400)


def test_previous_factors():
    rng = random.Random(2)
    for _ in range(30):
        data = np.array(rng.choices([97, 98], k=120), dtype=np.uint8)
        length = rng.choice([16, 24, 40])
        at = np.arange(len(data) - length + 1)
        order, lcp = suffix_order(prefix_ranks(data, length), at, length)
        text = data.tobytes()
        suffixes = [text[i : i + length] for i in at[order]]
        assert suffixes == sorted(suffixes)
        for least in (8, length):
            got = previous_factors(at[order], lcp, least)
            for x, i in enumerate(order.tolist()):
                best = 0
                for j in range(i):
                    n = next((k for k in range(length) if text[i + k] != text[j + k]), length)
                    best = max(best, n if n == length else n // 8 * 8)
                assert got[x] == (best if best >= least else 0)
