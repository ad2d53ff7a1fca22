import random
import re

from florispark.llm import line_dedup
from florispark.llm.line_dedup import word_edits


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, up = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(up[j] + 1, row[j - 1] + 1, up[j - 1] + (x != y)))
    return row[-1]


def brute(rows, min_words=3, near_words=8):
    lines = []
    for key, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines += [(key, n, words(x)) for n, x in enumerate((text or "").split("\n")) if len(words(x)) >= min_words]
    gone = {}
    for i, (key, n, w) in enumerate(lines):
        equal = any(w == v for _, _, v in lines[:i])
        near = len(w) >= near_words and any(len(v) >= near_words and abs(len(v) - len(w)) < 2 and edits(w, v) == 1 for _, _, v in lines[:i])
        if equal or near:
            gone.setdefault(key, []).append((n, not equal))
    out = []
    for key, text in rows:
        own = gone.get(key, [])
        out.append((key, len(own), sum(x for _, x in own), ",".join(str(x) for x, _ in own)))
    return out


def corpus():
    rng = random.Random(3)
    vocab = ["".join(rng.choices("abcdé", k=3)) for _ in range(40)]
    base = [rng.choices(vocab, k=rng.choice([1, 2, 3, 7, 8, 9, 15, 30])) for _ in range(40)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randrange(0, 6)):
            x = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                kind, at = rng.randrange(3), rng.randrange(len(x)) if x else 0
                if kind == 0 and x:
                    x[at] = rng.choice(vocab)
                elif kind == 1:
                    x.insert(at, rng.choice(vocab))
                elif x:
                    del x[at]
            text.append(rng.choice([" ", "  ", "\t"]).join(x).upper() if rng.random() < 0.2 else " ".join(x))
        rows.append((i, "\n".join(text)))
    return rows + [(300, None), (301, ""), (302, " \n\n "), (None, rows[7][1]), (5, rows[5][1]), (303, "word " * 5000), (304, "word " * 4999)]


def test_lines_that_go_are_those_of_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, line int")
    got = sorted(map(tuple, line_dedup.line_duplicates(df).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert sum(x[2] for x in want) > 20
    assert got == want
    assert line_dedup.line_duplicates(df.where("false")).count() == 0


def test_texts_lose_the_lines(spark):
    df = spark.createDataFrame([(1, "keep this line\n\nand that one"), (2, "new words are here\nKeep  this line\n}"), (3, "and that one"), (4, None), (5, ""), (6, "}")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.remove_lines(df).collect()}
    assert got == {1: "keep this line\n\nand that one", 2: "new words are here\n}", 4: None, 5: "", 6: "}"}
    assert line_dedup.remove_lines(df).columns == df.columns


def test_bounded_edit_distance():
    rng = random.Random(1)
    for _ in range(500):
        a, b = (rng.choices("abc", k=rng.randrange(0, 7)) for _ in range(2))
        for bound in (0, 1, 2):
            assert word_edits(a, b, bound) == min(edits(a, b), bound + 1)
