import itertools
import re

from florispark.llm import quality_rules

TEXTS = [
    None,
    "",
    " \n\t",
    "one two",
    "a b c a b c",
    "x " * 60,
    "word " * 49 + "end",
    "\n".join(["same line here"] * 3 + ["", "another line"]) + " padding" * 60,
    " ".join(f"w{i}" for i in range(200)),
    " ".join(f"w{i % 90}" for i in range(100)) + " # $ % | < >",
    "- a\n- b\n" * 40 + " ".join(f"q{i}" for i in range(60)),
    "été à ça \x0b\x0c\r mixed space " + " ".join(f"é{i}" for i in range(70)),
    " ".join("".join(x) for x in itertools.permutations("abcde")),
    " ".join(["the cat sat"] * 2 + [f"z{i}" for i in range(80)] + ["the cat"]),
]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {p + j for p in at for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


def test_base_counts(spark):
    df = spark.createDataFrame([(i, t, 3) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], 3), (3, TEXTS[3], 3)], "doc_id long, text string, n_words int")
    rows = quality_rules.quality_rules(df).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = TEXTS[4] if r.doc_id is None else TEXTS[r.doc_id]
        assert tuple(r)[1:7] == brute(text), text
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(df.where("false")).count() == 0


def test_the_order_of_rules_doesn_t_matter(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    names = list(quality_rules.rules())
    a, b = (sorted(map(str, quality_rules.quality_rules(df, order=o).collect())) for o in (names, names[::-1]))
    assert a == b and any('kept=True' in x for x in a)
    assert sorted(quality_rules.rule_order(quality_rules.base_counts(df, "doc_id", "text"), quality_rules.rules())) == sorted(names)


def test_a_very_long_text(spark):
    text = " ".join(f"w{i % 70_000}" for i in range(100_000)) + "\n- x" * 2000
    r = quality_rules.quality_rules(spark.createDataFrame([(1, text)], "doc_id long, text string"), order=list(quality_rules.rules())).first()
    assert tuple(r)[1:7] == brute(text)


def test_the_next_rule_is_the_best_of_what_is_left():
    # rule 0 rejects what rule 1 rejects and one more; rule 2 rejects others
    counts = {0b011: 90, 0b001: 1, 0b100: 20, 0: 500}
    assert quality_rules.greedy(counts, [1.0, 1.0, 1.0]) == [0, 2, 1]
    assert quality_rules.greedy(counts, [50.0, 1.0, 1.0]) == [1, 2, 0]
