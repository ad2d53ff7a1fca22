import hashlib
import json
import random
import unicodedata

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402
from tokenizers.normalizers import NFD  # noqa: E402

from florispark.llm import bpe, token_counts  # noqa: E402
from florispark.llm.bpe import Side, coder, join, leaves, tree  # noqa: E402
from florispark.llm.pretoken import encoder, known, normalised  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
TOK = Tokenizer.from_file(PATH)

TEXTS = [
    None,
    "",
    "   \t\n ",
    "Hello, WORLD's best!!! don't you'RE 123 4.5",
    "<|endoftext|>",
    "a<|startoftext|>B <|ENDOFTEXT|> <|endoftext|>c",
    "ΑΣ ΣΑΣ café café İstanbul ẞß 한국어 中文 \U0001f600\U0001f600 x y z\x1c\x85q",
    "a" * 3000,
    "ab" * 700 + "'s" + "!?" * 500 + "'re" + "é" * 400,
    "repeat me " * 300,
    "aꟋb aꟚb aᲉb x՘y e̱ᫌ e̱ᫌ",
    "ꟋꟚ" * 600 + "ΣᲉ'sΣ" * 90 + "𐵐 Ǆ" * 40,
]


def docs(spark, texts=TEXTS):
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(3, texts[3], "en"), (None, "null id", "en")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def want(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


def test_token_counts_are_the_library_s(spark):
    for block in (1, 1 << 20):
        got = token_counts.token_counts(docs(spark), PATH, context=100, block_bytes=block).collect()
        assert len(got) == len(TEXTS) + 2
        for r in got:
            text = "null id" if r.doc_id is None else TEXTS[r.doc_id]
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text or "").encode()), len(want(text)), len(want(text)) > 100), text


def test_token_counts_of_nothing(spark):
    assert token_counts.token_counts(docs(spark).where("false"), PATH).count() == 0


@pytest.mark.parametrize("leaf", [40, 16_384])
def test_encoding_is_the_library_s(spark, leaf):
    got = bpe.encode(docs(spark), PATH, leaf_chars=leaf).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "null id" if r.doc_id is None else TEXTS[r.doc_id]
        assert np.frombuffer(r.ids, "<u4").tolist() == want(text), text
        assert r.decoded == TOK.decode(want(text), skip_special_tokens=False)
    row = next(r for r in bpe.encoding_digests(docs(spark), PATH, leaf_chars=leaf).collect() if r.doc_id == 8)
    assert row.ids_sha256 == hashlib.sha256(np.array(want(TEXTS[8]), "<u4").tobytes()).hexdigest()
    assert bpe.encode(docs(spark).where("false"), PATH).count() == 0


def test_tree_concatenation_of_long_unsplit_text():
    c, rng = coder(PATH), random.Random(5)
    alphabets = ["ab", "thein", "aeiou rst", "!?.", "!'sre t", "é中ñaz", "a1 b2'", "😀é"]
    for n in range(160):
        text = "".join(rng.choice(rng.choice(alphabets) if n % 3 else alphabets[n % 8]) for _ in range(rng.randrange(1, 900)))
        if n % 5 == 0:
            text = "the and " * 9 + "".join(rng.choices("thinaou", k=1500)) + " of it"
        text = normalised(text)
        sides = []
        for x in leaves(text, rng.choice([7, 30, 100])):
            sides.append(Side(x.encode(), *c.spans(x)))
        got, whole = tree(c, sides), c.spans(text)
        assert got.ids.tolist() == whole[0].tolist() == want(text), text
        assert got.start.tolist() == whole[1].tolist() and got.first.tolist() == whole[3].tolist()


def test_the_window_stays_small():
    """The join of two long halves encodes only what is near it."""
    c = coder(PATH)
    text = "".join(random.Random(1).choices("etaoinshrdlu", k=40_000))
    a, b = text[:20_000], text[20_000:]
    seen = []
    spans = c.spans
    left, right = Side(a.encode(), *spans(a)), Side(b.encode(), *spans(b))
    c.spans = lambda t: seen.append(len(t)) or spans(t)
    try:
        assert join(c, left, right).ids.tolist() == spans(text)[0].tolist()
    finally:
        del c.spans
    assert max(seen) < 2_000


class Counting:
    """A tokenizer that notes the words it is asked for."""

    def __init__(self, tok):
        self.tok, self.asked = tok, []

    def encode_batch_fast(self, words, **more):
        for w in words:
            self.asked += [w] if isinstance(w, str) else w
        return self.tok.encode_batch_fast(words, **more)


def test_words_that_come_again_stay_in_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 200)
    c = bpe.Coder(PATH)
    counting = Counting(c.enc.tok)
    monkeypatch.setattr(c.enc, "tok", counting)
    often, rng = [f"{a}the" for a in "bcdfghjklm"], random.Random(3)
    for _ in range(60):
        words = often + ["".join(rng.choices("etaoins", k=9)) for _ in range(20)] + ["<|endoftext|>"]
        c.fill(words)
        assert np.frombuffer(c.ids(words), "<u4").tolist() == want(" ".join(words))
        assert c.decoded(words) == TOK.decode(want(" ".join(words)), skip_special_tokens=False)
        assert len(c.cache[0]) + len(c.older[0]) <= 200
    assert [counting.asked.count(w) for w in often] == [1] * 10


def test_a_batch_of_more_words_than_the_cache_holds(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 20)
    c = bpe.Coder(PATH)
    for text in ("one two three", " ".join("".join(x) for x in zip("abcdefghijklmnopqrstuvwxyz" * 3, "thean" * 15, "ours" * 18)), "two"):
        ids, start, end, first = c.spans(text)
        assert ids.tolist() == want(text)
        assert [text[s:e] for s, e in zip(start[first], np.append(start[1:][first[1:]], len(text)))] and int(first.sum()) == len(text.split())


def test_places_of_pre_tokens_in_any_text():
    enc, rng = encoder(PATH), random.Random(6)
    for n in range(2000):
        own = "a é ß中1.!'s \t\n\x0b\x1c\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000\u3001\u200b\U0001f600" + ("\ua7cb" if n % 9 == 0 else "")
        text = enc.normalised("".join(rng.choices(own, k=rng.randrange(30))))
        at, words = enc.placed(text)
        assert list(zip(at.tolist(), words, strict=True)) == enc.found(text), ascii(text)


def library_words(text):
    text = TOK.normalizer.normalize_str(text)
    return [text[s:e] for _, (s, e) in TOK.pre_tokenizer.pre_tokenize_str(text)]


def test_every_known_character_is_cut_as_the_library_does():
    enc, decompose = encoder(PATH), NFD()
    marks = {}
    for c in map(chr, range(0x300, 0x370)):
        marks.setdefault(unicodedata.combining(c), c)
    marks.pop(0, None)
    every = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and known(c)]
    assert len(every) > 90_000
    for c in every:
        for x in (f"a{c}b", f"1{c}!", f"x{c}'s"):
            assert enc.words(x) == library_words(x), hex(ord(c))
        assert decompose.normalize_str(c) == unicodedata.normalize("NFD", c)
        if unicodedata.combining(c) or unicodedata.decomposition(c):
            for m in marks.values():  # the order of marks
                for x in (f"x{c}{m}", f"x{m}{c}"):
                    assert decompose.normalize_str(x) == unicodedata.normalize("NFD", x)


def test_any_text_is_cut_as_the_library_does():
    enc, rng = encoder(PATH), random.Random(4)
    planes = [(0, 0x250), (0x250, 0x600), (0x600, 0x1000), (0x1000, 0x2100), (0x2100, 0xD800), (0xE000, 0x10000), (0x10000, 0x20000), (0x1F300, 0x1F700), (0x300, 0x370)]
    for _ in range(4000):
        own = rng.sample(planes, 3)
        text = "".join(chr(rng.randrange(*rng.choice(own))) for _ in range(rng.randrange(1, 40)))
        assert enc.words(text) == library_words(text), ascii(text)
        assert [i for w in enc.ids(enc.pretokens(text)) for i in w] == want(text), ascii(text)


def test_another_vocabulary_is_refused(tmp_path):
    spec = json.loads(open(PATH).read())
    spec["normalizer"]["normalizers"].pop()
    (tmp_path / "other.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="normaliser"):
        encoder(str(tmp_path / "other.json"))
