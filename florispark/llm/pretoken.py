"""Pre-tokens of the word BPE vocabulary: its normaliser and splitter, for whole texts.

The vocabulary file fixes this: special strings are taken from the raw text first; the
rest is NFC-normalised, white space becomes one space, letters are lower-cased one by one,
and a pattern cuts what is left.  BPE then acts on each pre-token alone.

Texts whose characters are all in KNOWN are normalised and cut here, which is several times as fast
as the library; the tests hold every one of these characters, and every order of marks, against the
library.  Any other text goes to the library's own normaliser and splitter, since Unicode tables
differ from version to version.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# fixed values of the vocabulary file, which are compared with it
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

# code points that \s has in the library
WHITE = ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
#: Code points to which both sides' Unicode tables give the same properties.
KNOWN = (
    *((0x0000, 0x0557), (0x0559, 0x058A), (0x058D, 0x07FC), (0x0900, 0x09FD), (0x0A00, 0x0C3B), (0x0E00, 0x0EB9)),
    *((0x1E00, 0x208E), (0x2090, 0x209C), (0x20A0, 0x2BFF), (0x2C60, 0x2C7F), (0x3000, 0xA48C), (0xAC00, 0xD7A3)),
    *((0xF900, 0xFAFF), (0xFE30, 0xFFEF), (0x1F000, 0x1FAFF), (0x20000, 0x2A6DF)),
)


def _class(ranges: tuple[tuple[int, int], ...]) -> str:
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


_white = np.zeros(WHITE[-1][1] + 2, dtype=bool)
for _low, _high in WHITE:
    _white[_low : _high + 1] = True
_piece = regex.compile(SPLIT.replace(r"\s", _class(WHITE)))
_unknown = regex.compile(f"[^{_class(KNOWN)}]")


def known(text: str) -> bool:
    return text.isascii() or _unknown.search(text) is None


def normalised(text: str) -> str:
    """The normalised form of a text of known characters (but for runs of white space, which no pre-token holds)."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    if "Σ" in text:
        text = text.replace("Σ", "σ")  # lower() alone would look at the letters around it
    return text.lower()


class PieceEncoder:
    """Normalises and cuts texts, and encodes pre-tokens with the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = {k: (spec[k] or {}).get(name) for k, name in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))}
        plain = all(not x["normalized"] and not any(x[k] for k in ("single_word", "lstrip", "rstrip")) for x in spec["added_tokens"])
        if steps != {"normalizer": NORMALIZERS, "pre_tokenizer": PRE_TOKENIZERS} or not plain or spec["post_processor"] or spec["decoder"] or spec["model"]["end_of_word_suffix"] != "</w>":
            raise ValueError(f"{path}: its normaliser, splitter, added tokens or decoder aren't those of the word BPE vocabulary")
        self.whole = Tokenizer.from_file(path)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.tok = Tokenizer.from_file(path)
        self.tok.normalizer = normalizers.Sequence([])
        self.tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def ids(self, words: list[str]) -> list[list[int]]:
        return [[self.special[w]] if w in self.special else e.ids for w, e in zip(words, self.tok.encode_batch_fast(words, add_special_tokens=False), strict=True)]

    def row(self, words: list[str]) -> list[int]:
        """Ids of words, none of them special, one after another: one encoding in place of one for each word."""
        return self.tok.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids

    def normalised(self, text: str) -> str:
        return normalised(text) if known(text) else self.whole.normalizer.normalize_str(text)

    def found(self, text: str) -> list[tuple[int, str]]:
        """(start, pre-token) in order, of a normalised text."""
        if known(text):
            return [(m.start(), m.group()) for m in _piece.finditer(text)]
        return [(s, text[s:e]) for _, (s, e) in self.whole.pre_tokenizer.pre_tokenize_str(text)]

    def placed(self, text: str) -> tuple[np.ndarray, list[str]]:
        """Starts and pre-tokens in order, of a normalised text."""
        if not known(text):
            found = self.found(text)
            return np.array([m for m, _ in found], dtype=np.int64), [w for _, w in found]
        words = _piece.findall(text)
        size = np.fromiter(map(len, words), np.int64, len(words))
        # only white space is in no pre-token
        wide = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        return np.flatnonzero(~_white[np.minimum(wide, len(_white) - 1)])[np.cumsum(size) - size], words

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if known(text):
            return _piece.findall(normalised(text))
        return [w for _, w in self.found(self.normalised(text))]

    def parts(self, text: str) -> list[tuple[bool, str]]:
        """(special?, text) in order: special strings, and the raw text between them."""
        if self._special is None or not any(x in text for x in self.special):
            return [(False, text)] if text else []
        return [(x in self.special, x) for x in self._special.split(text) if x]

    def pretokens(self, text: str) -> list[str]:
        out: list[str] = []
        for special, x in self.parts(text):
            if special:
                out.append(x)
            else:
                out += self.words(x)
        return out


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
