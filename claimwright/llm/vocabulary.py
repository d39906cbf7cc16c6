"""Word-end byte pair vocabularies: how a text becomes words, and words become symbols.

Reads a tokenizer file of the kind the tokenizers library writes: NFC, white space to one space, lower
case; a pattern picks the words; bytes are the symbols, the last of a word with the word end appended.

What is a letter and how marks are ordered depends on a version of Unicode. So the library's own normalizer and pattern
cut any chunk with other characters than ASCII and the letters of Latin-1; Python's only cut those, on which all
versions agree: these letters are whole, no mark among them, and each has one lower case.
"""

from __future__ import annotations

import json
import re
from functools import cache

import regex
from tokenizers import Regex, Tokenizer, pre_tokenizers

#: White space as the pattern languages of Unicode define it (str.split() also splits at U+001C to U+001F).
_SPACES = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
_ODD_SPACES = re.compile("[\x1c-\x1f]")
_LATIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")


@cache
def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte: itself if it is printable Latin-1, else the next code point from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.word_end: str = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: In order of rank: ids of the left and right part and of the result.
        self.merges = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in merges]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.specials.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._latin_words = regex.compile(split["pattern"]["Regex"])
        # The file's settings without its vocabulary, which the library would hold a second time.
        settings = spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None, "decoder": None}
        self._normalizer = Tokenizer.from_str(json.dumps(settings)).normalizer
        self._split = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), behavior=split["behavior"].lower(), invert=split["invert"])
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self._bytes = byte_alphabet()

    def parts(self, text: str) -> list[str]:
        """Text between special strings at even places, the special strings at odd ones."""
        return self._special.split(text) if "<|" in text else [text]

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Runs of anything but white space. No word spans two of them."""
        return [c for c in _SPACES.split(text) if c] if _ODD_SPACES.search(text) else text.split()

    @staticmethod
    def latin(text: str) -> bool:
        """Only ASCII and the letters of Latin-1: its words are those of its chunks, as no word holds white space."""
        return text.isascii() or _LATIN.fullmatch(text) is not None

    def words(self, chunk: str) -> list[str]:
        if self.latin(chunk):
            return self._latin_words.findall(chunk.lower())
        return [word for word, _ in self._split.pre_tokenize_str(self._normalizer.normalize_str(chunk))]

    def spelled(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self._bytes)

    def symbols(self, word: str) -> list[int]:
        """Ids of the word's bytes; the last one carries the word end."""
        out = list(self.spelled(word))
        out[-1] += self.word_end
        return [self.ids[s] for s in out]


@cache
def vocabulary(path: str) -> Vocabulary:
    """Read once in each Python worker."""
    return Vocabulary(path)
