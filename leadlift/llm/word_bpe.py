"""Ids of whole texts by a BPE vocabulary, run by run and word by word.

A tokenizer's pattern never lets a word cross the places where texts are cut into runs, so a text's ids are the ids of
its runs, one after the other, and a run's ids those of its words. Runs and words recur: the library's model encodes
each distinct word once per worker and memo generation. Runs with characters beyond U+024F are left to the library as a
whole; below, the library's pattern and normalisation are what the expressions here say.
"""

from __future__ import annotations

import re
from array import array

import regex
from tokenizers import Tokenizer

# the characters that the tokenizers' \s matches; Python's also matches U+001C..U+001F
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPECIAL_START = "<|"
MEMO_ENTRIES, LONG_KEY = 300_000, 64
_SPACE = re.compile(f"[{SPACES}]+")
_CONTROL = re.compile("[\x1c-\x1f]")
# beyond U+024F, or where lower case is longer, the library normalises
_WIDE = re.compile("[\u0130\u0250-\U0010ffff]")
# the pattern of the word-end vocabulary, fixed values
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


_SHOWN = dict(enumerate(byte_characters()))


def show_bytes(word: str) -> str:
    """The word's UTF-8 bytes, each as its printable character."""
    return word.encode().decode("latin-1").translate(_SHOWN)


def is_wide(text: str) -> bool:
    return not text.isascii() and _WIDE.search(text) is not None


def runs_of(text: str) -> list[str]:
    """The text's runs of non-space characters, lower-cased where that is safe; as many characters as the text's."""
    if SPECIAL_START not in text and not is_wide(text):
        text = text.lower()
    if _CONTROL.search(text):
        return [run for run in _SPACE.split(text) if run]
    return text.split()


def plain_words(run: str) -> list[str] | None:
    """The words of a run, lower-cased; None if the library has to find them."""
    if run.isascii() and run.isalpha():
        return [run.lower()]
    if SPECIAL_START in run or is_wide(run):
        return None
    return _WORDS.findall(run.lower())


class Remembered(dict):
    """Values by key, worked out when first asked for; two generations of at most ``entries`` keys.

    Keys beyond ``LONG_KEY`` characters are not kept, so memory stays bounded.
    """

    def __init__(self, compute, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.compute, self.entries, self.old = compute, entries, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONG_KEY:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class IdMemo:
    """The ids of texts as little-endian unsigned 32-bit bytes, run by run.

    ``cut`` gives a text's runs, ``words`` a run's words or None where the library must encode the run as a whole.
    """

    def __init__(self, tokenizer: Tokenizer, cut, words):
        self.tokenizer, self.cut, self.split = tokenizer, cut, words
        self.tokenize = tokenizer.model.tokenize
        self.words, self.runs = Remembered(self._word), Remembered(self._run)

    def _word(self, word: str) -> bytes:
        shown = word if word.isalpha() and word.isascii() else show_bytes(word)
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def _run(self, run: str) -> bytes:
        words = self.split(run)
        if words is None:
            return array("I", self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.words.__getitem__, words))

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        ids = self.runs.__getitem__
        return [b"".join(map(ids, self.cut(text))) for text in texts]


def word_end_ids(content: bytes) -> IdMemo:
    """For a vocabulary with word ends, whose tokenizer drops white space and lowers case."""
    return IdMemo(Tokenizer.from_buffer(content), runs_of, plain_words)
