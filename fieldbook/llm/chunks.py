"""Cutting texts where tokenizers of the byte-level family always cut, and remembering the parts.

The pieces of these tokenizers either hold white space only, or one space at most and then none. So a
piece always starts where white space follows something else, whatever stands around, and the parts
between such places can be tokenized apart. Words repeat; what was made of a part is kept in a memo.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import regex

#: Unicode's ``White_Space``, as the tokenizers' patterns read ``\s`` (fixed values).
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0            "
               "    　")

CHUNK = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")

#: Two white spaces in a row of which the second is a space or a new line: in texts with none of
#: these, every space and every new line starts a chunk.
RUNS = [a + b for a in WHITE_SPACE for b in " \n"]
ASCII_RUNS = [r for r in RUNS if r.isascii()]

#: Longer parts are not kept.
MEMO_CHARS = 64


#: What the library's byte-level splitter cuts at (a fixed value, published with the tokenizer).
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: The same cuts found sooner: what most pieces are is tried first, and ASCII texts need no Unicode
#: classes. No two of the parts that change places can match at one place.
_ANY = regex.compile(r""" ?\p{L}+|'(?:[stmd]|re|ve|ll)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""").findall
_ASCII = re.compile(r" ?[A-Za-z]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII).findall

#: Up to the end of the Latin blocks the three classes are listed out (fixed values of Unicode).
_BEYOND_LATIN = re.compile("[^\x00-\u024f]").search
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t-\r\x85\xa0"
_LATIN = re.compile(f" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall


def pieces(text: str) -> list[str]:
    """The pieces that ``PIECES`` finds in a text."""
    if text.isascii():
        return _ASCII(text)
    return _ANY(text) if _BEYOND_LATIN(text) else _LATIN(text)


#: Kinds of bytes: ASCII white space, letters and digits, other printable ones.
_SPACE, _WORD, _OTHER = 1, 2, 3
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = _OTHER
_KINDS[[ord(c) for c in WHITE_SPACE if c.isascii()]] = _SPACE
_KINDS[[b for b in range(0x7F) if chr(b).isalnum()]] = _WORD

#: White space beyond ASCII, its UTF-8 bytes read as one number.
_WIDE_SPACE = [int.from_bytes(c.encode(), "big") for c in WHITE_SPACE if not c.isascii()]


def piece_starts(data: np.ndarray) -> np.ndarray:
    """Marks bytes of UTF-8 text (but the first) at which one of ``pieces`` starts, whatever stands around:
    ASCII white space that does not follow white space, and other ASCII signs after a letter or digit.

    Letters are told up to U+00FF, so not all starts are marked; the text between two marks is some whole pieces.
    """
    kinds = _KINDS[data]
    space, word = kinds == _SPACE, kinds == _WORD
    word[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # U+00C0 to U+00FF but two signs
    marks = np.zeros(len(data), bool)
    marks[1:] = (space[1:] & ~space[:-1]) | ((kinds[1:] == _OTHER) & word[:-1])
    wide = np.flatnonzero(space[1:] & (data[:-1] >= 0x80)) + 1
    two = data[wide - 2].astype(np.int64) << 8 | data[wide - 1]
    three = data[wide - 3].astype(np.int64) << 16 | two
    marks[wide[np.isin(two, _WIDE_SPACE) | np.isin(three, _WIDE_SPACE)]] = False
    return marks


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for the 256 bytes: printable ones stand for
    themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Memo(dict):
    """Computes missing values and keeps the recent ones: two generations of ``entries`` at most."""

    def __init__(self, make: Callable, entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Chunked:
    """``of(text)``: what ``make`` gives for each chunk of the text, in order."""

    def __init__(self, make: Callable[[str], object], entries: int = 150_000):
        self.raw = Memo(make, entries // 10)
        self.word = Memo(lambda w: make(w if w[0] == "\n" else " " + w), entries)

    def of(self, text: str) -> Iterable:
        if any(r in text for r in (ASCII_RUNS if text.isascii() else RUNS)):
            return map(self.raw.__getitem__, CHUNK.findall(text))
        first, *rest = text.replace("\n", " \n").split(" ")
        if rest and not rest[-1]:  # a space at the very end
            rest[-1:] = []
            tail = [self.raw[" "]]
        else:
            tail = []
        head = [self.raw[first]] if first else []
        return [*head, *map(self.word.__getitem__, rest), *tail]
