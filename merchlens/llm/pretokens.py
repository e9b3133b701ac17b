"""Pre-tokens of whole batches: the pieces between which byte-pair merges never reach.

Texts are laid end to end as code points; each point has a class (letter, number, white space,
other), and the cuts of the two published patterns are found from changes of class. Pieces are
known by 64-bit hashes, so that each different piece of a batch is encoded once.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex

from merchlens.llm.words import mix, segment_hashes

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# What may follow an apostrophe as a piece of its own.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(maxsize=1)
def point_classes() -> np.ndarray:
    """Class of every code point."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            s, e = (x if x < 0xD800 else x + 0x800 for x in m.span())
            out[s:e] = kind
    out[0xD800:0xE000] = OTHER
    return out


@lru_cache(maxsize=1)
def point_values() -> np.ndarray:
    """Value of every code point in hashes."""
    return mix(np.arange(0x110000, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))


class Points:
    """Texts as one array of code points; text i is [offset[i], offset[i + 1])."""

    def __init__(self, texts: list[str]):
        self.whole = "".join(texts)
        self.points = np.frombuffer(self.whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.offset = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]).astype(np.int64)
        self.kind = point_classes()[self.points]
        n = len(self.points)
        self.first = np.zeros(n + 1, bool)
        self.first[self.offset] = True

    def _endings(self, alone: np.ndarray) -> np.ndarray:
        """For each place of an apostrophe in ``alone``: how many letters of an ending follow it in the same text."""
        p, stop = np.append(self.points, np.zeros(3, np.uint32)), self.first
        size = np.zeros(len(alone), np.int64)
        for ending in sorted(ENDINGS, key=len):
            same = np.ones(len(alone), bool)
            for i, c in enumerate(ending, 1):
                at = np.minimum(alone + i, len(stop) - 1)
                same &= (p[alone + i] == ord(c)) & ~stop[at]
            size[same] = len(ending)
        return size

    def _runs(self) -> np.ndarray:
        """Places where the class changes or a text starts, and the end."""
        cut = self.first.copy()
        cut[1:-1] |= self.kind[1:] != self.kind[:-1]
        cut[-1] = True
        return cut

    def _contract(self, cut: np.ndarray, barred: np.ndarray) -> None:
        """Moves cuts: an apostrophe that is a run by itself takes an ending's letters; ``barred``: apostrophes already taken."""
        quote = np.flatnonzero((self.points == 39) & cut[:-1] & cut[1:] & ~barred)
        size = self._endings(quote)
        quote, size = quote[size > 0], size[size > 0]
        cut[quote + 1] = False
        cut[quote + 1 + size] = True

    def byte_level(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends for: ending | space? letters | space? numbers | space? others | spaces but the last | spaces."""
        if not len(self.points):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = self._runs()
        space = self.kind == SPACE
        last = np.flatnonzero(space & cut[1:] & ~self.first[1:])  # the last white space before something else
        joins = last[self.points[last] == 32]
        cut[last] = True
        after = np.zeros(len(self.points), bool)
        after[joins + 1] = True
        self._contract(cut, after & (self.points == 39))
        cut[joins + 1] = False
        places = np.flatnonzero(cut)
        return places[:-1], places[1:]

    def word_level(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends for: ending | letters | one number | others; white space goes."""
        if not len(self.points):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = self._runs()
        self._contract(cut, np.zeros(len(self.points), bool))
        cut[:-1] |= self.kind == NUMBER
        places = np.flatnonzero(cut)
        kept = self.kind[places[:-1]] != SPACE
        return places[:-1][kept], places[1:][kept]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return segment_hashes(point_values()[self.points], starts, ends)

    def strings(self, starts: np.ndarray, ends: np.ndarray) -> list[str]:
        return [self.whole[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it is printable Latin-1, else
    the next free one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def spelled(piece: str, letters: list[str] = byte_alphabet()) -> str:
    """A piece in the byte alphabet."""
    return "".join([letters[b] for b in piece.encode("utf-8", "surrogatepass")])


_LETTERS = np.array([ord(x) for x in byte_alphabet()], np.uint32)


def all_spelled(pieces: list[str]) -> list[str]:
    """Each piece in the byte alphabet; all are spelled at once."""
    whole = "".join(pieces)
    raw = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
    letters = _LETTERS[raw].astype("<u4").tobytes().decode("utf-32-le")
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    if len(raw) > len(whole):  # from code points to bytes
        first = np.flatnonzero((raw & 0xC0) != 0x80)
        ends = np.append(first, len(raw))[ends]
    ends = ends.tolist()
    return [letters[s:e] for s, e in zip([0, *ends], ends)]


_WHITE = regex.compile(r"\p{White_Space}+")
_SIGMA = "Σ"


def normalised(text: str) -> str:
    """NFC, white space runs as one space, lower case by code point."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        text = _WHITE.sub(" ", text)
        # a capital sigma is lower-cased by itself, never as a word's last letter
        return text.replace(_SIGMA, "σ").lower()
    return re.sub(r"[\t-\r ]+", " ", text).lower()


def split_special(text: str, special: dict[str, int]) -> list[str | int]:
    """The text cut at special tokens: strings and ids, in order, leftmost first."""
    if not any(s in text for s in special):
        return [text]
    parts = re.split("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")", text)
    return [special.get(p, p) if i % 2 else p for i, p in enumerate(parts) if p]
