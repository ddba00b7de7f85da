"""Cuts texts into pieces that a byte-level pre-tokenizer would split alike, and remembers each piece's ids.

A piece starts at a space, at a line feed, or after a line feed, where the white space stands alone between two other
characters. No match of the pre-tokenizer's pattern spans such a place, and none looks behind, so the ids of a text are
those of its pieces joined. Most pieces of a corpus repeat, so each is encoded once per worker and block of texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
#: White space other than a space or line feed, runs of white space, and the mark: such texts are cut by _BOUNDARY.
_IRREGULAR = ("\0", "  ", "\n\n", " \n", "\n ", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
#: Characters of texts cut at a time, characters whose new pieces are encoded together, and pieces remembered at most.
SLICE_CHARS, BLOCK_CHARS, MOST_PIECES = 1_000_000, 6_000_000, 250_000


def irregular(text: str) -> bool:
    return any(x in text for x in _IRREGULAR)


def mark(text: str) -> str:
    """A text that isn't irregular, with a mark between its pieces."""
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0")


def cut(text: str) -> list[str]:
    return _BOUNDARY.split(text) if irregular(text) else mark(text).split("\0")


def runs(texts: list[str], chars: int):
    """(from, to) of runs of texts of about so many characters; a longer text is a run of its own."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > chars:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


class PieceEncoder:
    """encode(pieces) gives the ids of each piece, as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode = encode
        self.known: dict[str, bytes] = {}

    def texts(self, texts: list[str]):
        """Yields the ids of each text, whole, in order."""
        for first, last in runs(texts, BLOCK_CHARS):
            if len(self.known) > MOST_PIECES:
                self.known.clear()
            known, new = self.known, set()
            for a, b in runs(texts[first:last], SLICE_CHARS):
                here = set()
                for t in texts[first + a : first + b]:
                    here.update(cut(t))
                new |= here.difference(known.keys())
            learn = list(new)
            known.update(zip(learn, self.encode(learn), strict=True))
            for t in texts[first:last]:
                yield b"".join(map(known.__getitem__, cut(t)))
