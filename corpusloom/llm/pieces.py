"""Cuts of a text that no byte-level BPE pre-token can cross.

The split pattern of the vocabularies in use never matches white space after
anything that is not white space: a space may only open a match, or belong to
a run of white space.  So wherever an ASCII blank follows a character that is
not white space, a match ends, whatever stands further left; and what follows
is split as if the text began there.  Encoding the pieces one by one therefore
gives the tokens of the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_PIECES = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
#: White space of any kind but the four blanks above: texts with it are not cut.
_ODD_SPACE = re.compile(r"[^\S \t\r\n]|[\x1c-\x1f\x85]")


def cut(text: str) -> list[str]:
    """The pieces of a text, in order; the whole text if a cut could be unsound."""
    if _ODD_SPACE.search(text):
        return [text]
    return _PIECES.findall(text)


class Memo(dict):
    """A dict that computes what it lacks and holds a bounded number of characters.

    At half of the bound what is held becomes old.  What is asked for again
    moves from there to the new half; the rest goes when that is full too.
    """

    def __init__(self, compute: Callable, max_chars: int = 20_000_000):
        super().__init__()
        self._compute, self._half = compute, max_chars // 2
        self._left, self._old = self._half, {}

    def __missing__(self, key: str):
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
        if len(key) <= 256:
            self._left -= len(key) + 100
            if self._left < 0:
                self._old = dict(self)
                self.clear()
                self._left = self._half
            self[key] = value
        return value
