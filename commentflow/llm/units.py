"""Encoding of texts by the distinct units they are made of.

Tokenizers that split texts in front of a blank which follows no other white space give every such unit the same ids
wherever it stands. So a text is cut at these blanks, each distinct unit is encoded once by the tokenizer itself, and
the ids of a text are joined from what is kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np

#: White space that is rare in texts, by its numbers, with the mark that stands for a blank in some vocabularies.
_RARE = "".join(chr(c) for c in (*range(0x0B, 0x0D), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x2581, 0x3000))
_ODD, _CUT = re.compile(f"[{_RARE}]"), re.compile(f"(?<=[^ \\t\\n\\r{_RARE}]) ")


def cut(text: str) -> list[str]:
    """The text cut at every blank that does not follow white space; these blanks are left out."""
    plain = "  " not in text and "\n " not in text and "\t " not in text and "\r " not in text and not _ODD.search(text)
    return text.split(" ") if plain else _CUT.split(text)


class Units:
    """Ids of texts as little-endian 32-bit numbers.

    ``one`` gives the ids of the unit at the front of a text, ``many`` those of units that begin with a blank. Two
    generations of at most ``most`` units are kept, of units up to ``short`` characters."""

    def __init__(
        self, one: Callable[[str], Sequence[int]], many: Callable[[list[str]], Sequence[Sequence[int]]], most: int = 1 << 17, short: int = 48,
    ):
        self._one, self._many, self._most, self._short = one, many, most, short
        #: Units that follow a blank, without it, and those at the front of a text.
        self._after: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._front: dict[str, bytes] = {"": b""}

    def join(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text."""
        parts = [cut(text) for text in texts]
        fronts = [units[0] for units in parts]
        for units in parts:
            units[0] = None
        known = self._after
        new = set().union(*parts).difference(known)
        new.discard(None)
        for unit in [u for u in new if u in self._older]:
            known[unit] = self._older[unit]
            new.discard(unit)
        if new:
            fresh = list(new)
            known.update((u, np.asarray(ids, dtype="<i4").tobytes()) for u, ids in zip(fresh, self._many([" " + u for u in fresh])))
        out = []
        for front, units in zip(fronts, parts):
            known[None] = self._front.get(front)
            if known[None] is None:
                known[None] = self._front[front] = np.asarray(self._one(front), dtype="<i4").tobytes()
            out.append(b"".join(map(known.__getitem__, units)))
        for unit in new:
            if len(unit) > self._short:
                del known[unit]
        if len(self._front) > self._most // 8:
            self._front = {"": b""}
        if len(known) > self._most:
            self._after, self._older = {}, known
        return out
