"""Texts cut into chunks that a byte-level BPE pattern never matches across.

The patterns used here start a match at a space or inside a word: no
alternative holds a non-space character followed by a space. So a text may be
cut before each ``U+0020`` that follows a non-space character, and each chunk
encoded alone. Chunks repeat a lot, so their encodings are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_UNSAFE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


class ChunkCache:
    """``encode_many`` maps chunks to entries; ``of_texts`` gives those of each text.

    Keeps two generations of ``size`` entries: when the young one is full it
    becomes the old one, so frequent chunks stay. Chunks over ``longest``
    characters are not kept, so memory is bounded.
    """

    def __init__(self, encode_many: Callable[[list[str]], list], size: int = 250_000, longest: int = 48):
        self.encode_many, self.size, self.longest = encode_many, size, longest
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def of_texts(self, texts: list[str]) -> list[list]:
        """A list of entries for each text, in order."""
        firsts, rests = [], []
        for text in texts:
            first, rest = _cut(text)
            firsts.append(first)
            rests.append(rest)
        young, old = self.young, self.old
        need = set()
        for rest in rests:
            need.update(rest)
        need.difference_update(young)
        if need:
            new = []
            for c in need:
                if c in old:
                    young[c] = old[c]
                else:
                    new.append(c)
            young.update(zip(new, self.encode_many([" " + c for c in new])))
        heads = iter(self.encode_many([f for f in firsts if f]))
        out = [([next(heads)] if first else []) + list(map(young.__getitem__, rest))
               for first, rest in zip(firsts, rests)]
        for c in [c for c in need if len(c) > self.longest]:
            del young[c]
        if len(young) > self.size:
            self.old, self.young = young, {}
        return out


def _cut(text: str) -> tuple[str, list[str]]:
    """The chunk at the start, and the others without the space that each begins with."""
    if not _UNSAFE.search(text):
        first, *rest = text.split(" ")
        return first, (rest if text else [])
    chunks = _CUT.split(text)
    if text[0] == " ":
        return "", [c[1:] for c in chunks]
    return chunks[0], [c[1:] for c in chunks[1:]]
