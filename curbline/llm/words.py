"""Cuts texts where no pre-token of the byte-level pattern can cross, so that the parts can be cached."""

from __future__ import annotations

import re

# A space before white space or the end is not a safe place to cut.
_UNSAFE = re.compile(r" (?!\S)")
_SAFE = re.compile(r" (?=\S)")


def parts(text: str) -> list[str]:
    """The text split at every space that a non-space follows.

    The pattern starts a pre-token at each such space (letters, digits and
    punctuation take one leading space, and a run of white space gives its last
    one up), so pre-tokens of the whole text are those of its first part
    followed by those of a space plus each later part.
    """
    return _SAFE.split(text) if _UNSAFE.search(text) else text.split(" ")


class PartCache:
    """Encodings of parts. ``encode`` maps a list of strings to a list of values; at most ``limit``
    characters are remembered, so memory is bounded whatever the texts are."""

    def __init__(self, encode, limit: int = 6_000_000):
        self.encode, self.limit = encode, limit
        self.known: dict[str, object] = {}
        self.held = 0

    def values(self, text: str):
        """(value of the first part, an iterable of the values of the others)."""
        first, *rest = parts(text)
        head = self.encode([first])[0]
        known = self.known
        missing = list(set(rest).difference(known))
        if missing:
            size = sum(map(len, missing)) + 8 * len(missing)
            if self.held + size > self.limit:
                known.clear()
                self.held = 0
                missing = list(set(rest))
                size = sum(map(len, missing)) + 8 * len(missing)
            known.update(zip(missing, self.encode([" " + p for p in missing]), strict=True))
            self.held += size
        return head, map(known.__getitem__, rest)
