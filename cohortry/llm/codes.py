"""Words of texts as small numbers: chunks of documents, each with a dictionary of its own.

A chunk is what one task reads in a row, up to a bound. Its dictionary names
each different word once, so tables of words grow with chunks and words, not
with occurrences, and what the corpus says about a word is sent to a chunk once.
"""

from __future__ import annotations

from collections.abc import Iterator

SPACES = b" \t\n\x0b\x0c\r"


class Codes(dict):
    """Numbers words in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def slices(raw: bytes, stops: bytes = SPACES, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in parts of about `size` bytes, each cut before one of the stops."""
    at = 0
    while at < len(raw):
        end = at + size
        while end < len(raw) and raw[end] not in stops:
            end += 1
        yield raw[at:end]
        at = end
