"""Token ids of whole texts, by the tokenizers and sentencepiece vocabularies.

Both encoders look texts up piece by piece: a piece is what lies between two
places where no token can reach across, and each distinct piece is encoded by
the library once for a worker. Real text repeats its pieces, so this gives the
library's own ids many times faster than passing it whole texts.
"""

from __future__ import annotations

import gc
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN = 700_000  # distinct pieces a worker remembers; then it starts anew
KNOWN_IDS = 8_000_000  # and their ids
GROUP = 1 << 22  # bytes of texts that are cut into pieces together


class PieceTable:
    """Ids of pieces in one growing array, found by a dictionary. encode gives new pieces' ids, one after another, and their numbers."""

    def __init__(self, encode) -> None:
        self._encode = encode
        self._clear()

    def _clear(self) -> None:
        self._place: dict[str | bytes, int] = {}
        self._bounds, self._ids = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def _learn(self, pieces: list) -> None:
        place = self._place
        fresh = list(dict.fromkeys(filterfalse(place.__contains__, pieces)))
        if not fresh:
            return
        flat, sizes = self._encode(fresh)
        self._bounds = np.concatenate([self._bounds, self._bounds[-1] + np.cumsum(sizes, dtype=np.int64)])
        self._ids = np.concatenate([self._ids, np.array(flat, np.uint32)])
        place.update(zip(fresh, range(len(place), len(place) + len(fresh)), strict=True))

    def places(self, pieces: list) -> np.ndarray:
        """The pieces' numbers, until the next call."""
        if len(self._place) > KNOWN or len(self._ids) > KNOWN_IDS:
            self._clear()
        self._learn(pieces)
        return np.fromiter(map(self._place.__getitem__, pieces), np.int64, len(pieces))

    def gathered(self, at: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """The ids of each text, whose pieces' numbers in `at` end at `ends`."""
        sizes = self._bounds[at + 1] - self._bounds[at]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        flat = self._ids[np.repeat(self._bounds[at] - stops[:-1], sizes) + np.arange(stops[-1])]
        cuts = stops[ends]
        return [flat[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def ids(self, pieces: list, ends: np.ndarray) -> list[np.ndarray]:
        """The ids of each text, whose pieces end at ends."""
        return self.gathered(self.places(pieces), ends) if len(ends) else []


# Classes of characters in the file's pattern, by bytes.
_SPACE, _BLANK, _LETTER, _DIGIT, _OTHER, _APART = range(6)


def _class_of(character: str) -> int:
    kind = unicodedata.category(character)
    if kind == "Cn" or character.isspace():
        return _APART
    return {"L": _LETTER, "N": _DIGIT}.get(kind[0], _OTHER)


_CLASS = np.full(256, _APART, np.uint8)
_CLASS[:128] = [_class_of(chr(b)) for b in range(128)]
_CLASS[[9, 10, 11, 12, 13]], _CLASS[32] = _BLANK, _SPACE
#: U+0080 to U+047F, by the low bits of both bytes.
_PAIRS = np.array([_class_of(chr(c)) if c >= 128 else _APART for c in range(0x480)], np.uint8).reshape(-1, 64)
_SHORT = np.isin(np.arange(256), list(b"stmd"))
_CUT = re.compile(rb"[!-~] ")
_AFTER_SPACE = re.compile(r"\s ")


def _classes(raw: np.ndarray) -> np.ndarray:
    """Each byte's class; all bytes of a character have the same. _APART where it isn't told here."""
    c = _CLASS[raw]
    lead = np.flatnonzero(raw >= 0xC2)
    if len(lead):
        first, second = raw[lead], raw[lead + 1]
        kind = np.full(len(lead), _APART, np.uint8)
        two = first < 0xD2
        kind[two] = _PAIRS[first[two] & 31, second[two] & 63]
        three = np.flatnonzero((first == 0xE2) & (second == 0x80))
        third = raw[lead[three] + 2]
        kind[three[(third >= 0x90) & (third <= 0xA7)]] = _OTHER  # dashes, quotation marks, dots
        c[lead], c[lead + 1] = kind, kind
        c[lead[three] + 2] = kind[three]
    return c


def token_starts(raw: np.ndarray, c: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin in texts of known classes; begins: where texts begin.

    The pattern takes one contraction, or a run of letters, digits or other
    characters with one space before it, or white space; of several white-space
    characters before something else the last stands apart, and if that is a
    space it belongs to what follows.
    """
    begin = np.zeros(len(raw) + 1, bool)
    begin[begins] = True
    begin[-1] = True
    blank = c <= _BLANK
    run = np.where(blank, _BLANK, c)
    start = begin[:-1].copy()
    start[1:] |= run[1:] != run[:-1]
    tail = blank & ~begin[1:]
    tail[:-1] &= ~blank[1:]
    start |= tail
    start[np.flatnonzero(tail & (raw == 32)) + 1] = False
    # A mark that begins a match and one of s, t, m, d, re, ve, ll.
    at = np.flatnonzero((raw == 39) & start & ~begin[1:])
    at = at[c[at + 1] == _LETTER]
    one = raw[at + 1]
    more = ~begin[at + 2]
    two = np.where(more, raw[np.minimum(at + 2, len(raw) - 1)], 0)
    short = _SHORT[one]
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    at, size = at[short | long], np.where(short, 2, 3)[short | long]
    start[at + 1] = False
    end = at + size
    end = end[~begin[end]]
    start[end[c[end] == _LETTER]] = True
    return start


def _visible_bytes() -> dict[int, str]:
    """How byte-level files write bytes: printable ones as they are, the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def _is_byte_level(path: str) -> bool:
    """Whether the file cuts texts by the byte-level pattern alone, and merges without exceptions."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    cut, model = parts.get("pre_tokenizer") or {}, parts["model"]
    return (
        parts.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and all(t.get("special") for t in parts.get("added_tokens", []))
    )


class ByteLevel:
    """A BPE file of the tokenizers library; its marker strings in a text are ordinary text.

    A byte-level file's pattern is found on arrays of bytes, for a group of texts
    at once, and each distinct match goes to the library's merges once. A text
    with a character whose class isn't told here is cut before spaces that
    follow something else than white space, where no token reaches across, and
    each distinct piece goes through the library's whole pipeline. With a file
    that cuts texts in another way all texts go to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark fills the cores
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True
        self._cuts = _is_byte_level(path)
        self._merge, self._shown = self._library.model.tokenize, _visible_bytes()
        self._matches, self._table = PieceTable(self._merged), PieceTable(self._pieces)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._library.encode_batch(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        found = self.whole(pieces)
        return [i for ids in found for i in ids], [len(ids) for ids in found]

    def _merged(self, matches: list[bytes]) -> tuple[list[int], list[int]]:
        flat, sizes, merge, shown = [], [], self._merge, self._shown
        for match in matches:
            ids = [t.id for t in merge(match.decode("latin1").translate(shown))]
            flat += ids
            sizes.append(len(ids))
        return flat, sizes

    def batch(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        """The ids of each whole text; none for a null one."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        on = gc.isenabled()
        gc.disable()  # many small objects live on, none in a cycle
        try:
            out: list[np.ndarray] = []
            for group in groups(texts):
                long = len(group) == 1 and (group[0].as_py() or "").encode()
                if long and len(long) > 2 * GROUP and self._cuts:
                    out.append(np.concatenate([self._group(pa.array([part.decode()]))[0] for part in _parts(long)]))
                else:
                    out += self._group(group)
            return out
        finally:
            if on:
                gc.enable()

    def _group(self, texts: pa.Array) -> list[np.ndarray]:
        if not self._cuts:
            return [np.array(ids, np.uint32) for ids in self.whole([t or "" for t in texts.to_pylist()])]
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        raw, begins, c = _bytes_of(texts)
        apart = np.unique(np.searchsorted(begins, np.flatnonzero(c == _APART), "right") - 1)
        if not len(apart):
            return self._matched(raw, begins, c)
        told = np.setdiff1d(np.arange(len(texts)), apart)
        out: list = [None] * len(texts)
        for k, ids in zip(told, self._matched(*_bytes_of(texts.take(pa.array(told)))), strict=True):
            out[k] = ids
        for k, ids in zip(apart, self._mixed([t.decode() for t in texts.take(pa.array(apart)).to_pylist()]), strict=True):
            out[k] = ids
        return out

    def _matched(self, raw: np.ndarray, begins: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
        if not len(raw):
            return [np.empty(0, np.uint32)] * len(begins)
        starts = np.flatnonzero(token_starts(raw, c, begins[begins < len(raw)]))
        offsets = np.append(starts, len(raw)).astype(np.int32)
        matches = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        places = self._matches.places(matches.dictionary.to_pylist())[matches.indices.to_numpy()]
        return self._matches.gathered(places, np.append(np.searchsorted(starts, begins[1:]), len(starts)))

    def _mixed(self, texts: list[str]) -> list[np.ndarray]:
        pieces: list[str] = []
        ends, apart = [], {}
        for i, text in enumerate(texts):
            if _AFTER_SPACE.search(text):
                apart[i] = text
            else:
                first, *rest = text.split(" ")
                pieces.append(first)
                pieces += [" " + x for x in rest]
            ends.append(len(pieces))
        found = self._table.ids(pieces, np.array(ends, np.int64))
        for i, ids in zip(apart, self.whole(list(apart.values())), strict=True):
            found[i] = np.array(ids, np.uint32)
        return found


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes one after another, where each begins, and classes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(texts) else np.empty(0, np.uint8)
    return raw, offsets[:-1] - offsets[0], _classes(raw)


def _parts(raw: bytes) -> Iterator[bytes]:
    """A long text in parts of about GROUP bytes, cut before a space that follows a visible ASCII character."""
    at = 0
    while at < len(raw):
        cut = _CUT.search(raw, at + GROUP)
        end = cut.start() + 1 if cut else len(raw)
        yield raw[at:end]
        at = end


def groups(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive texts of about GROUP bytes; a longer one comes alone."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + GROUP, "right")))
        yield texts.slice(at, end - at)
        at = end


@lru_cache(maxsize=4)
def byte_level(path: str) -> ByteLevel:
    """One for each worker and file."""
    return ByteLevel(path)


def in_groups(batch: pa.RecordBatch, rows: int = 256, size: int = 1 << 21) -> Iterator[tuple[list, list]]:
    """Columns 0 and 1 of a batch, some rows and about `size` characters at a time."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        text = text.as_py()
        ids.append(doc_id)
        texts.append(text)
        held += len(text or "")
        if len(ids) == rows or held >= size:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def encoded(batch: pa.RecordBatch, encoder: ByteLevel) -> Iterator[tuple[int | None, np.ndarray]]:
    """Column 0 of a batch with the ids of column 1's texts, row by row."""
    at = 0
    for group in groups(batch.column(1)):
        yield from zip(batch.column(0).slice(at, len(group)).to_pylist(), encoder.batch(group), strict=True)
        at += len(group)
