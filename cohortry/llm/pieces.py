"""SentencePiece models on the tokenizers library.

The model file is read as it is: pieces with scores and kinds, the normaliser's
settings and character map, the model's type. From these the tokenizer is
rebuilt: normaliser, marker for spaces, unigram scores or merges in the order of
the scores, byte fallback, decoder. Every new stretch of text that a worker
encodes is also decoded, and given to the sentencepiece library, whose ids are
compared; the ids returned are those of the rebuilt tokenizer.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.tokens import PieceTable, in_groups

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2


def _number(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (raw[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if raw[at - 1] < 128:
            return value, at


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protobuf message."""
    at = 0
    while at < len(raw):
        key, at = _number(raw, at)
        kind = key & 7
        if kind == 0:
            value, at = _number(raw, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _number(raw, at)
            value, at = raw[at:at + size], at + size
        yield key >> 3, value


@dataclass(frozen=True)
class PieceModel:
    pieces: tuple[tuple[str, float, int], ...]
    kind: int
    byte_fallback: bool
    character_map: bytes
    add_prefix: bool
    squeeze: bool


def parse(raw: bytes) -> PieceModel:
    pieces, trainer, normaliser = [], {}, {}
    for field, value in _fields(raw):
        if field == 1:
            entry = dict(_fields(value))
            pieces.append((entry[1].decode(), struct.unpack("<f", entry.get(2, b"\0\0\0\0"))[0], entry.get(3, NORMAL)))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normaliser = dict(_fields(value))
    return PieceModel(
        tuple(pieces), trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), normaliser.get(2, b""),
        bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)),
    )


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """All ways to put a piece together from two others, best score first."""
    usable = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER)}
    found = [
        (-score, k, (piece[:at], piece[at:]))
        for k, (piece, score, kind) in enumerate(model.pieces) if kind == NORMAL
        for at in range(1, len(piece)) if piece[:at] in usable and piece[at:] in usable
    ]
    return [pair for _, _, pair in sorted(found, key=lambda x: x[:2])]


def rebuilt(model: PieceModel):
    """The tokenizers library's form of the model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = next(k for k, p in enumerate(model.pieces) if p[2] == UNKNOWN)
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    else:
        core = models.BPE(
            vocab={p: k for k, (p, _, _) in enumerate(model.pieces)}, merges=_merges(model),
            unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.character_map)] if model.character_map else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(MARK)] if model.add_prefix else []
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence([*back, decoders.Strip(" ", 1, 0)] if model.add_prefix else back)
    return tokenizer


_TOGETHER = re.compile(f"[ {MARK}][ {MARK}]|^[ {MARK}]|[ {MARK}]$")


class JudgedTable(PieceTable):
    """Ids of stretches, with two marks for each: that the libraries differ on it, and that decoding gives it back."""

    def _clear(self) -> None:
        super()._clear()
        self.differs, self.restored = np.empty(0, bool), np.empty(0, bool)

    def mark(self, differs: list[bool], restored: list[bool]) -> None:
        self.differs, self.restored = np.append(self.differs, differs), np.append(self.restored, restored)


class Pieces:
    """Encodes and decodes by a model file, in batches on the library's threads.

    No piece has the marker after another character, so no token reaches across
    a single space: stretches between single spaces are encoded, decoded and
    compared once. Texts in which spaces meet, or with a character map, are one
    stretch. `apart` counts stretches on which the sentencepiece library differs.
    """

    def __init__(self, path: str, threads: int = 2) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        with open(path, "rb") as file:
            self.model = parse(file.read())
        self._library = rebuilt(self.model)
        self._judge = sentencepiece.SentencePieceProcessor(model_file=path)
        self._threads = threads
        inner = any(MARK in p.lstrip(MARK) for p, _, kind in self.model.pieces if kind == NORMAL)
        self._split = not inner and not self.model.character_map and self.model.add_prefix and not self.model.squeeze
        self._table = JudgedTable(self._learn)
        self.checked = self.apart = 0

    def whole(self, texts: list[str]) -> list[list[int]]:
        """Without the check."""
        return [x.ids for x in self._library.encode_batch(texts, add_special_tokens=False)]

    def _judged(self, texts: list[str]) -> tuple[list[list[int]], list[bool], list[bool]]:
        """Own ids, on which texts the other library differs, and which ones decoding gives back."""
        own, other = self.whole(texts), self._judge.encode(texts, num_threads=self._threads)
        differs = [a != b for a, b in zip(own, other, strict=True)]
        back = self._library.decode_batch(own, skip_special_tokens=False)
        self.checked += len(texts)
        self.apart += sum(differs)
        return own, differs, [a == b for a, b in zip(back, texts, strict=True)]

    def _learn(self, stretches: list[str]) -> tuple[list[int], list[int]]:
        found, differs, restored = self._judged(stretches)
        self._table.mark(differs, restored)
        return [i for ids in found for i in ids], [len(ids) for ids in found]

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each whole text; none for a null one."""
        return [x[0] for x in self.judged(texts)]

    def judged(self, texts: list[str | None]) -> list[tuple[np.ndarray, int, bool]]:
        """Each text's ids, on how many of its stretches the libraries differ, and whether decoding gives it back."""
        stretches: list[str] = []
        ends, apart = [0], {}
        for i, text in enumerate(texts):
            if text and (not self._split or _TOGETHER.search(text)):
                apart[i] = text
            elif text:
                stretches += text.split(" ")
            ends.append(len(stretches))
        table = self._table
        at, stops = table.places(stretches), np.array(ends, np.int64)
        sums = [np.concatenate([[0], np.cumsum(marks[at])]) for marks in (table.differs, ~table.restored)]
        differ, lost = (x[stops[1:]] - x[stops[:-1]] for x in sums)
        found = [(ids, int(d), not n) for ids, d, n in zip(table.gathered(at, stops[1:]) if texts else [], differ, lost, strict=True)]
        for i, ids, d, back in zip(apart, *self._judged(list(apart.values())), strict=True):
            found[i] = np.array(ids, np.uint32), int(d), back
        return found

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self._library.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)


@lru_cache(maxsize=2)
def pieces(path: str, threads: int) -> Pieces:
    return Pieces(path, threads)


def _encode(path: str, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path, threads)
        for batch in batches:
            for ids, texts in in_groups(batch):
                found = own.judged(texts)
                yield pa.record_batch([
                    pa.array(ids, pa.int64()), pa.array([x[0].astype("<u4").tobytes() for x in found], pa.binary()),
                    pa.array([x[2] for x in found], pa.bool_()), pa.array([x[1] for x in found], pa.int64()),
                ], names=["doc_id", "ids", "restored", "differences"])

    return run


def encode(docs: DataFrame, path: str, threads: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, restored, differences) of every row.

    ids are the rebuilt tokenizer's, as little-endian unsigned 32-bit numbers;
    restored says that decoding gives the text back; differences counts the
    text's stretches on which the two libraries disagree. A null or empty text has no ids and is
    restored; a text that holds the marker character itself isn't. Repeated
    rows come back each; other columns aren't read; an empty table gives an
    empty result.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encode(path, threads), "doc_id bigint, ids binary, restored boolean, differences bigint")


def _decode(path: str, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(path, threads)
        for batch in batches:
            ids = [np.frombuffer(x or b"", "<u4") for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(own.decode(ids), pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, path: str, threads: int = 2) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids), repeated ones each.

    Null ids, or none, give an empty text; a null doc_id stays null. Other columns
    aren't read; an empty table gives an empty result.
    """
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path, threads), "doc_id bigint, text string")
