"""Language-model scores against sums over all segmentations written out."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortry.llm import lattice, queries, scoring

SPEC = scoring.ScoreSpec(queries.piece_bpe())


@pytest.fixture(scope="module")
def own():
    return lattice.lattice(SPEC.vocabulary)


def segmentations(own, text):
    """Every way to write text as pieces, bytes where a character is no piece."""
    if not text:
        yield []
        return
    at = {p: k for k, p in enumerate(own.pieces)} if not hasattr(own, "at") else own.at
    own.at = at
    for size in range(1, min(own.longest, len(text)) + 1):
        head = text[:size]
        if head in at:
            ids = [at[head]]
        elif size == 1:
            ids = [own.bytes_at + b for b in head.encode()]
        else:
            continue
        for rest in segmentations(own, text[size:]):
            yield ids + rest


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abeinrst▁é🙂ゼ0'"), min_size=1, max_size=9), min_size=1, max_size=6))
def test_forward_and_expected_counts_cover_all_segmentations(own, words):
    weights = own.first
    logs = own.log_words(words, weights)
    counts = np.arange(1.0, len(words) + 1)
    want = np.zeros(len(weights))
    for k, word in enumerate(words):
        ways = list(segmentations(own, lattice.MARK + word))
        each = [math.exp(sum(weights[i] for i in ids)) for ids in ways]
        assert logs[k] == pytest.approx(math.log(sum(each)), rel=1e-9)
        for ids, p in zip(ways, each, strict=True):
            for i in ids:
                want[i] += counts[k] * p / sum(each)
    assert own.expected(words, counts, weights) == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_words_are_alone_whatever_their_block(own, monkeypatch):
    words = ["a" * k + "ß" for k in range(60)] + ["x", "🙂" * 3000]
    whole = own.log_words(words, own.first)
    monkeypatch.setattr(lattice, "CELLS", 50)
    assert own.log_words(words, own.first) == pytest.approx(whole)
    assert whole[-1] < -10000 and math.isfinite(whole[-1])


def text_scores(docs, rows):
    """Base columns written out; and the weights fitted to the same counts."""
    counts, n_ends = Counter(), 0
    words = [(t or "").encode().lower().split() for _, t in docs]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    for w, out in zip(words, held, strict=True):
        if not out:
            counts.update(w)
            n_ends += 1
    n, v = sum(counts.values()) + n_ends, len(counts) + (n_ends > 0)
    base = lambda c: math.log10((c + 1) / (n + v + 1))
    return [
        (i, out, len(w) + 1, sum(counts[x] > 0 for x in w) + (n_ends > 0), n, sum(base(counts[x]) for x in w) + base(n_ends))
        for (i, _), out, w in zip(docs, held, words, strict=True)
    ], counts, n_ends


def check(spark, own, docs):
    frame = spark.createDataFrame([(*d, 3, "z") for d in docs], "doc_id bigint, text string, held int, chunk string")
    got = scoring.scored(frame.repartition(3), SPEC).collect()
    want, counts, ends = text_scores(docs, got)
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    names = [w.decode() for w in counts]
    weights = own.first
    for _ in range(SPEC.rounds):
        mass = SPEC.prior * np.exp(own.first)
        if names:
            mass += own.expected(names, np.array(list(counts.values()), float), weights)
        mass[own.end] += ends
        weights = np.log(mass / mass.sum())
    texts = sorted(docs, key=lambda d: key((d[0], None, len((d[1] or "").encode().lower().split()) + 1, 0, 0, 0))[:3])
    for text_row, row in zip(texts, sorted(got, key=lambda g: key((g[0], None, g[2], 0, 0, 0))[:3]), strict=True):
        words = [w.decode() for w in (text_row[1] or "").encode().lower().split()]
        log = sum(own.log_words(words, weights).tolist()) + weights[own.end] if words else weights[own.end]
        assert row[6] == pytest.approx(log / math.log(10), rel=1e-6)


def test_scores_equal_the_formulas(spark, own, monkeypatch):
    docs = [(k, f"The cat {k % 7} sat\non the\x0bmat No. {'É' * (k % 3)} " + "dog " * k) for k in range(40)]
    check(spark, own, docs)


def test_edges(spark, own):
    """Null ids and texts, empty and blank texts, repeated rows, one very long word, and a long text."""
    docs = [(1, None), (2, ""), (None, "a b"), (3, " \t\n "), (4, "x y"), (4, "x y"), (5, "\x00 \x1c"), (6, "q" * 20000), (7, "lo ng " * 300000)]
    check(spark, own, docs)


def test_without_training_rows(spark, own):
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    check(spark, own, [(k, "some words") for k in held])
