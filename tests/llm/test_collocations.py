"""Collocations and their filters against counting written out."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortry.llm import collocations, quotient_filter
from cohortry.llm.quotient_filter import Layout


@pytest.mark.parametrize("n", [2, 3, 4])
@pytest.mark.parametrize("bits", [1, 5, 16, 17, 32])
def test_filters_lose_nothing_and_merge(n, bits):
    """Whatever the bits of an id and the ranges, the entries of merged segments are the summed n-grams."""
    r = random.Random(n * 100 + bits)
    left_bits = bits * -(-n // 2)
    for range_bits in {0, min(1, left_bits), min(3, left_bits)}:
        layout = Layout(n, bits, range_bits, min(left_bits, max(range_bits, 10)))
        total, segments = Counter(), defaultdict(list)
        for chunk in range(3):
            own = Counter(tuple(r.randrange(min(1 << bits, 40)) + ((1 << bits) - 40 if bits > 5 else 0) for _ in range(n)) for _ in range(300))
            own[tuple([1] * n)] += 400
            total.update(own)
            grams = list(own)
            words = [np.array([g[k] for g in grams], np.uint32) for k in range(n)]
            left, right = layout.permuted(words)
            assert all(np.array_equal(a, b) for a, b in zip(layout.inverse(left, right), words, strict=True))
            order = quotient_filter.in_order(left, right, layout.right_bits, layout.left_bits)
            for row in layout.segments(chunk, left[order], right[order], np.array([own[g] for g in grams])[order]):
                segments[row[0]].append(dict(zip(quotient_filter.FILTER.names, row, strict=True)))
        found = Counter()
        for rows in segments.values():
            left, right, counts, which = layout.merged(rows)
            assert len(which) == sum(len(x["counts"]) for x in rows) and set(which.tolist()) == set(range(len(left)))
            for gram, c in zip(zip(*layout.inverse(left, right), strict=True), counts, strict=True):
                found[tuple(map(int, gram))] += int(c)
        assert found == total


def written_out(docs, least, covered, top):
    counts, totals = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        inside = Counter()
        for w, a in found.items():
            for n in range(2, len(w)):
                for i in range(len(w) - n + 1):
                    inside[w[i:i + n]] = max(inside[w[i:i + n]], a)
        rows = []
        for w, a in found.items():
            if 100 * inside[w] >= covered * a and w in inside:
                continue
            score, _, l, r = min((2000000 * a // (f[w[:k]] + f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
            rows.append((-score, -a, " ".join(w), l, r))
        rows.sort(key=lambda x: (x[0], x[1], x[2].encode()))
        out += [(lang, k + 1, x[2], -x[1], x[3], x[4], totals[lang], -x[0]) for k, x in enumerate(rows[:top])]
    return sorted(out)


def got(spark, docs, spec):
    frame = spark.createDataFrame([(*d, 1, "z") for d in docs], "lang string, text string, chunk int, words string").repartition(3)
    return sorted(map(tuple, collocations.collocations(frame, spec).collect()))


@pytest.mark.parametrize(("chunk", "entries", "top"), [(1_000_000, 500_000, 2000), (300, 40, 9)])
def test_collocations_equal_counting(spark, chunk, entries, top):
    r = random.Random(chunk)
    words = ["the", "The", "of", "New", "york", "a", "é", "state", "Ünit", "x1", "rare"]
    docs = []
    for k in range(160):
        text = "".join(r.choice(words[:-1] if r.random() < 0.99 else words) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " \r\n"]) for _ in range(r.randrange(60)))
        docs.append((r.choice(["en", "en", "de", None, "und"]), text + r.choice(["", "new york state of the a", " in the state of new york"])))
    docs += [("en", "one line that many texts share here")] * 80 + [("en", None), (None, ""), ("fr", "once only"), ("xx", " . , ")]
    spec = collocations.CollocationSpec(least=5, chunk=chunk, entries=entries, top=top)
    want = written_out(docs, 5, 80, top)
    assert len(want) > 20 and got(spark, docs, spec) == want


def test_edges(spark):
    """Nothing frequent, an empty table, a very long text cut in slices, ties, and words with odd characters."""
    spec = collocations.CollocationSpec(least=5)
    assert got(spark, [("en", "a b c"), (None, None)], spec) == []
    assert got(spark, [], spec) == []
    docs = [("en", "ab cd " * 400_000 + "."), ("de", "\x00 \x1c ª\xa0b " * 9), ("es", "p q. r s. " * 7), (None, "A\x0bB a b! " * 6)]
    assert got(spark, docs, spec) == written_out(docs, 5, 80, 2000)
