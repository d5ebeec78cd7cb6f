"""Operators that SQL can't express, against brute force, round trips and held-out labels."""

from __future__ import annotations

import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortry.llm import license_scan, packing, pieces, quality_classifier, quality_rules, queries, sharding
from cohortry.llm import token_store, tokens, url_filter, vector_dedup, wordhash

AWKWARD = st.lists(st.sampled_from([*" \n\t'sadDéß1.,|<>!　\x1c\x85▁🙂", "  ", "<|endoftext|>", " the", "x.\nYes"]), max_size=12).map("".join)


def test_words_are_hashed_alike_wherever_blocks_end(monkeypatch):
    r = random.Random(1)
    texts = ["".join(r.choice("abcAB \n\té") for _ in range(r.randrange(300))) for _ in range(80)] + ["", None, "x" * 999]
    whole = wordhash.shingle_sets(pa.array(texts))
    monkeypatch.setattr(wordhash, "BLOCK", 50)
    parts = wordhash.shingle_sets(pa.array(texts))
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))
    for text, found in zip(texts, whole, strict=True):
        words = (text or "").replace("A", "a").replace("B", "b").split()
        assert len(found) == len({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}) * bool(words)


# Sharding


def sharded(df):
    return [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in df.collect()]


def test_shards_are_balanced_and_keep_groups(spark):
    r = random.Random(2)
    texts = ["w" * int(r.paretovariate(1.2) * 40) + str(k) for k in range(4000)] + ["copy"] * 300 + ["copied text"] * 3000
    rows = sharded(sharding.shard(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")))
    assert sorted(x[0] for x in rows) == list(range(len(texts)))
    assert all(x[1] == len(texts[x[0]]) + 1 and x[2] == zlib.crc32(texts[x[0]].encode()) for x in rows)
    sums, counts = Counter(), Counter()
    for _, size, _, shard, _ in rows:
        sums[shard] += size
        counts[shard] += 1
    assert max(sums.values()) < 1.02 * min(sums.values()) and max(counts.values()) < 1.25 * min(counts.values())
    for shard in range(16):
        assert sorted(x[4] for x in rows if x[3] == shard) == list(range(counts[shard]))
    assert len({x[3] for x in rows if texts[x[0]] == "copy"}) == 1
    assert len({x[3] for x in rows if texts[x[0]] == "copied text"}) > 1  # more than a shard holds


def test_shard_edges(spark):
    rows = [(1, None), (None, ""), (1, None), (None, "é"), (2, "é")]
    docs = spark.createDataFrame([(*r, 9, "z") for r in rows], "doc_id bigint, text string, shard int, size string")
    got = sharded(sharding.shard(docs, sharding.ShardSpec(shards=2)))
    assert sorted((x[1], x[2]) for x in got) == sorted([(1, 0)] * 3 + [(3, zlib.crc32("é".encode()))] * 2)
    for shard in {x[3] for x in got}:
        slots = sorted(x[4] for x in got if x[3] == shard)
        assert slots == list(range(len(slots)))


# Licences and urls


def test_licence_rules_take_long_notices_first(spark):
    notice = (
        "Licensed under the Apache License, Version 2.0 (the License).\nyou may not use this file except in compliance with the License! "
        "Some other words.\nYou may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    )
    rows = [(1, notice + ".\nReleased under the MIT License."), (2, "licensed  UNDER cc-by 4.0\nno"), (3, None), (None, ""), (4, "the mit license")]
    got = {r.doc_id: (r.sentence_ids, r.licences) for r in license_scan.licences(spark.createDataFrame([(*r, "q") for r in rows], "doc_id bigint, text string, licences string")).collect()}
    assert got == {
        1: (["apache2-defined", "apache2-comply", "apache2-copy", "mit-under"], ["Apache-2.0", "MIT"]),
        2: (["ccby4-under"], ["CC-BY-4.0"]), 3: ([], []), None: ([], []), 4: ([], []),
    }


WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\n'
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE\nAUTHORS BE LIABLE."
)
BSD = (
    "Copyright (c) 2020, The Authors\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n"
)
CLAUSE_3 = (
    "3. Neither the name of {} nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n\n"
)
CC = "This work is licensed under\na Creative Commons Attribution{} 4.0\nInternational License."
#: Notices as they are published, with the licences they give.
NOTICES = (
    ("Apache-2.0", (
        'Copyright 2020 The Authors\n\nLicensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\n'
        "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software"
    )),
    ("MIT", (
        "MIT License\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\n" + WARRANTY
    )),
    ("GPL-3.0-or-later", (
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
        "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope"
    )),
    ("BSD-2-Clause", BSD), ("BSD-3-Clause", BSD + CLAUSE_3.format("the copyright holder")), ("BSD-3-Clause", BSD + CLAUSE_3.format("Foo Institute of\n   Technology")),
    ("CC-BY-4.0", CC.format("")), ("CC-BY-NC-4.0", CC.format("-NonCommercial")), ("CC-BY-SA-4.0", CC.format("-ShareAlike")),
    ("GPL-3.0-only", "This work is licensed under the GNU General\nPublic License, version 3."), ("Proprietary", "Copyright 2020 Foo.\nAll rights\nreserved."),
    *[
        (found, (
            f"This {work} is free software{mark} you can redistribute it and/or\nmodify it under the terms of the GNU {licence}\n"
            f"License as published by the Free Software Foundation{comma} either\nversion {version} of the License, or (at your option) any later version.\n\nThis {work} is distributed in the hope"
        ))
        for found, work, licence, version, mark, comma in (
            ("GPL-2.0-or-later", "program", "General Public", "2", ";", ";"), ("LGPL-2.1-or-later", "library", "Lesser General Public", "2.1", ";", ";"),
            ("LGPL-3.0-or-later", "program", "Lesser General Public", "3", ":", ","), ("AGPL-3.0-or-later", "program", "Affero General Public", "3", ":", ","),
        )
    ],
    ("MPL-2.0", (
        "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."
    )),
    ("ISC", (
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED"
    )),
    ("Zlib", (
        "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\n"
        "including commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin"
    )),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright\nand related and neighboring rights to this software to the public domain\nworldwide."),
    ("EPL-2.0", (
        "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/\n\nContributors: us"
    )),
    ("MIT", "# Tool.\nReleased under\nthe MIT License."), ("Apache-2.0", "Licensed under the Apache\nLicense, Version 2.0"),
)


def test_published_notices_are_found_wrapped_and_unwrapped(spark):
    """As published, each paragraph on one line, and as comments; a blank line or a mark still ends a sentence."""
    forms = (lambda t: t, lambda t: re.sub(r"(?<!\n)\n *(?!\n)", " ", t), lambda t: re.sub("(?m)^", " * ", t), lambda t: t.replace("\n", "\r\n"))
    rows = [(k, f, change(text)) for k, (_, text) in enumerate(NOTICES) for f, change in enumerate(forms)]
    rows += [(-1, 0, "Released under\n\nthe MIT License"), (-1, 1, "Released. under\nthe MIT License"), (-1, 2, "Released under\n日本\nthe MIT License")]
    docs = spark.createDataFrame([(f"{k} {f}", text) for k, f, text in rows], "doc_id string, text string")
    got = {r.doc_id: r.licences for r in license_scan.licences(docs).collect()}
    assert got == {f"{k} {f}": [NOTICES[k][0]] if k >= 0 else [] for k, f, _ in rows}


def test_cascade_is_exact(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") * 7).alias("key"))
    listed = keys.where("hash(key) % 9 = 0")
    levels = url_filter.cascade(listed, keys.union(keys))
    assert len(levels) > 1
    found = keys.where(url_filter.is_listed(F.col("key"), levels))
    assert found.exceptAll(listed).isEmpty() and found.count() == listed.count()
    assert url_filter.cascade(listed.limit(0), keys) == [] and url_filter.cascade(listed, listed.limit(0))


def test_urls(spark):
    urls = [None, "", "x", "http://EXAMPLE.org/es/1", "http://a.example.org/en/12?q", "b://org", "b://.org/x", "b://xexample.org/es/", "u://a.b.c#d/e", "p://x.com/de/y#z"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id bigint, url string, host string")
    rules = spark.createDataFrame(list(queries.URL_RULES) + [("", "/", True), (None, "/", True)], "host string, path string, block boolean")
    got = [(r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(pages, rules).orderBy("page_id").collect()]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("example.org", "/es/1", "example.org/es/", "block"), ("a.example.org", "/en/12", "example.org/en/1", "block"),
        ("org", "", None, "allow"), (".org", "/x", "org/", "allow"), ("xexample.org", "/es/", "org/", "allow"),
        ("a.b.c", "", None, "allow"), ("x.com", "/de/y", "com/de/", "block"),
    ]
    assert url_filter.judged(pages, rules.limit(0), "block").where("verdict = 'block' AND rule IS NULL").count() == len(urls)


# Vectors


def test_vectors_equal_brute_force(spark):
    r = np.random.default_rng(7)
    centres = r.normal(size=(6, 24))
    rows = np.concatenate([r.normal(size=(200, 24)), *[c + 0.25 * r.normal(size=(60, 24)) for c in centres], np.repeat(r.normal(size=(1, 24)), 50, 0)])
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    want, label = near.sum(1), np.arange(len(rows))
    for _ in range(len(rows)):
        label = np.minimum(label, np.where(near, label[None, :], len(rows)).min(1))
    docs = spark.createDataFrame([(k, x.tolist(), "v") for k, x in enumerate(rows)], "vec_id bigint, embedding array<double>, weight string")
    for spec in (vector_dedup.VectorSpec(), vector_dedup.VectorSpec(numbers=40 * 24, fewest=1, per_pivot=30)):
        got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in vector_dedup.near_vectors(docs, spec).collect()}
        assert got == {k: (int(want[k]), int(label[k]), bool(label[k] == k)) for k in range(len(rows))}


def test_vectors_of_several_lengths(spark):
    """Each length for itself: links, components and counts equal brute force, in one unit and in many."""
    r = np.random.default_rng(8)
    rows = [np.concatenate([c + 0.3 * r.normal(size=dim) for c in [base]]) for dim in (3, 4, 16) for base in r.normal(size=(9, dim)) for _ in range(12)]
    rows += [np.array([1.0, 2.0, 3.0, 4.0])] * 4 + [np.array([1.0, 2.0, 3.0])] * 6 + [np.array([5.0])]
    unit = [x / np.linalg.norm(x) for x in rows]
    near = np.array([[len(a) == len(b) and a @ b >= 0.9 for b in unit] for a in unit])
    np.fill_diagonal(near, False)
    label = np.arange(len(rows))
    for _ in range(len(rows)):
        label = np.minimum(label, np.where(near, label[None, :], len(rows)).min(1))
    docs = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(rows)], "vec_id bigint, embedding array<double>")
    for spec in (vector_dedup.VectorSpec(), vector_dedup.VectorSpec(numbers=60, fewest=5, per_pivot=10)):
        got = {x.vec_id: (x.n_links, x.component_id) for x in vector_dedup.near_vectors(docs.repartition(3), spec).collect()}
        assert got == {k: (int(near[k].sum()), int(label[k])) for k in range(len(rows))}


def test_clustered_vectors_are_copied_few_times():
    """The number of copies doesn't grow with the number of units where cells are apart."""
    r = np.random.default_rng(9)

    def copies(clusters):
        centres = r.normal(size=(clusters, 64))
        rows = np.repeat(centres, 60, 0) + 0.1 * r.normal(size=(60 * clusters, 64))
        unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        pivots = vector_dedup.Pivots({64: 0}, {64: unit[::60]})
        near = unit @ unit[::60].T
        cell = near.argmax(axis=1)
        far = np.sqrt(np.maximum(2 - 2 * near.max(axis=1), 0))
        low, high = (np.array([f(far[cell == c]) for c in range(clusters)]) for f in (np.min, np.max))
        shells = vector_dedup.Shells(low, high, 0.2 ** 0.5)
        spec = vector_dedup.VectorSpec(numbers=120 * 64)
        units = vector_dedup.units_of(pivots, np.bincount(cell, minlength=clusters), spec)
        met = np.zeros((clusters, clusters), bool)
        batch = pa.record_batch([pa.array(range(len(rows))), pa.array([1] * len(rows)), pa.array(list(rows)), pa.array(cell, pa.int32()), pa.array(far), pa.array([0] * len(rows))], names=list("abcdef"))
        for x in vector_dedup._meetings(pivots, shells)(iter([batch])):
            met[x.column(0).to_numpy(), x.column(1).to_numpy()] = True
        return sum(x.num_rows for x in vector_dedup._visits(pivots, shells, units, met)(iter([batch]))) / len(rows)

    assert copies(160) < 1.2 * copies(40) < 2.4


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [None, 1.0]), (8, [inf, 1.0]), (9, [1.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0])]
    got = sorted((x.vec_id is None, x.vec_id or 0, x.n_links, x.component_id, x.kept) for x in vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect())
    assert got == [(False, 1, 2, 1, True), (False, 2, 2, 1, False), (False, 2, 2, 1, False), *[(False, k, 0, k, True) for k in range(3, 10)], (True, 0, 0, None, True)]


# Classifier and rules


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = queries.table(spark, folder, "labels")
    got = queries.QUERIES["op5_quality_classifier"](spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = got[got.quality == 1].score.to_numpy(), got[got.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert (got[got.quality == 1].predicted == 1).mean() > 0.95


def test_classifier_edges(spark, sf_dir):
    labels = queries.table(spark, sf_dir, "labels")
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (None, ""), (10**9, "a " * 200_000)], "doc_id bigint, text string")
    got = quality_classifier.classified(docs.union(odd).withColumn("score", F.lit("s")), labels).collect()
    assert len(got) == docs.count() + 3 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none = quality_classifier.classified(docs, labels.where("quality = 1")).select("score").distinct().count()
    assert none == 1


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_base_rules_equal_brute_force(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice("ab") for _ in range(r.randrange(60))) for _ in range(60)]
    texts += ["\n".join(r.choice(["x y", " ", "", "z#", "é|\t"]) for _ in range(r.randrange(12))) for _ in range(40)] + [None, "", "🙂 é", "a b c d e f g h " * 3000]
    docs = spark.createDataFrame([(k, t, None, r.choice(["s", None]), 1) for k, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_words int")
    for x in quality_rules.judged(docs).collect():
        want = brute_rules(texts[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want, texts[x.doc_id][:80]
        assert x.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (x.base_failed and x.kept)


def test_each_fence_follows_the_spread_of_its_group(spark):
    """A value that the wide group keeps is rejected in the narrow one, by each fence alone; both groups have the same median."""
    rules = quality_rules.RuleSpec()
    rows = []
    for f in rules.fences:
        sign = 1 if f.side == "high" else -1
        for source, step in (("narrow", 1), ("wide", 10)):
            rows += [(f"{f.side}_{f.measure}", source, f.measure, 600 + sign * step * (k % 21)) for k in range(420)]
    table = spark.createDataFrame(rows, "lang string, source string, m string, v bigint").select(
        "lang", "source", *[F.when(F.col("m") == m, F.col("v")).otherwise(0).alias(m) for m in quality_rules.MEASURES]
    )
    limits = {(r.lang, r.source): r for r in quality_rules.cutoffs(quality_rules.sketches(table), rules).collect()}
    for f in rules.fences:
        name = f"{f.side}_{f.measure}"
        narrow, wide = (abs(limits[name, s][name] - 600) for s in ("narrow", "wide"))
        assert f.least <= narrow < 100 + f.least < 300 < wide, (name, narrow, wide)


def test_cutoffs_change_smoothly_with_the_rows_of_a_group(spark):
    """A small group's cutoff lies near its language's and goes to its own without a jump."""
    def cutoff(n):
        rows = [("en", "small", 40 * (k % 10)) for k in range(n)] + [("en", "large", k % 10) for k in range(3000)] + [("de", "other", 5)] * 500
        table = spark.createDataFrame(rows, "lang string, source string, v bigint").select("lang", "source", *[F.col("v").alias(m) for m in quality_rules.MEASURES])
        limits = quality_rules.cutoffs(quality_rules.sketches(table), quality_rules.RuleSpec()).where("source = 'small'").first()
        return limits.high_symbols

    found = [cutoff(n) for n in (1, 10, 20, 40, 80, 160, 320)]
    assert found == sorted(found) and found[0] < 150 and found[-1] > 600
    assert max(b - a for a, b in zip(found, found[1:])) < 0.4 * (found[-1] - found[0])


def test_repeated_passages_below_the_base_rule_are_rejected(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    texts = [" ".join(word() for _ in range(100)) for _ in range(300)]
    twice = [word() for _ in range(12)]
    odd = " ".join(twice + [word() for _ in range(60)] + twice + [word() for _ in range(20)])
    docs = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate([*texts, odd])], "doc_id int, text string, lang string, source string")
    got = {x.doc_id: x for x in quality_rules.judged(docs, quality_rules.RuleSpec()).collect()}
    assert not got[300].base_failed and got[300].repeated > 200 and not got[300].kept
    assert sum(x.kept for x in got.values()) > 250


def test_sketches_merge_and_are_close(spark):
    rows = spark.range(5000).select(
        F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), *[(F.col("id") * 3).alias(m) for m in quality_rules.MEASURES]
    )
    sketch = quality_rules.sketches(rows)
    merged = quality_rules.quantiles(sketch, ["lang"]).first()
    assert merged.docs == 5000 and abs(merged.p50_letters - 7500) <= 0.035 * 7500 and abs(merged.p90_letters - 13500) <= 0.035 * 13500
    places = spark.range(3000).select("id", quality_rules.least_of(quality_rules.bucket(F.col("id"))).alias("low"))
    assert places.where("low > id OR low < id * 31 / 32 - 1").isEmpty()


# Tokens


@settings(max_examples=300, deadline=None)
@given(st.lists(AWKWARD, max_size=6))
def test_byte_level_ids_are_the_librarys(parts):
    encoder = tokens.byte_level(queries.byte_bpe())
    texts = ["".join(parts), *parts, None]
    assert [x.tolist() for x in encoder.batch(texts)] == encoder.whole([t or "" for t in texts])


def test_files_with_another_pattern_go_to_the_library_whole():
    import public_tokenizers

    encoder = tokens.byte_level(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Hello  World, it's 12", None, "", "a\nb\tc é 🙂 " * 50]
    assert [x.tolist() for x in encoder.batch(texts)] == encoder.whole([t or "" for t in texts])


def test_long_texts_are_cut_where_no_token_reaches_across(monkeypatch):
    encoder = tokens.byte_level(queries.byte_bpe())
    r = random.Random(8)
    text = "".join(r.choice(["word", " it's", "  ", "\n ", " 12", ". ", "é", " x", "\xa0 ", "日本"]) for _ in range(4000))
    want = encoder.whole([text, text[:999], ""])
    monkeypatch.setattr(tokens, "GROUP", 100)
    assert [x.tolist() for x in encoder.batch([text, text[:999], ""])] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(AWKWARD, max_size=6))
def test_pieces_are_sentencepieces(parts):
    own = pieces.pieces(queries.piece_bpe(), 2)
    text = "".join(parts)
    ids = own.batch([text])
    assert own.whole([text])[0] == own._judge.encode(text) == ids[0].tolist()
    assert own.apart == 0
    if "▁" not in text:
        assert own.decode(ids) == [text]


def model_file(path, pieces_, kind, character_map=b"", fallback=True, prefix=True, squeeze=False):
    """A model file with given pieces (text, score, kind), written field by field."""
    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(k, value):
        if isinstance(value, bytes):
            return number(k << 3 | 2) + number(len(value)) + value
        return number(k << 3) + number(int(value))

    body = b"".join(
        field(1, field(1, t.encode()) + number(2 << 3 | 5) + struct.pack("<f", score) + field(3, k)) for t, score, k in pieces_
    )
    trainer = field(3, kind) + field(35, fallback)
    normaliser = field(1, b"own") + (field(2, character_map) if character_map else b"") + field(3, prefix) + field(4, squeeze) + field(5, True)
    path.write_bytes(body + field(2, trainer) + field(3, normaliser))
    return str(path)


def unigram_pieces(fallback=True):
    letters = "▁abcdent.,é"
    words = ["▁a", "▁ab", "ab", "abc", "bc", "cd", "▁de", "de", "ent", "nt", "den", "▁the", "te", "e.", "▁a.", "dedent"]
    bytes_ = [(f"<0x{b:02X}>", -20.0, pieces.BYTE) for b in range(256)] if fallback else []
    special = [("<unk>", 0.0, pieces.UNKNOWN), ("<s>", 0.0, pieces.CONTROL), ("</s>", 0.0, pieces.CONTROL)]
    scored = [(t, -1.5 - 0.37 * k, pieces.NORMAL) for k, t in enumerate(words)] + [(t, -6.0 - 0.13 * k, pieces.NORMAL) for k, t in enumerate(letters)]
    return special + bytes_ + scored


@pytest.mark.parametrize(("fallback", "squeeze"), [(True, False), (True, True), (False, False)])
def test_unigram_scores_are_rebuilt(tmp_path, fallback, squeeze):
    """Best segmentations by unigram scores, with and without bytes for unknown characters, and with spaces squeezed."""
    path = model_file(tmp_path / "u.model", unigram_pieces(fallback), pieces.UNIGRAM, fallback=fallback, squeeze=squeeze)
    own = pieces.Pieces(path, 1)
    r = random.Random(3)
    texts = ["".join(r.choice(["a", "b", "c", "d", "e", "n", "t", ".", "é", " ", "z", "🙂"]) for _ in range(r.randrange(1, 40))) for _ in range(400)]
    found = own.judged(texts)
    assert [x[0].tolist() for x in found] == own._judge.encode(texts) and own.apart == 0 and own.checked > 0
    if fallback and not squeeze:
        assert all(x[2] for x in found)


def test_differences_are_counted_for_every_text(monkeypatch):
    """A stretch on which the libraries differ counts wherever it occurs, and the rebuilt tokenizer's ids are returned."""
    own = pieces.Pieces(queries.piece_bpe(), 1)

    class Judge:
        def encode(self, texts, num_threads):
            return [[9] if "odd" in t else ids for t, ids in zip(texts, own.whole(texts), strict=True)]

    own._judge = Judge()
    for _ in range(2):
        found = own.judged(["odd one", None, "no", "an odd odd  thing", "odd odd", ""])
        assert [x[1] for x in found] == [1, 0, 0, 1, 2, 0]
        assert [x[0].tolist() for x in found] == own.whole(["odd one"]) + [[]] + own.whole(["no", "an odd odd  thing", "odd odd"]) + [[]]


def test_pieces_query_restores_all_texts(spark, sf_dir):
    got = queries.QUERIES["op8_sentencepiece"](spark, sf_dir)
    assert got.where("NOT restored OR differences > 0").isEmpty()
    encoded = pieces.encode(queries.table(spark, sf_dir, "documents"), queries.piece_bpe())
    back = pieces.decode(encoded, queries.piece_bpe())
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text")
    assert back.exceptAll(docs).isEmpty()
    odd = spark.createDataFrame([(None, None, 1), (1, "a▁b", 2)], "doc_id bigint, text string, ids int")
    assert [(r.doc_id, len(r.ids), r.restored) for r in pieces.encode(odd, queries.piece_bpe()).orderBy("doc_id").collect()][0] == (None, 0, True)


def expected_ids(text):
    return tokens.byte_level(queries.byte_bpe()).whole([text or ""])[0] + [0]


def checked_pieces(rows, texts, window=1024):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in texts.items():
        ids, at = expected_ids(text), 0
        for r in sorted(by_doc[doc_id], key=lambda x: x.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    lengths = []
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda x: x.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        lengths.append(at)
    return sum(packing.padding(n, window) for n in lengths) / sum(lengths)


def test_packing_round_trip(spark, sf_dir):
    rows = queries.QUERIES["op6_packing"](spark, sf_dir).collect()
    assert checked_pieces(rows, {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}) < 0.02
    odd = spark.createDataFrame([(7, None, "x"), (8, "", "x"), (9, "a b " * 9000, "x")], "doc_id bigint, text string, ids string")
    checked_pieces(queries.pieces_of(odd).collect(), {7: None, 8: "", 9: "a b " * 9000})
    assert queries.pieces_of(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id bigint, text string")).count() == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1023), min_size=1, max_size=60), st.integers(1, 12))
def test_differencing_places_every_item_once(sizes, windows):
    part, sums = packing.differenced(np.array(sizes), windows)
    assert len(part) == len(sizes) and part.min() >= 0
    assert np.array_equal(np.bincount(part, sizes, len(sums)).astype(int), sums) and len(sums) <= windows


def test_differencing_beats_greedy_spread():
    r = np.random.default_rng(3)
    _, sums = packing.differenced(r.integers(1, 200, 400), 40)
    assert sums[-1] - sums[0] <= 4


def test_token_store_round_trip(spark, sf_dir, tmp_path):
    docs = queries.table(spark, sf_dir, "documents").select("doc_id", "text", F.lit(1).alias("ids"))
    odd = spark.createDataFrame([(None, "null id", 1), (None, None, 1), (10**7, "", 1), (10**7, "again", 1)], docs.schema)
    path, spec = str(tmp_path / "store"), token_store.StoreSpec(queries.byte_bpe(), block_docs=16)
    token_store.write_store(docs.union(odd), path, spec)
    rows = token_store.read_store(spark, path).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    at = 0
    for r in sorted(rows, key=lambda x: x.start):
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
        if r.doc_id in texts:
            assert np.frombuffer(r.ids, "<u4").tolist() == expected_ids(texts[r.doc_id])
    assert len(rows) == len(texts) + 4
    known = [r.doc_id for r in sorted(rows, key=lambda x: x.start)]
    assert known[:2] == [None, None] and known[2:] == sorted(known[2:])
    assert token_store.read_document(spark, path, 3) == [expected_ids(texts[3])]
    assert sorted(token_store.read_document(spark, path, 10**7)) == sorted([[0], expected_ids("again")])
    assert token_store.read_document(spark, path, 10**8) == []
