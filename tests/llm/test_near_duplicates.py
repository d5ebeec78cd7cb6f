"""Near-duplicates and components against brute force."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cohortry.llm import queries
from cohortry.llm.components import components
from cohortry.llm.near_duplicates import PRODUCTION, NearSpec, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """doc_id -> (set size, component); links found through an index of all shingles."""
    sets = {i: shingles(t) for i, t in rows}
    index, parent = {}, {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    common = {}
    for members in index.values():
        for k, a in enumerate(members):
            for b in members[:k]:
                common[b, a] = common.get((b, a), 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def edited(words, r, share):
    return " ".join(r.choice("abcdefgh") * 5 + str(r.random()) if r.random() < share else w for w in words)


@pytest.fixture(scope="module")
def copies():
    """Long and short texts with edited copies, one list that most texts are in, and a shared passage."""
    r, rows = random.Random(3), []
    word = lambda: "".join(r.choice("aeioust") for _ in range(6))
    passage = [word() for _ in range(30)]
    for size, copies_, share in ((150, 60, 0.03), (12, 15, 0.03), (40, 15, 0.02), (900, 6, 0.02), (70, 30, 0.05)):
        base = [word() for _ in range(size)]
        rows += [edited(base, r, share if k else 0) for k in range(copies_)]
    rows += [" ".join([word() for _ in range(r.randint(5, 90))] + passage) for _ in range(60)]
    rows += ["Hello  World", "hello world\n", "one", "", " \t", None, "a b c d e", "A b c d e", "a b c d"]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("spec", [PRODUCTION, NearSpec(rounds=1), NearSpec(spare=0, rounds=3)])
def test_equals_brute_force_on_copies(spark, copies, spec):
    docs = spark.createDataFrame(copies, "doc_id bigint, text string")
    assert found(near_duplicates(docs, spec)) == brute(copies)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    got = queries.QUERIES["op7_near_duplicates"](spark, sf_dir)
    assert found(got) == brute(rows)
    assert got.where("kept <> (doc_id = component_id)").isEmpty()


def test_edges(spark):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, None), (5, "a b c d e f"), (7, "x y")]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, id int, class string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [
        (False, 3, 2, 3, True), (False, 4, 0, 4, True), (False, 5, 2, 3, False), (False, 5, 2, 3, False),
        (False, 7, 1, 7, True), (True, 0, 2, None, True),
    ]
    assert near_duplicates(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "p q r s t"), (1, "u v w x y z"), (2, "p q r s t")], "doc_id bigint, text string")
    assert near_duplicates(twice).count() == 3


def test_components(spark):
    r = random.Random(5)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(900, k) for k in range(800, 899)]
    got = {x.id: x.component for x in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    near = {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        todo = [start]
        while todo and start not in want or todo:
            x = todo.pop()
            if x not in want:
                want[x] = start
                todo += near[x]
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert components(spark.range(3).select(F.col("id").alias("a"), F.col("id").alias("b"))).count() == 0
