"""Prefix tries against one written out, with small shards and groups so that all merging happens."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cohortry.llm import prefix_trie


def written_out(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(x[2], x[3]) for x in sorted(turns)] for c, turns in own.items()}
    members, exact = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        seq = (*own.get(c - c % 5, [])[:h], *own[c][h:])
        exact[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    return sorted((
        m[0], len(p), members[p[:-1]][0] if p else -1, len(m), len(children[p]), leaves[p], saved[p],
        hashlib.sha256(",".join(map(str, exact.get(p, []))).encode()).hexdigest(),
    ) for p, m in members.items())


def got(spark, rows, spec, parts):
    frame = spark.createDataFrame([(*r, b"x", 1.5) for r in rows], "conv_id bigint, turn int, role string, text string, key binary, depth double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = prefix_trie.prefix_trie(frame, spec).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in out)


def conversations(r, n, texts):
    rows = []
    for c in range(n):
        rows += [(c, t, r.choice("ab"), r.choice(texts)) for t in range(r.randrange(1, 14))]
    return rows


@pytest.mark.parametrize(("turns", "fan", "parts"), [(1, 2, 7), (60, 3, 5), (200_000, 32, 3)])
def test_equals_one_written_out(spark, turns, fan, parts):
    r = random.Random(turns)
    rows = conversations(r, 160, ["", "é", "yes", "no no"])
    rows += [(c, t, "a", "same") for c in range(500, 620) for t in range(3)]  # many members of one node
    rows += [(c, 0, "a", "first") for c in range(620, 680)] + [(c, 1, "a", str(c)) for c in range(620, 680)]
    rows += [(9000, t, "u", "long") for t in range(700)]
    assert got(spark, rows, prefix_trie.TrieSpec(turns=turns, fan=fan), parts) == written_out(rows)


def test_edges(spark):
    """Null turns, roles, texts and ids; equal turns; repeated rows; a base that is missing or short; negative ids."""
    rows = [
        (7, None, "a", "x"), (7, None, None, "x"), (7, 3, "a", None), (7, 3, "a", "b"), (7, 3, "a", "b"), (None, 1, "a", "lost"),
        (5, 1, "u", "base"), (11, 1, "u", "no base"), (11, 2, "u", "no base"), (13, 2, "u", "no base"), (1 << 40, 0, "", ""), (3, 0, "", ""),
    ]
    assert got(spark, rows, prefix_trie.TrieSpec(turns=2, fan=2), 3) == written_out(rows)
    assert got(spark, [], prefix_trie.TrieSpec(), 3) == []


def test_trees_stay_shallow():
    """Children of one node are found in a few comparisons, whatever their order."""
    tree = prefix_trie.Tree()
    for k in prefix_trie.medians(1000):
        tree.insert([k], [1])
    deep, at = {tree.down[0]: 1}, [tree.down[0]]
    while at:
        node = at.pop()
        for child in (tree.less[node], tree.more[node]):
            if child >= 0:
                deep[child] = deep[node] + 1
                at.append(child)
    assert len(deep) == 1000 and max(deep.values()) <= 10

