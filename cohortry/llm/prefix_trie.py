"""The prefix trie of conversations, from ternary search trees of range shards.

A conversation is the sequence of its turns' digests. Sequences are dealt out by
range of (sequence, conversation id), so a prefix that many share, or a sequence
that many repeat, spreads over as many shards as it needs. A shard numbers its
own different turns in order and builds a ternary search tree of its different
sequences: the middle one goes in first, then the middles of both halves, which
keeps the search among the children of a node balanced. Every tree node is a
trie node, and its parent is older, so one pass from the youngest back adds up
members, leaves and savings.

Nodes on a shard's first or last path may go on in its neighbours. These
boundary nodes alone are merged, partitions first, then groups of partitions,
until one group is left; what no longer lies on the group's own first or last
path is complete.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.scale import materialized

DIGEST = 16
NONE = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class TrieSpec:
    """turns: of one shard, unless one conversation has more. fan: groups merged at once.
    family, folds: conversation c starts with the first crc32(c) % folds turns of c - c % family."""

    turns: int = 200_000
    fan: int = 32
    family: int = 5
    folds: int = 9


def rebuilt(rows: DataFrame, spec: TrieSpec) -> DataFrame:
    """(conv_id, seq, sizes): digests of each rebuilt conversation's turns, joined, and their texts' bytes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turns = rows.where("conv_id IS NOT NULL").select("conv_id", F.struct("turn", digest.alias("d"), F.octet_length(text).cast("bigint").alias("n")).alias("t"))
    own = materialized(turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own")))
    own = own.select("conv_id", F.transform("own", lambda t: F.struct(t["d"].alias("d"), t["n"].alias("n"))).alias("own"))
    head = own.select(F.col("conv_id").alias("base"), F.slice("own", 1, spec.folds - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spec.folds).cast("int")
    based = own.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % spec.family}).join(head, "base", "left")
    taken = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("own", 1, 0))
    whole = based.select("conv_id", F.concat(taken, F.slice("own", F.col("h") + 1, F.size("own"))).alias("t"))
    return whole.select("conv_id", F.unhex(F.array_join("t.d", "")).alias("seq"), F.col("t.n").alias("sizes"))


class Tree:
    """A ternary search tree. Node 0 is the root, which has no turn; down, less and more lead to other nodes."""

    def __init__(self) -> None:
        self.turn, self.parent, self.depth, self.size = [-1], [-1], [0], [0]
        self.down, self.less, self.more = [-1], [-1], [-1]

    def _grown(self, parent: int, turn: int, size: int) -> int:
        for column, value in (
            (self.turn, turn), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.size, size),
            (self.down, -1), (self.less, -1), (self.more, -1),
        ):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, turns: list[int], sizes: list[int]) -> int:
        """Its last turn's node."""
        at, key = 0, self.turn
        for turn, size in zip(turns, sizes, strict=True):
            side, above = self.down, at
            while (below := side[above]) >= 0 and key[below] != turn:
                side, above = (self.less if turn < key[below] else self.more), below
            if below < 0:
                below = side[above] = self._grown(at, turn, size)
            at = below
        return at

    def path(self, node: int) -> list[int]:
        """From the root to a node."""
        found = []
        while node >= 0:
            found.append(node)
            node = self.parent[node]
        return found[::-1]


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, each range's middle before its halves."""
    waiting = [(0, n)]
    while waiting:
        low, high = waiting.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += [(middle + 1, high), (low, middle)]


NODES = pa.schema([
    ("shard", pa.int64()), ("node", pa.int32()), ("key", pa.binary()), ("first", pa.bool_()), ("last", pa.bool_()),
    ("parent", pa.int32()), ("parent_conv_id", pa.int64()), ("depth", pa.int64()), ("size", pa.int64()), ("conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()),
])
NODE_COLUMNS = (
    "shard bigint, node int, key binary, first boolean, last boolean, parent int, parent_conv_id bigint, depth bigint, size bigint, "
    "conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def shard_nodes(shard: int, rows: list[tuple[int, bytes, list[int]]]) -> list[tuple]:
    """Rows of NODES for conversations in order of sequence and id.

    A boundary node has a key, its prefix's digest; its children, leaves and
    savings count what hangs below it off the boundary, and `ends` are its own
    members' ids, joined. All other nodes are complete and have a hash there.
    parent is a boundary node of the shard, else parent_conv_id is given.
    """
    runs: list[tuple[bytes, list[int], list[int]]] = []
    for conv_id, seq, sizes in rows:
        if not runs or runs[-1][0] != seq:
            runs.append((seq, sizes, []))
        runs[-1][2].append(conv_id)
    cut = lambda seq: [seq[k:k + DIGEST] for k in range(0, len(seq), DIGEST)]
    number = {d: k for k, d in enumerate(sorted({d for seq, _, _ in runs for d in cut(seq)}))}
    tree, last_node = Tree(), [0] * len(runs)
    for k in medians(len(runs)):
        last_node[k] = tree.insert([number[d] for d in cut(runs[k][0])], runs[k][1])
    n = len(tree.turn)
    members, least, ends = [0] * n, [None] * n, {}
    for node, (_, _, ids) in zip(last_node, runs, strict=True):
        members[node], least[node], ends[node] = len(ids), ids[0], ",".join(map(str, ids))
    first, last = tree.path(last_node[0]), tree.path(last_node[-1])
    keys = {}
    for path, seq in ((first, runs[0][0]), (last, runs[-1][0])):
        digest = hashlib.md5()
        for node, step in zip(path, [b"", *cut(seq)], strict=True):
            digest.update(step)
            keys[node] = digest.copy().digest()
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for node in range(n - 1, 0, -1):
        above = tree.parent[node]
        members[above] += members[node]
        least[above] = least[node] if least[above] is None else min(least[above], least[node])
        if node not in keys:
            leaves[node] += children[node] == 0
            saved[node] += (members[node] - 1) * tree.size[node]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    on_first, on_last, out = set(first), set(last), []
    for node in range(n):
        above, inner = tree.parent[node], node not in keys
        hashed = hashlib.sha256(ends[node].encode()).hexdigest() if inner and node in ends else NONE if inner else ends.get(node)
        out.append((
            shard, node, keys.get(node), node in on_first, node in on_last, above if above in keys else None,
            None if above in keys or above < 0 else least[above], tree.depth[node], tree.size[node], least[node],
            members[node], children[node], leaves[node], saved[node], hashed,
        ))
    return out


def _shards(spec: TrieSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows, held = TaskContext.get().partitionId() << 32, [], 0

        def full() -> Iterator[pa.RecordBatch]:
            nonlocal shard, held
            yield from _table(shard_nodes(shard, rows), NODES).to_batches(8192)
            shard, held = shard + 1, 0
            rows.clear()

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                rows.append((row[0], row[1].as_py(), row[2].as_py()))
                held += len(rows[-1][2]) + 1
                if held >= spec.turns:
                    yield from full()
        if rows:
            yield from full()

    return run


#: kind 0: complete nodes; 1: boundary nodes of the group; 2: for each node that came in, its node in the group or its final id.
MERGED = pa.schema([("kind", pa.int32()), *NODES, ("to_shard", pa.int64()), ("to_node", pa.int32())])
MERGED_COLUMNS = f"kind int, {NODE_COLUMNS}, to_shard bigint, to_node int"


def merge_group(group: int, rows: list[dict], final: bool) -> list[tuple]:
    """Merge the boundary nodes of neighbouring shards; with `final` there is nothing beside them."""
    rows = sorted(rows, key=lambda r: (r["shard"], r["depth"]))
    low, high = rows[0]["shard"], rows[-1]["shard"]
    place, nodes = {}, []
    key_of = {(r["shard"], r["node"]): r["key"] for r in rows}
    for r in rows:
        at = place.get(r["key"])
        if at is None:
            place[r["key"]] = at = len(nodes)
            above = None if r["parent"] is None else place[key_of[r["shard"], r["parent"]]]
            nodes.append(r | {"parent": above, "first": False, "last": False, "n_convs": 0, "n_children": 0, "n_leaves": 0, "saved_tokens": 0})
        node = nodes[at]
        node["conv_id"] = min(node["conv_id"], r["conv_id"])
        node["first"] |= r["first"] and r["shard"] == low and not final
        node["last"] |= r["last"] and r["shard"] == high and not final
        for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            node[name] += r[name]
    open_ = [x["first"] or x["last"] for x in nodes]
    for k in sorted(range(len(nodes)), key=lambda k: -nodes[k]["depth"]):
        node = nodes[k]
        if not open_[k]:
            node["n_leaves"] += node["n_children"] == 0
            node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
            if node["parent"] is not None:
                above = nodes[node["parent"]]
                above["n_children"] += 1
                above["n_leaves"] += node["n_leaves"]
                above["saved_tokens"] += node["saved_tokens"]
    out = []
    for k, node in enumerate(nodes):
        above = node["parent"]
        known = nodes[above]["conv_id"] if above is not None and not open_[above] else None
        values = node | {"shard": group, "node": k, "parent_conv_id": known, "parent": None if known is not None else above, "ends": None}
        out.append((int(open_[k]), *[values[f.name] for f in NODES], None, None))
    blank = dict.fromkeys(f.name for f in NODES)
    for r in rows:
        k = place[r["key"]]
        values = blank | {"shard": r["shard"], "node": r["node"], "conv_id": None if open_[k] else nodes[k]["conv_id"]}
        out.append((2, *[values[f.name] for f in NODES], group if open_[k] else None, k if open_[k] else None))
    return out


def _merge(final: bool):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        return _table(merge_group(key[0].as_py(), rows.to_pylist(), final), MERGED)

    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's segments, which come one after another; only the running hash is held."""
    now, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for key, part in zip(batch.column(0), batch.column(1), strict=True):
            key, part = key.as_py(), part.as_py().encode()
            if key == now:
                state.update(b",")
            else:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256()
            state.update(part)
        if done:
            yield pa.record_batch([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], names=["key", "sha"])
    if now is not None:
        yield pa.record_batch([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], names=["key", "sha"])


def prefix_trie(conversations: DataFrame, spec: TrieSpec = TrieSpec()) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    Turns are ordered by `turn`, null first; equal ones by the MD5 of role and
    text, repeated rows each. A null role or text is empty. Rows without
    conv_id belong to no conversation. A conversation is one row of digests,
    however long it is; other columns aren't read. An empty table gives no
    nodes, not even a root.
    """
    order = ["seq", "conv_id"]
    sequences = materialized(rebuilt(conversations, spec))
    sharded = sequences.repartitionByRange(*order).sortWithinPartitions(*order)
    nodes = materialized(sharded.mapInArrow(_shards(spec), NODE_COLUMNS))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    edge = nodes.where("key IS NOT NULL")
    # A key's segments in order of shards are its members in order of their ids.
    segments = edge.where("ends IS NOT NULL").select("key", "ends", "shard")
    hashes = segments.repartition("key").sortWithinPartitions("key", "shard").select("key", "ends").mapInArrow(_hashes, "key binary, sha string")
    groups = (edge.agg(F.max(F.shiftright("shard", 32))).first()[0] or 0) + 1
    level, rounds = edge.drop("ends").withColumn("ends", F.lit(None).cast("string")).withColumn("group", F.shiftright("shard", 32)), []
    while True:
        merged = materialized(level.groupBy("group").applyInArrow(_merge(groups == 1), MERGED_COLUMNS))
        rounds.append(merged)
        if groups == 1:
            break
        groups = -(-groups // spec.fan)
        level = merged.where("kind = 1").select(*NODES.names).withColumn("group", F.floor(F.col("shard") / spec.fan))
    # Final ids of boundary nodes, from the last round back, and with them the parents of nodes below.
    finished, final = [], None
    for merged in rounds[::-1]:
        if final is None:
            above = merged.where("kind = 0")
        else:
            above = _with_parents(merged.where("kind = 0"), final)
        finished.append(above.select(*names, "key"))
        told = merged.where("kind = 2").select("shard", "node", "conv_id", "to_shard", "to_node")
        if final is not None:
            up = final.select(F.col("shard").alias("to_shard"), F.col("node").alias("to_node"), F.col("final_id"))
            told = told.join(up, ["to_shard", "to_node"], "left").withColumn("conv_id", F.coalesce("conv_id", "final_id"))
        final = told.select("shard", "node", F.col("conv_id").alias("final_id"))
    inner = _with_parents(nodes.where("key IS NULL"), final).select(*names, F.col("ends").alias("ends_sha256"))
    outer = finished[0]
    for more in finished[1:]:
        outer = outer.union(more)
    outer = outer.join(hashes, "key", "left").select(*names, F.coalesce("sha", F.lit(NONE)).alias("ends_sha256"))
    return inner.union(outer)


def _with_parents(rows: DataFrame, final: DataFrame) -> DataFrame:
    """Fill in the ids of parents that were boundary nodes; a boundary node has few children in one shard or group."""
    up = final.select("shard", F.col("node").alias("parent"), "final_id")
    joined = rows.join(up, ["shard", "parent"], "left")
    return joined.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "final_id")).drop("final_id")
