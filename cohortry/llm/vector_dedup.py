"""Near-duplicate vectors: an exact metric range join around pivots.

Unit vectors with cosine >= c lie within r = sqrt(2 - 2c) of each other. Every
vector belongs to the cell of its nearest pivot. By the triangle inequality a
vector can have a partner in another cell only if it lies within r of the plane
between the two pivots, and within r of the cell's own shell around its pivot.

Cells that lie together share a unit of bounded size, and a cell above that is
several units, so a cell that holds a large part of all vectors is many tasks. A
vector visits a unit once, whichever of its cells it may have partners in, and a
unit's own vectors are copied only for units that visitors come from. Tasks
count a vector's partners and return a spanning forest of the links they see,
never the pairs. Equal vectors are one class, compared once. Vectors of
different lengths have pivots, cells and units of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.scale import hash_unit, materialized
from cohortry.llm.components import components

SLACK = 1e-6  # on distances, for rounding: too many candidates, never too few


@dataclass(frozen=True)
class VectorSpec:
    """cosine: least cosine of a link. pivots: one for so many vectors, at most
    most_pivots and one for each length; units are cut by size, so that number
    bounds what a task holds of pivots, not the size of a cell. numbers: of the
    vectors of one unit, which has `fewest` vectors at least."""

    cosine: float = 0.9
    per_pivot: int = 2048
    most_pivots: int = 1024
    numbers: int = 1 << 20
    fewest: int = 256


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _by_length(column: pa.Array, rows: int = 1024) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and unit vectors of some vectors of one length at a time."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        places = np.flatnonzero(sizes == dim)
        for k in range(0, len(places), rows):
            some = places[k:k + rows]
            flat = column.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)
            yield int(dim), some, _unit(flat.astype(np.float64).reshape(-1, dim))


@dataclass(frozen=True)
class Pivots:
    """first: number of the first pivot of each length, whose cells have the same numbers."""

    first: dict[int, int]
    of: dict[int, np.ndarray]


def _assign(pivots: Pivots):
    """Adds each vector's cell and its distance from the pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for dim, rows, unit in _by_length(batch.column(2)):
                near = unit @ pivots.of[dim].T
                best = near.argmax(axis=1)
                cell[rows] = best + pivots.first[dim]
                far[rows] = np.sqrt(np.maximum(2 - 2 * near[np.arange(len(best)), best], 0))
            yield pa.record_batch([*batch.columns, pa.array(cell), pa.array(far)], names=["id", "weight", "vec", "cell", "far"])

    return run


def _mine(a, b):
    """Of two units, whether the pair is compared at a: each pair once, shared evenly."""
    return (a == b) | ((a < b) == ((a + b) % 2 == 0)) & (a != b)


@dataclass(frozen=True)
class Shells:
    """Least and greatest distance of a cell's vectors from its pivot; minus and plus infinity the other way round if it has none."""

    low: np.ndarray
    high: np.ndarray
    radius: float

    def may(self, unit: np.ndarray, cell: np.ndarray, own: np.ndarray, first: int) -> np.ndarray:
        """Which cells of the same length each vector may have partners in; cell counts from `first`."""
        each = np.arange(len(cell))
        gap = 2 - 2 * unit @ own.T  # squared distances
        between = np.sqrt(np.maximum(2 - 2 * own[cell] @ own.T, 1e-12))
        plane = (gap - gap[each, cell][:, None]) / (2 * between)
        dist = np.sqrt(np.maximum(gap, 0))
        low, high = self.low[first:first + len(own)], self.high[first:first + len(own)]
        found = (plane <= self.radius) & (dist <= high + self.radius) & (dist >= low - self.radius)
        found[each, cell] = True
        return found


def _meetings(pivots: Pivots, shells: Shells):
    """Pairs (own, at): a vector of cell own may have partners in cell at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = {dim: np.zeros((len(p), len(p)), bool) for dim, p in pivots.of.items()}
        for batch in batches:
            cells = batch.column(3).to_numpy(zero_copy_only=False)
            for dim, rows, unit in _by_length(batch.column(2)):
                cell = cells[rows] - pivots.first[dim]
                may = shells.may(unit, cell, pivots.of[dim], pivots.first[dim])
                for c in np.unique(cell):
                    met[dim][c] |= may[cell == c].any(axis=0)
        for dim, pairs in met.items():
            own, at = np.nonzero(pairs)
            if len(own):
                yield pa.record_batch([pa.array((x + pivots.first[dim]).astype(np.int32)) for x in (own, at)], names=["own", "at"])

    return run


@dataclass(frozen=True)
class Units:
    """units of a cell: count from first on. holds: (unit, cell) pairs in order of units."""

    first: np.ndarray
    count: np.ndarray
    holds: np.ndarray

    def of(self, cells: np.ndarray) -> np.ndarray:
        """The units that hold any of some cells, given as a mask."""
        return np.unique(self.holds[cells[self.holds[:, 1]], 0])


def _chain(points: np.ndarray) -> list[int]:
    """Pivots in an order in which neighbours are near each other."""
    left = np.ones(len(points), bool)
    at, order = 0, [0]
    left[0] = False
    for _ in range(len(points) - 1):
        at = int(np.where(left, points @ points[at], -np.inf).argmax())
        left[at] = False
        order.append(at)
    return order


def units_of(pivots: Pivots, size: np.ndarray, spec: VectorSpec) -> Units:
    """Neighbouring cells together up to a unit's size; a larger cell in several units."""
    first, count, holds, unit = np.zeros(len(size), np.int64), np.ones(len(size), np.int64), [], 0
    for dim, points in pivots.of.items():
        most = max(spec.fewest, spec.numbers // dim)
        filled = 0
        for k in _chain(points):
            cell = pivots.first[dim] + k
            if filled and filled + size[cell] > most:
                unit, filled = unit + 1, 0
            first[cell], count[cell] = unit, max(1, -(-int(size[cell]) // most))
            holds += [(unit + j, cell) for j in range(count[cell])]
            unit += count[cell] - 1
            filled += size[cell]
        unit += 1
    return Units(first, count, np.array(holds, np.int64))


def _visits(pivots: Pivots, shells: Shells, units: Units, met: np.ndarray):
    """Copies each vector to the units it may have partners in: (at, with) names the task."""
    names = ["at", "with", "own", "id", "weight", "vec"]
    hosts: dict[int, np.ndarray] = {}

    def hosted(unit: int) -> np.ndarray:
        """The units whose vectors come to this one, and itself."""
        if unit not in hosts:
            mine = np.zeros(len(met), bool)
            mine[units.holds[units.holds[:, 0] == unit, 1]] = True
            others = units.of(met[:, mine].any(axis=1))
            hosts[unit] = np.union1d(others[_mine(unit, others)], [unit])
        return hosts[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(3).to_numpy(zero_copy_only=False)
            splits = batch.column(5).to_numpy(zero_copy_only=False)
            for dim, places, unit in _by_length(batch.column(2)):
                begin, own = pivots.first[dim], pivots.of[dim]
                cell = cells[places]
                home = units.first[cell] + splits[places] % units.count[cell]
                may = shells.may(unit, cell - begin, own, begin)
                held = units.holds[(units.holds[:, 1] >= begin) & (units.holds[:, 1] < begin + len(own))]
                some, starts = np.unique(held[:, 0], return_index=True)
                rows, k = np.nonzero(np.logical_or.reduceat(may[:, held[:, 1] - begin], starts, axis=1))
                at = some[k]
                keep = _mine(at, home[rows]) & (at != home[rows])
                rows, at = rows[keep], at[keep]
                # As a visitor to other units, and at home for each unit that visitors come from.
                withs = [hosted(int(h)) for h in home]
                stay = np.repeat(np.arange(len(home)), [len(w) for w in withs])
                all_rows, ats = np.concatenate([rows, stay]), np.concatenate([at, home[stay]])
                from_ = np.concatenate([home[rows], *withs])
                is_home = np.concatenate([np.zeros(len(rows), bool), np.ones(len(stay), bool)])
                for k in range(0, len(all_rows), 8192):
                    take = pa.array(places[all_rows[k:k + 8192]])
                    yield pa.record_batch([
                        pa.array(ats[k:k + 8192], pa.int32()), pa.array(from_[k:k + 8192], pa.int32()), pa.array(is_home[k:k + 8192]),
                        batch.column(0).take(take), batch.column(1).take(take), batch.column(2).take(take),
                    ], names=names)

    return run


def _linked(a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with at least this cosine; single precision proposes, double decides."""
    rough = a.astype(np.float32) @ b.astype(np.float32).T
    i, j = np.nonzero(rough >= cosine - 1e-4)
    exact = np.empty(len(i))
    for k in range(0, len(i), 1 << 16):
        exact[k:k + (1 << 16)] = np.einsum("ij,ij->i", a[i[k:k + (1 << 16)]], b[j[k:k + (1 << 16)]])
    return i[exact >= cosine], j[exact >= cosine]


def _compare(spec: VectorSpec):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["own", "id"], ascending=[False, True], kind="stable")
        n, homes = len(rows), int(rows["own"].sum())
        ids, weight = rows["id"].to_numpy(), rows["weight"].to_numpy()
        inside = key[0] == key[1]
        found, label = np.zeros(n, np.int64), np.arange(n)
        if homes and (n > homes or inside):
            unit = _unit(np.stack(rows["vec"].to_numpy()).astype(np.float64))
            for begin in range(0, n if inside else n - homes, 512):
                low = begin if inside else begin + homes
                other = np.arange(low, min(low + 512, n))
                i, j = _linked(unit[:homes], unit[other], spec.cosine)
                j = other[j]
                keep = (j >= homes) | (i < j)  # a pair at home is met twice
                i, j = i[keep], j[keep]
                np.add.at(found, i, weight[j])
                np.add.at(found, j, weight[i])
                while len(i):  # labels fall to the smallest of what they meet
                    low_ = np.minimum(label[i], label[j])
                    before = label.copy()
                    np.minimum.at(label, label[i], low_)
                    np.minimum.at(label, label[j], low_)
                    np.minimum.at(label, i, low_)
                    np.minimum.at(label, j, low_)
                    label = label[label]
                    if np.array_equal(before, label):
                        break
        out = found > 0
        return pd.DataFrame({"id": ids[out], "found": found[out], "to": ids[label[out]]})

    return run


def near_vectors(rows: DataFrame, spec: VectorSpec = VectorSpec(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    n_links counts the other rows linked directly; component_id is the smallest
    id reachable by links, kept that it is the row's own. A vector that is
    null, empty, zero or holds a null or a number that isn't finite links with
    nothing; vectors of different lengths don't link. Rows with the same id
    and vector are vectors of their own and link with each other. A row
    without id links with nothing; its component_id is null and it is kept.
    Other columns aren't read; an empty table gives an empty result.
    """
    vec = F.col(vec_col).cast("array<double>")
    sound = (F.size(vec) > 0) & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vec, lambda x: x != 0)
    named = rows.select(F.col(id_col).cast("bigint").alias("id"), vec.alias("vec"), (sound & F.col(id_col).isNotNull()).alias("sound"))
    # Equal vectors: one class, named by its smallest id; the digest of 128 bits stands for the vector.
    digest = [F.xxhash64("vec").alias("d1"), F.xxhash64(F.lit(1), "vec").alias("d2")]
    members = named.where("sound").select("id", "vec", F.size("vec").alias("dim"), *digest)
    classes = materialized(members.groupBy("dim", "d1", "d2").agg(
        F.min("id").alias("id"), F.count("*").alias("weight"), F.first("vec").alias("vec")
    ))
    pivots = _pivots(classes, spec)
    if not pivots.of:
        return named.select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    placed = materialized(classes.select("id", "weight", "vec").mapInArrow(
        _assign(pivots), "id bigint, weight bigint, vec array<double>, cell int, far double"
    ))
    found = {r.cell: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("far").alias("low"), F.max("far").alias("high")).collect()}
    cells = sum(map(len, pivots.of.values()))
    column = lambda name, empty: np.array([getattr(found[c], name) if c in found else empty for c in range(cells)])
    shells = Shells(column("low", np.inf), column("high", -np.inf), math.sqrt(2 - 2 * spec.cosine) + SLACK)
    units = units_of(pivots, column("n", 0), spec)
    met = np.eye(cells, dtype=bool)
    if len(units.holds) > 1:
        # One row for each pair of cells at most, whose number the spec bounds.
        pairs = placed.mapInArrow(_meetings(pivots, shells), "own int, at int").distinct().collect()
        met[[r.own for r in pairs], [r["at"] for r in pairs]] = True
    split = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    visits = placed.withColumn("split", split).mapInArrow(
        _visits(pivots, shells, units, met), "at int, with int, own boolean, id bigint, weight bigint, vec array<double>",
    )
    seen = materialized(visits.groupBy("at", "with").applyInPandas(_compare(spec), "id bigint, found bigint, `to` bigint"))
    counts = seen.groupBy("id").agg(F.sum("found").alias("found"))
    joined = components(seen.select(F.col("id").alias("a"), F.col("to").alias("b")))
    result = classes.select(F.col("id").alias("head"), "d1", "d2", "dim", "weight").join(
        counts.withColumnRenamed("id", "head"), "head", "left"
    ).join(joined.select(F.col("id").alias("head"), "component"), "head", "left").select(
        "d1", "d2", "dim", F.coalesce("component", "head").alias("component"),
        (F.coalesce("found", F.lit(0)) + F.col("weight") - 1).alias("links"),
    )
    every = named.select("id", "sound", F.size("vec").alias("dim"), *digest)
    ok = every.where("sound").join(result, ["d1", "d2", "dim"]).select("id", "links", "component")
    rest = every.where("NOT coalesce(sound, false)").select("id", F.lit(0).cast("bigint").alias("links"), F.col("id").alias("component"))
    return ok.union(rest).select(
        F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _pivots(classes: DataFrame, spec: VectorSpec) -> Pivots:
    """Vectors with the lowest hashes: of each length one, and more in proportion to its rows, in all at most most_pivots more.

    There are as many lengths as the longest vector has numbers, at most.
    """
    lot = hash_unit("id", seed=4)
    sizes = classes.groupBy("dim").agg(F.count("*").alias("n"), F.min_by("vec", lot).alias("vec")).collect()
    total = sum(r.n for r in sizes)
    wanted = {r.dim: min(-(-r.n // spec.per_pivot), -(-spec.most_pivots * r.n // total)) for r in sizes}
    chosen = {r.dim: [r.vec] for r in sizes}
    more = [(r.dim, min(1.0, (1.3 * wanted[r.dim] + 20) / r.n)) for r in sizes if wanted[r.dim] > 1]
    if more:
        shares = classes.sparkSession.createDataFrame(more, "dim int, share double")
        drawn = classes.select("dim", "vec", lot.alias("lot")).join(F.broadcast(shares), "dim").where("lot <= share")
        for r in sorted(drawn.collect(), key=lambda r: r.lot):
            if len(chosen[r.dim]) <= wanted[r.dim]:
                chosen[r.dim].append(r.vec)
        for dim, _ in more:
            chosen[dim] = chosen[dim][1:] or chosen[dim]  # the one above comes again
    first, of, at = {}, {}, 0
    for dim in sorted(chosen):
        first[dim], of[dim] = at, _unit(np.array(chosen[dim], np.float64))
        at += len(chosen[dim])
    return Pivots(first, of)
