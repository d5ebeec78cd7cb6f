"""Exact nearest neighbours and the synthetic rows made from them."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from cohortry.functions.scale import hash_number, hash_of, hash_unit, materialized, numbered
from cohortry.operators.sampling import class_sizes

BLOCK = 2048
ASKED = 32  # rows whose distances to a block are held at once
MAX_PIVOTS = 1024
ROWS, VISITS = 1024, 16_384  # rows compared with the pivots, and visits handed on, at once


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, one row of b at a time to stay exact and small."""
    return np.stack([np.sqrt(((a - row) ** 2).sum(axis=1)) for row in b], axis=1)


def _kth(d: np.ndarray, k: int) -> np.ndarray:
    """Each row's k-th smallest distance; infinite if there are fewer."""
    return np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] >= k else np.full(len(d), np.inf)


def visits_of(ids: np.ndarray, x: np.ndarray, d: np.ndarray, radius: np.ndarray, reach: np.ndarray, most: int = VISITS):
    """Frames of visits (id, x, cell), each of at most `most` visits or of one row: where a row
    visits nearly all cells, a batch's visits with their vectors would fill a worker's memory."""
    step = max(1, most // d.shape[1])
    for at in range(0, len(d), step):
        row, cell = np.nonzero(d[at:at + step] - radius <= reach[at:at + step, None])
        if len(row):
            yield pd.DataFrame({"id": ids[at + row], "x": x[at + row], "cell": cell.astype("int32")})


def _pieces(sizes: dict, cell: int, block: int) -> int:
    return max(1, math.ceil(sizes.get(cell, 0) / block))


def cells_and_visits(rows: DataFrame, n: int, k: int, seed: int, block: int) -> tuple[DataFrame, DataFrame, dict, int]:
    """(id, x, cell) of all rows, (id, x, cell) of the visits that k neighbours need, sizes of cells, and their number.

    A row is first compared with a block of its own cell. Its k-th distance
    there is its radius: no k-th neighbour lies farther away. Then it visits
    the cells that the triangle inequality doesn't put beyond that radius.
    """
    n_pivots = min(n, max(k + 1, min(math.isqrt(n), MAX_PIVOTS)))
    chosen = rows.orderBy(hash_of("id", seed=seed), "id").limit(n_pivots).collect()
    pivots = np.array([r.x for r in chosen], dtype=float)
    point = [T.StructField("id", rows.schema["id"].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))]
    cell_type, reach_type = T.StructField("cell", T.IntegerType()), T.StructField("reach", T.DoubleType())

    def pieces(batches):
        for pdf in batches:
            for at in range(0, len(pdf), ROWS):
                yield pdf.iloc[at:at + ROWS]

    def to_cells(batches):
        for pdf in pieces(batches):
            d = _distances(np.array(pdf.x.tolist(), dtype=float), pivots)
            yield pdf.assign(cell=d.argmin(axis=1).astype("int32"), away=d.min(axis=1))

    placed = materialized(rows.mapInPandas(
        to_cells, T.StructType([*point, cell_type, T.StructField("away", T.DoubleType())])
    ))
    # One line per pivot: bounded whatever the number of rows.
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).toPandas()
    radius = np.full(n_pivots, -np.inf)
    radius[cells.cell] = cells.radius
    held = dict(zip(cells.cell, cells.n))

    def at_home(pdf: pd.DataFrame) -> pd.DataFrame:
        x, reach = np.array(pdf.x.tolist(), dtype=float), np.empty(len(pdf))
        for at in range(0, len(x), ASKED):
            d = np.sqrt(((x[at:at + ASKED, None, :] - x[None]) ** 2).sum(axis=2))
            # The row itself lies at 0, so its k-th other one is the next.
            reach[at:at + ASKED] = _kth(d, k + 1)
        return pdf.drop(columns="chunk").assign(reach=reach)

    cuts = rows.sparkSession.createDataFrame([(c, _pieces(held, c, block)) for c in range(n_pivots)], "cell int, chunks int")
    home = placed.drop("away").join(F.broadcast(cuts), "cell").select(
        "id", "x", "cell", F.pmod(hash_number("id", seed=seed), F.col("chunks")).cast("int").alias("chunk")
    )
    near = home.groupBy("cell", "chunk").applyInPandas(at_home, T.StructType([*point, cell_type, reach_type]))

    def to_visits(batches):
        for pdf in pieces(batches):
            d = _distances(np.array(pdf.x.tolist(), dtype=float), pivots)
            # k+1 pivots, one of them perhaps the row itself, bound it as well.
            reach = np.minimum(_kth(d, k + 1), pdf.reach.to_numpy()) * (1 + 1e-9)
            yield from visits_of(pdf.id.to_numpy(), pdf.x.to_numpy(), d, radius, reach)

    visits = materialized(near.select("id", "x", "reach").mapInPandas(to_visits, T.StructType([*point, cell_type])))
    return placed.select("id", "x", "cell"), visits, held, n_pivots


def nearest_neighbours(
    df: DataFrame, key: str, columns: list[str], k: int = 5, seed: int = 1, block: int = BLOCK
) -> DataFrame:
    """(key, nth, neighbour, distance) for the k nearest other rows; exact.

    Rows are assigned to the nearest of a few pivot rows, and each visits the
    cells in which its neighbours can lie. Visits are worked off in blocks of
    bounded size on both sides: a cell holding most rows is cut into many
    blocks, and only the k best of a block leave it.
    """
    rows = materialized(
        df.select(F.col(key).alias("id"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    )
    n = rows.count()
    if n <= 1:
        return rows.select(
            F.col("id").alias(key), F.lit(1).alias("nth"), F.col("id").alias("neighbour"),
            F.lit(0.0).alias("distance"),
        ).limit(0)
    k = min(k, n - 1)
    id_type = rows.schema["id"].dataType
    placed, visits, held, n_pivots = cells_and_visits(rows, n, k, seed, block)
    visitors = {r.cell: r["count"] for r in visits.groupBy("cell").count().collect()}
    # One line per pivot again.
    cuts = df.sparkSession.createDataFrame(
        [(c, _pieces(held, c, block), _pieces(visitors, c, block)) for c in range(n_pivots)], "cell int, chunks int, groups int"
    )
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    mine = lambda count: F.pmod(hash_number("id", seed=seed), F.col(count)).cast("int")
    asking = visits.join(cuts, "cell").withColumn("grp", mine("groups")).withColumn("chunk", each("chunks"))
    holding = placed.join(cuts, "cell").withColumn("chunk", mine("chunks")).withColumn("grp", each("groups"))
    asking, holding = asking.drop("chunks", "groups"), holding.drop("chunks", "groups")

    found = T.StructType([
        T.StructField("id", id_type), T.StructField("neighbour", id_type), T.StructField("distance", T.DoubleType())
    ])
    names = [f.name for f in found.fields]

    def nearest(asked: pd.DataFrame, held_: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held_):
            return pd.DataFrame({c: [] for c in names})
        a, h = np.array(asked.x.tolist(), dtype=float), np.array(held_.x.tolist(), dtype=float)
        ids, who = held_.id.to_numpy(), asked.id.to_numpy()
        wanted, parts_ = min(k, len(h)), []
        for at in range(0, len(a), ASKED):
            d = np.sqrt(((a[at:at + ASKED, None, :] - h[None]) ** 2).sum(axis=2))
            d[who[at:at + ASKED, None] == ids[None]] = np.inf
            # The k-th distance and all ties with it, so that the final choice
            # by (distance, id) does not depend on the blocks.
            row, col = np.nonzero((d <= np.partition(d, wanted - 1, axis=1)[:, wanted - 1:wanted]) & np.isfinite(d))
            order = np.lexsort((ids[col], d[row, col], row))
            row, col = row[order], col[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, col = row[best], col[best]
            parts_.append(pd.DataFrame({"id": who[at + row], "neighbour": ids[col], "distance": d[row, col]}))
        return pd.concat(parts_)

    by = ["cell", "chunk", "grp"]
    candidates = asking.groupBy(*by).cogroup(holding.groupBy(*by)).applyInPandas(nearest, found)
    w = W.partitionBy("id").orderBy("distance", "neighbour")
    return (
        candidates.withColumn("nth", F.row_number().over(w))
        .filter(F.col("nth") <= k)
        .select(F.col("id").alias(key), "nth", "neighbour", "distance")
    )


def smote(
    df: DataFrame, key: str, columns: list[str], k: int = 5, seed: int = 1, target: str = "target"
) -> DataFrame:
    """Class 1 enlarged to the size of class 0 by synthetic rows.

    A synthetic row lies on the line between a drawn class-1 row and one of
    its k nearest class-1 neighbours. It has no key. Row, neighbour and place
    follow from the hash of the draw number.
    """
    sizes = class_sizes(df, target)
    real = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns], target)
    missing = sizes.get(0, 0) - sizes.get(1, 0)
    if missing <= 0 or sizes.get(1, 0) < 2:
        return real
    ones = real.filter(F.col(target) == 1).drop(target)
    near = nearest_neighbours(ones, key, columns, k, seed)
    k = min(k, sizes[1] - 1)
    draws = df.sparkSession.range(missing).select(
        (F.pmod(hash_number("id", seed=seed), F.lit(sizes[1])) + 1).alias("_rank"),
        (F.pmod(hash_number("id", seed=seed + 1), F.lit(k)) + 1).cast("int").alias("nth"),
        hash_unit("id", seed=seed + 2).alias("_at"),
    )
    other = ones.select(F.col(key).alias("neighbour"), *[F.col(c).alias(f"_{c}") for c in columns])
    made = (
        draws.join(numbered(ones, [key], seed, out="_rank"), "_rank")
        .join(near.select(key, "nth", "neighbour"), [key, "nth"])
        .join(other, "neighbour")
        .select(
            F.lit(None).cast(real.schema[key].dataType).alias(key),
            *[(F.col(c) + F.col("_at") * (F.col(f"_{c}") - F.col(c))).alias(c) for c in columns],
            F.lit(1).cast(real.schema[target].dataType).alias(target),
        )
    )
    return real.unionByName(made)
