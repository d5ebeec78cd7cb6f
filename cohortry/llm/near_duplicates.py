"""Near-duplicate texts: bottom-k sketches from one hash function.

A text's set holds its distinct five-word shingles, hashed by one function; its
sketch keeps the k smallest values. Inverted lists of retained values generate
the pairs that overlap, the sketch of the union estimates their similarity, and
the full sets decide.

What bounds the work:

- Texts with equal sets are one class, and only its first document goes on.
- Two sets that are similar enough share at least `least_shared` values of
  their sketches. So each sketch enters only its rarest values, as many as
  leave fewer than that out (the prefix rule). A value that one class holds
  alone generates nothing, and a passage that many texts share lies outside
  the entered part unless it makes up most of a text.
- The texts that meet are listed once more by their full sets, again the rarest
  shingles first. Sizes, the number of shingles that others have too, and the
  place of the first common one rule out most pairs inside the lists.
- Only components are asked for, so a long list isn't expanded to pairs. In
  each round its most typical open member is compared with all others; members
  that are already connected need no comparison. What then lies outside the
  list's largest component is compared with everything that it isn't connected
  to and that the bounds allow. No list is cut and no pair is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from cohortry.functions.scale import materialized
from cohortry.llm import wordhash
from cohortry.llm.components import compact, components

ROWS = 512  # texts hashed together
SALTS = 16  # ways in which the members of a class are dealt out


@dataclass(frozen=True)
class NearSpec:
    """similarity: links have 100 * common >= similarity * union.

    k values are retained. A pair at the similarity shares each value of the
    union's sketch with that probability; with k = 64 and 75 it shares fewer
    than least_shared = 28 of them in about one of 10**8 cases, and smaller
    sets are compared exactly. rounds: of typical members at most, before
    what is left is compared in full; it is earlier if a round doesn't halve
    the work, or leaves at most `spare` comparisons for each entry of a list.
    """

    similarity: int = 75
    k: int = 64
    least_shared: int = 28
    rounds: int = 6
    spare: int = 16


PRODUCTION = NearSpec()


def _sketches(k: int):
    kinds = pa.schema([
        ("id", pa.int64()), ("n", pa.int64()), ("class", pa.binary()), ("sketch", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sets = wordhash.shingle_sets(part.column(1))
                names = [_name(s) for s in sets]
                yield pa.record_batch(
                    [part.column(0), pa.array([len(s) for s in sets]), pa.array(names, pa.binary()),
                     pa.array([s[:k] for s in sets], pa.list_(pa.int64()))], schema=kinds,
                )

    return run


@F.pandas_udf(BinaryType())
def text_class(texts: pd.Series) -> pd.Series:
    """The name of each text's set, null without words: texts with equal sets have equal names."""
    sets = wordhash.shingle_sets(pa.array(texts, pa.string(), from_pandas=True))
    return pd.Series([_name(s) for s in sets])


def _name(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            sets = pa.array(wordhash.shingle_sets(part.column(1)), pa.list_(pa.int64()))
            yield pa.record_batch([part.column(0), sets], names=["id", "all"])


def _required(n: Column, spec: NearSpec) -> Column:
    """How many retained values a similar pair shares at least, from one side's size."""
    exact = F.ceil(F.lit(spec.similarity) * n / F.lit(100))
    return F.when(n * 100 > F.lit(spec.similarity * spec.k), F.least(exact, F.lit(spec.least_shared))).otherwise(exact)


def _brought_together(reps: DataFrame, spec: NearSpec) -> DataFrame:
    """(id) of classes that meet another one in an inverted list of retained values.

    A sketch enters only its rarest values, as many as leave fewer than the
    required number out, and of these only what others hold too.
    """
    held = reps.select("id", F.explode("sketch").alias("v"))
    shared = held.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    listed = (
        held.join(shared, "v").groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("values"))
    )
    open_ = F.col("kept") - _required(F.col("n"), spec) + 1 - (F.col("kept") - F.size("values"))
    entered = (
        listed.join(reps.select("id", "n", F.size("sketch").alias("kept")), "id")
        .withColumn("open", open_.cast("int")).where("open > 0")
    )
    values = F.expr("transform(slice(values, 1, open), x -> x.v)")
    listed = entered.select(F.explode(values).alias("v"), "id")
    met = listed.groupBy("v").agg(F.count("*").alias("members")).where("members > 1").select("v")
    return listed.join(met, "v").select("id").distinct()


def _placed(sets: DataFrame, spec: NearSpec) -> DataFrame:
    """(v, id, n, rest, typical): the lists of full sets, for the texts that retained values brought together.

    A set's shingles that others hold are put in order, the rarest first; rest
    counts a shingle and those after it. A similar pair has its first common
    shingle where both still have enough of them, so only those places enter.
    """
    held = sets.select("id", F.explode("all").alias("v"))
    several = held.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    ordered = held.join(several, "v").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("df", "v"))).alias("values"), F.sum("df").alias("typical")
    )
    sized = ordered.join(sets.select("id", F.size("all").cast("bigint").alias("n")), "id")
    least = F.ceil(F.col("n") * spec.similarity / 100)
    cut = sized.withColumn("open", (F.size("values") - least + 1).cast("int")).where("open > 0")
    return cut.select(
        "id", "n", "typical", F.size("values").alias("shared"), F.posexplode(F.expr("transform(slice(values, 1, open), x -> x.v)")).alias("at", "v")
    ).select("v", "id", "n", (F.col("shared") - F.col("at")).cast("bigint").alias("rest"), "typical")


def _possible(n: Column, rest: Column, m: Column, other: Column, spec: NearSpec) -> Column:
    """Whether two sets whose first common shingle this is can be similar enough."""
    common = F.least(rest, other)
    return common * 100 >= (n + m - common) * spec.similarity


def _estimated(pairs: DataFrame, reps: DataFrame, spec: NearSpec) -> DataFrame:
    """The pairs that the sketch of the union doesn't rule out."""
    side = lambda x: reps.select(F.col("id").alias(x), F.col("sketch").alias(f"sketch_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, spec.k)
    seen = both.select("a", "b", "sketch_a", "sketch_b", union.alias("union"))
    common = F.size(F.array_intersect(F.array_intersect("union", "sketch_a"), F.col("sketch_b")))
    needed = F.when(F.size("union") < spec.k, F.size("union") * spec.similarity).otherwise(spec.least_shared * 100)
    return seen.where(common * 100 >= needed).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, spec: NearSpec) -> DataFrame:
    side = lambda x: sets.select(F.col("id").alias(x), F.col("all").alias(f"all_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", F.size(F.array_intersect("all_a", "all_b")).alias("common"),
        (F.size("all_a") + F.size("all_b")).alias("sizes"),
    )
    return both.where(
        F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * spec.similarity
    ).select("a", "b")


def _linked(docs: DataFrame, reps: DataFrame, spec: NearSpec) -> DataFrame:
    """(id, component) of the classes' first documents that are linked to others."""
    texts = docs.join(_brought_together(reps, spec), "id", "left_semi")
    sets = materialized(texts.mapInArrow(_full_sets, "id bigint, `all` array<bigint>"))
    entries = materialized(_placed(sets, spec))
    total = entries.count()
    every = compact(entries.select("id").distinct(), total)
    found = every.withColumn("component", F.col("id"))
    links, asked, before = None, None, None
    for turn in range(spec.rounds + 1):
        placed = entries.join(found, "id")
        parts = placed.groupBy("v", "component").agg(
            F.count("*").alias("members"), F.min("n").alias("least"),
            F.max(F.struct("typical", "id", "n", "rest", "component")).alias("best"),
        )
        lists = parts.groupBy("v").agg(
            F.sum("members").alias("size"), F.count("*").alias("parts"), F.min("least").alias("least"),
            F.max(F.struct("members", "component")).alias("most"), F.max("best").alias("best"),
        ).where("parts > 1").select("v", "size", "least", F.col("most.component").alias("main"), "best")
        if turn == 0:
            last, one = False, lists.select("v", "best.*")
        else:
            # Whether the text has enough left to be similar to the smallest set of the list.
            room = F.floor(F.col("rest") * (100 + spec.similarity) / spec.similarity) - F.col("n")
            outside = compact(
                placed.join(lists.select("v", "size", "least", "main"), "v")
                .where((F.col("component") != F.col("main")) & (room >= F.col("least"))).drop("least", "main"), total
            )
            work = outside.agg(F.sum("size")).first()[0]
            if not work:
                break
            last = turn == spec.rounds or work <= spec.spare * total or before is not None and 2 * work > before
            before = work
            one = outside.select("v", "typical", "id", "n", "rest", "component")
            if not last:
                one = one.groupBy("v").agg(F.max(F.struct("typical", "id", "n", "rest", "component")).alias("x")).select("v", "x.*")
        one = one.select("v", *[F.col(c).alias(f"{c}_1") for c in ("id", "n", "rest", "component")])
        pairs = placed.join(one, "v").where(
            (F.col("component") != F.col("component_1"))
            & _possible(F.col("n"), F.col("rest"), F.col("n_1"), F.col("rest_1"), spec)
        ).select(F.least("id", "id_1").alias("a"), F.greatest("id", "id_1").alias("b")).distinct()
        if asked is not None:
            pairs = pairs.join(asked, ["a", "b"], "left_anti")
        pairs = materialized(pairs)
        asked = pairs if asked is None else asked.union(pairs)
        good = materialized(_verified(_estimated(pairs, reps, spec), sets, spec))
        links = good if links is None else links.union(good)
        merged = components(links)
        found = compact(
            every.join(merged, "id", "left").select("id", F.coalesce("component", "id").alias("component")), total
        )
        if last:
            break
    return found


def near_duplicates(docs: DataFrame, spec: NearSpec = PRODUCTION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    component_id is the smallest id reachable by links, kept says that it is
    the row's own. Texts that are null, empty or without words have no
    shingles and link with nothing. A row without id can't be named: it links
    with nothing, its component_id is null and it is kept. Rows that repeat an
    id are one document; if their texts differ, it links by the one whose set
    has the smallest hash. Other columns are not read, so their
    names don't matter. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = materialized(docs.mapInArrow(
        _sketches(spec.k), "id bigint, n bigint, class binary, sketch array<bigint>"
    ))
    named = rows.where("id IS NOT NULL AND class IS NOT NULL")
    members = materialized(named.groupBy("id").agg(F.min("class").alias("class")))
    heads = members.groupBy("class").agg(F.min("id").alias("head"), F.count("*").alias("members"))
    # Sketches and texts travel only for the first document of a class.
    chosen = heads.select(F.col("head").alias("id"), "class")
    reps = materialized(
        named.join(chosen, ["id", "class"], "left_semi").dropDuplicates(["id"]).select("id", "n", "sketch")
    )
    linked = _linked(docs, reps, spec)
    # A class can hold a large part of all documents: its members are dealt out, and its component goes to each part.
    shared = heads.where("members > 1").join(linked.select(F.col("id").alias("head"), "component"), "head", "left").select(
        "class", "head", F.coalesce("component", "head").alias("component"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    copies = salted.join(shared, ["class", "salt"]).where("id <> head")
    place = copies.select("id", "component").union(linked.select("id", "component"))
    return rows.select("id", "n").join(place, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )
