"""Quality rules whose cutoffs follow the data: one set for each language and source.

Measures of a text are whole numbers. A quantile sketch is the counts of their
logarithmic buckets (32 for each power of two, so 3 % apart). Sketches merge by
adding counts: those of sources give a language's, and those of languages the
corpus's. A group's quantiles are its own, drawn towards its language's as by a
few documents more, and the language's towards the corpus's in the same way, so
cutoffs change smoothly as a group grows. Fences lie beyond the median by a
multiple of the distance to the outer quantile on the same side. Texts outside a
fence are not kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortry.functions.scale import materialized

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8


@dataclass(frozen=True)
class Fence:
    """A measure, on which side it is fenced, and the least distance of the fence from the median."""

    measure: str
    side: str
    least: int


#: Parts of a thousand, but for letters: a hundredth of a letter for each word. The
#: distances are so small that they decide only where nine tenths of a group are alike.
FENCES = (
    Fence("symbols", "high", 10), Fence("capitals", "high", 5), Fence("exclaimed", "high", 5),
    Fence("doubled", "high", 50), Fence("repeated", "high", 50),
    Fence("letters", "high", 10), Fence("letters", "low", 10),
)
MEASURES = ("symbols", "capitals", "exclaimed", "doubled", "repeated", "letters")


@dataclass(frozen=True)
class RuleSpec:
    """borrowed: documents that a group's quantiles are drawn by towards those of
    the level above. spreads: how many times the distance between the median and
    the 90th (or 10th) percentile a fence lies beyond the median. Base rules:
    least_words, most_repeated in percent."""

    borrowed: int = 20
    spreads: int = 4
    least_words: int = 20
    most_repeated: int = 30
    fences: tuple[Fence, ...] = FENCES


def let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(without(text, characters))).cast("bigint")


def repeated_words(words: Column) -> Column:
    """Words in windows of 8 that the text has twice or more, the first included."""

    def covered(hashes: Column) -> Column:
        marked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def shared(s: Column) -> Column:
            same = lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"])
            spots = F.sort_array(F.transform(F.filter(s, lambda e, j: F.coalesce(same(e, j), F.lit(False))), lambda e: e["i"]))
            gaps = lambda p: F.transform(p, lambda v, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - v, F.lit(WINDOW))))
            return let(spots, lambda p: F.aggregate(gaps(p), F.lit(0), lambda a, x: a + x))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(marked, shared))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(windows, covered)).cast("bigint")


def measured(text: Column) -> Column:
    """A struct of the base counts; all zero for a null text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(
        F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")
    ))
    return F.struct(
        of_words.alias("w"), of_lines.alias("l"), F.length(without(text, SPACE)).cast("bigint").alias("word_chars"),
        count_of(text, SYMBOLS).alias("n_symbols"), count_of(text, UPPER).alias("n_capitals"), count_of(text, "!").alias("n_exclaimed"),
    )


def shares() -> dict[str, Column]:
    """The fenced measures, from the counts."""
    part = lambda n, of: F.when(F.col(of) > 0, F.floor(F.col(n) * 1000 / F.col(of))).otherwise(0).cast("bigint")
    return {
        "symbols": part("n_symbols", "word_chars"), "capitals": part("n_capitals", "word_chars"),
        "exclaimed": part("n_exclaimed", "word_chars"), "doubled": part("n_dup_lines", "n_lines"),
        "repeated": part("n_repeat_words", "n_words"),
        "letters": F.when(F.col("n_words") > 0, F.floor(F.col("word_chars") * 100 / F.col("n_words"))).otherwise(0).cast("bigint"),
    }


def bucket(value: Column) -> Column:
    """Values below 32 as they are, then 32 buckets for each power of two."""
    power = F.length(F.bin(value)) - 1
    return F.when(value < 32, value).otherwise(32 * (power - 5) + F.floor(value / F.pow(F.lit(2), power - 5))).cast("int")


def least_of(place: Column) -> Column:
    """The smallest value of a bucket."""
    power = F.floor(place / 32) - 1
    return F.when(place < 32, place).otherwise((place % 32 + 32) * F.pow(F.lit(2), power)).cast("bigint")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): one sketch for each language, source and measure."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES]))
    return rows.select("lang", "source", pairs.alias("x")).groupBy("lang", "source", "x.measure", "x.bucket").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each of keys: docs, and p10_, p50_ and p90_ of each measure; sketches of equal keys are merged."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    own = W.partitionBy(*keys, "measure")
    ranked = merged.withColumns({
        "below": F.sum("n").over(own.orderBy("bucket")), "docs": F.sum("n").over(own.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
    })
    at = lambda q, m: F.min(F.when((F.col("measure") == m) & (F.col("below") * 100 >= F.col("docs") * q), least_of(F.col("bucket"))))
    return ranked.groupBy(*keys).agg(F.max("docs").alias("docs"), *[at(q, m).alias(f"p{q}_{m}") for m in MEASURES for q in (10, 50, 90)])


def drawn_to(own: Column, docs: Column, above: Column, spec: RuleSpec) -> Column:
    """A quantile of so many documents, as if `borrowed` more lay at the one above."""
    return F.call_function("div", own * docs + above * spec.borrowed, docs + spec.borrowed)


def cutoffs(sketch: DataFrame, spec: RuleSpec) -> DataFrame:
    """(lang, source, one column for each fence)."""
    names = [f"p{q}_{m}" for m in MEASURES for q in (10, 50, 90)]
    own = quantiles(sketch, ["lang", "source"])
    of_all = quantiles(sketch, []).first()  # one row
    of_lang = quantiles(sketch, ["lang"])
    of_lang = of_lang.select(F.col("lang").alias("l_lang"), *[
        drawn_to(F.col(n), F.col("docs"), F.lit(of_all[n]).cast("bigint"), spec).alias(f"l_{n}") for n in names
    ])
    joined = own.join(of_lang, F.col("lang").eqNullSafe(F.col("l_lang")))
    chosen = joined.select("lang", "source", *[drawn_to(F.col(n), F.col("docs"), F.col(f"l_{n}"), spec).alias(n) for n in names])
    fences = []
    for f in spec.fences:
        mid, low, high = (F.col(f"p{q}_{f.measure}") for q in (50, 10, 90))
        spread = high - mid if f.side == "high" else mid - low
        reach = F.greatest(F.lit(f.least), spec.spreads * spread)
        fences.append((mid + reach if f.side == "high" else mid - reach).alias(f"{f.side}_{f.measure}"))
    return chosen.select("lang", "source", *fences)


def judged(docs: DataFrame, spec: RuleSpec = RuleSpec(), carry: bool = False, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(doc_id, base counts, base_failed, kept, measures) of every row.

    Cutoffs come from the texts that pass the base rules. A null text counts as
    empty and fails them; null languages and sources are groups like others.
    Repeated rows count and come back each. With carry, the input row comes
    along as the struct `row`; its columns may have any names. An empty table
    gives an empty result.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
        measured(F.col(text_col)).alias("m"), *([F.struct(*[F.col(c) for c in docs.columns]).alias("row")] if carry else []),
    )
    extra = ["row"] if carry else []
    rows = materialized(base.select(
        "doc_id", "lang", "source", "m.w.n_words", "m.word_chars", "m.n_symbols", "m.l.n_dup_lines", "m.w.n_repeat_words",
        "m.l.n_lines", "m.n_capitals", "m.n_exclaimed", *extra,
    ))
    failed = (F.col("n_words") < spec.least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * spec.most_repeated)
    full = rows.withColumns(shares() | {"base_failed": failed})
    limits = cutoffs(materialized(sketches(full.where("NOT base_failed"))), spec).select(
        F.col("lang").alias("c_lang"), F.col("source").alias("c_source"),
        *[F.col(f"{f.side}_{f.measure}") for f in spec.fences],
    )
    placed = full.join(limits, F.col("lang").eqNullSafe(F.col("c_lang")) & F.col("source").eqNullSafe(F.col("c_source")), "left")
    inside = [F.col(f.measure) <= F.col(f"high_{f.measure}") if f.side == "high" else F.col(f.measure) >= F.col(f"low_{f.measure}") for f in spec.fences]
    verdict = reduce(lambda a, b: a & b, inside)
    return placed.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(verdict, F.lit(False))).alias("kept"), *MEASURES, *extra,
    )
