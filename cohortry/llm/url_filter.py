"""Exact URL filters: a cascade of Bloom filters instead of a join.

The first filter encodes the listed keys. Over a known universe its false
positives can be found; the second filter encodes those, the third the listed
keys that the second holds by mistake, and so on until a level makes no mistake.
A key of the universe is listed if the first level that doesn't hold it is an
odd one, counted from zero. A cascade is a few bits for each listed key, looked up by built-in
functions inside the scan.

Two cascades judge a url: one tells which of its keys are rules, over all keys
of the corpus; the other which rules block, over all rules.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.scale import materialized

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: str  # 64-bit words, comma-separated


def _spots(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(bits)) for k in range(hashes)]


def held(key: Column, level: int, at: Level) -> Column:
    """Whether a level holds the key."""
    # Constant: parsed once for a task, not for each row.
    words = F.split(F.lit(at.words), ",").cast("array<bigint>")
    hits = [F.lit(1) == F.getbit(F.get(words, (s / F.lit(64)).cast("int")), (s % 64).cast("int")) for s in _spots(key, level, at.bits, at.hashes)]
    out = hits[0]
    for h in hits[1:]:
        out = out & h
    return out


def encoded(keys: DataFrame, level: int, count: int, rate: float) -> Level:
    """A filter over the column key with about this rate of false positives.

    Its words come to the driver: bits for listed keys, whose number the list
    bounds, not the corpus.
    """
    bits = max(64, 64 * math.ceil(count * -math.log(rate) / math.log(2) ** 2 / 64))
    hashes = max(1, round(-math.log2(rate)))
    spots = keys.select(F.explode(F.array(*_spots(F.col("key"), level, bits, hashes))).alias("s"))
    words = spots.groupBy((F.col("s") / 64).cast("int").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(s % 64 AS INT))) AS b")
    )
    row = [0] * (bits // 64)
    for r in words.collect():
        row[r.w] = r.b
    return Level(bits, hashes, ",".join(map(str, row)))


def cascade(listed: DataFrame, others: DataFrame) -> list[Level]:
    """Levels that tell listed keys from all others; both have a column key.

    others may repeat keys, and may hold listed ones, which are left out.
    """
    listed = materialized(listed.select("key").distinct())
    count = listed.count()
    if not count:
        return []
    universe = max(1, others.agg(F.approx_count_distinct("key")).first()[0])
    rate = min(0.5, count / (universe * math.sqrt(2)))
    levels = [encoded(listed, 0, count, rate)]
    inside = listed
    wrong = others.select("key").where(held(F.col("key"), 0, levels[0])).distinct().join(listed, "key", "left_anti")
    while True:
        wrong = materialized(wrong)
        count = wrong.count()
        if not count:
            return levels
        k = len(levels)
        levels.append(encoded(wrong, k, count, 0.5))
        # What the next level must take back: members of the level before that this one holds.
        inside, wrong = wrong, inside.where(held(F.col("key"), k, levels[k]))


def is_listed(key: Column, levels: list[Level]) -> Column:
    out = F.lit(len(levels) % 2 == 1)
    for k in range(len(levels) - 1, -1, -1):
        out = F.when(held(key, k, levels[k]), out).otherwise(F.lit(k % 2 == 1))
    return out


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    rules: (host string, path string, block boolean), unique in host and path;
    a rule fits its host and all subdomains if the url's path starts with its
    path. The longest rule wins, and of equally long ones that of the longer
    host. Where none fits, rule is null and the verdict is the default. A null
    url has an empty host and path. Rows may repeat; other columns aren't read.
    Rules with a null or empty host fit nothing. Without rules or without
    pages the results are what this says.
    """
    rules = materialized(rules.where("host <> '' AND path IS NOT NULL").select(
        F.concat("host", "path").alias("key"), "block",
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("letters"),
    ).distinct())
    # A url has one key for each form of rule: host labels and letters of the path. The list bounds the forms.
    forms = [(r.labels, r.letters) for r in rules.select("labels", "letters").distinct().orderBy("labels", "letters").collect()]
    urls = pages.select(
        F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path")
    )
    keys = []
    for labels, letters in forms:
        tail = F.substring_index("host", ".", -labels)
        fits = (F.size(F.split("host", r"\.")) >= labels) & (F.length("path") >= letters) & (F.col("host") != "")
        keys.append(F.when(fits, F.concat(tail, F.substring("path", 1, letters))))
    if not keys:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    corpus = urls.select(F.explode(F.array(*keys)).alias("key")).where("key IS NOT NULL")
    known = cascade(rules, corpus)
    blocking = cascade(rules.where("block"), rules)
    tries = F.filter(
        F.array(*[F.struct(F.length(k).alias("n"), F.lit(labels).alias("labels"), k.alias("key")) for k, (labels, _) in zip(keys, forms, strict=True)]),
        lambda x: x["key"].isNotNull() & is_listed(x["key"], known),
    )
    best = urls.withColumn("rule", F.array_max(tries)["key"])
    verdict = F.when(F.col("rule").isNull(), default).when(is_listed(F.col("rule"), blocking), "block").otherwise("allow")
    return best.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
