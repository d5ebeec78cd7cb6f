"""The operators over the test tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.scale import fresh_folder
from cohortry.llm import (
    collocations, license_scan, near_duplicates, packing, pieces, prefix_trie, quality_classifier, quality_rules, scoring,
    sharding, token_store, url_filter, vector_dedup,
)

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces_of(docs: DataFrame) -> DataFrame:
    """Packed pieces with a digest instead of their ids."""
    packed = packing.pack(docs, packing.PackSpec(byte_bpe()))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


SHARDS = 16


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), sharding.ShardSpec(SHARDS))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


def _licence_sql() -> str:
    names = ", ".join(f"'{a}': '{b}'" for a, b in license_scan.SENTENCES.items())
    sequence = "'<' || array_to_string(ids, '><') || '>'"
    for licence, wanted in license_scan.RULES:
        sequence = f"replace({sequence}, '<{'><'.join(wanted)}>', '{{{licence}}}')"
    lines = r"string_split(regexp_replace(coalesce(text, ''), '(?m)\n|[.!?]+(?:[ \t\r\f\x0B]+|$)', chr(10), 'g'), chr(10))"
    upper, lower = license_scan.UPPER, license_scan.LOWER
    return f"""
WITH found AS (
  SELECT doc_id, list_filter(list_transform({lines}, lambda s: map {{{names}}}[trim(regexp_replace(translate(s, '{upper}', '{lower}'), '[^a-z0-9]+', ' ', 'g'))]), lambda x: x IS NOT NULL) AS ids
  FROM documents
)
SELECT doc_id, len(ids) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
       array_to_string(regexp_extract_all({sequence}, '\\{{([^}}]*)\\}}', 1), ',') AS licences
FROM found""".replace("\\\\", "\\")


@query("op2_license_scan", _licence_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.licences(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.size("sentence_ids").cast("bigint").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
    )


#: Host, path, whether the rule blocks.
URL_RULES = (
    ("org", "/", False), ("example.org", "/es/", True), ("example.org", "/en/1", True), ("com", "/fr/", False), ("com", "/de/", True),
)
_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{'block' if b else 'allow'}')" for h, p, b in URL_RULES)


@query("op3_url_filter", rf"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
fitting AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
  FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE k = 1""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, block boolean")
    return url_filter.judged(table(spark, sf_dir, "pages"), rules)


@query("op4_vector_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v WHERE list_inner_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.9
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, v.vec_id) AS component_id,
       coalesce(component_id, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN least ON v.vec_id = least.a LEFT JOIN counted ON v.vec_id = counted.a""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_of(table(spark, sf_dir, "documents"))


@query("op7_near_duplicates", rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) < 5 THEN w ELSE list_slice(w, i, i + 4) END, ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
least AS (SELECT a, least(a, min(b)) AS component FROM reach GROUP BY a)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, t.doc_id) AS component_id,
       coalesce(component, t.doc_id) = t.doc_id AS kept
FROM t LEFT JOIN sizes ON sizes.doc_id = t.doc_id LEFT JOIN least ON a = t.doc_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(table(spark, sf_dir, "documents"), piece_bpe())
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"), "restored", "differences",
    )


@query("op9_token_store")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "tokens")
    token_store.write_store(table(spark, sf_dir, "documents"), path, token_store.StoreSpec(byte_bpe()))
    read = token_store.read_store(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _rules_sql() -> str:
    spec, measures = quality_rules.RuleSpec(), quality_rules.MEASURES
    names = [f"p{q}_{m}" for m in measures for q in (10, 50, 90)]
    at = ", ".join(
        f"min(least) FILTER (measure = '{m}' AND below * 100 >= docs * {q}) AS p{q}_{m}" for m in measures for q in (10, 50, 90)
    )

    def level(name: str, keys: str) -> str:
        cols = f"{keys}, " if keys else ""
        over = f"PARTITION BY {cols}measure"
        return f"""
{name}_sum AS (SELECT {cols}measure, bucket, sum(n) AS n FROM sketch GROUP BY {cols}measure, bucket),
{name}_rank AS (SELECT *, sum(n) OVER ({over} ORDER BY bucket) AS below, sum(n) OVER ({over}) AS docs,
  CASE WHEN bucket < 32 THEN bucket ELSE (bucket % 32 + 32) * CAST(pow(2, bucket // 32 - 1) AS BIGINT) END AS least FROM {name}_sum),
{name}_q AS (SELECT {cols}max(docs) AS docs, {at} FROM {name}_rank {'GROUP BY ' + keys if keys else ''})"""

    k = spec.borrowed
    of_lang = ", ".join(f"(l.{n} * l.docs + a.{n} * {k}) // (l.docs + {k}) AS {n}" for n in names)
    picked = ", ".join(f"CAST((o.{n} * o.docs + l.{n} * {k}) // (o.docs + {k}) AS BIGINT) AS {n}" for n in names)
    inside = " AND ".join(
        f"{f.measure} <= p50_{f.measure} + greatest({f.least}, {spec.spreads} * (p90_{f.measure} - p50_{f.measure}))" if f.side == "high"
        else f"{f.measure} >= p50_{f.measure} - greatest({f.least}, {spec.spreads} * (p50_{f.measure} - p10_{f.measure}))"
        for f in quality_rules.FENCES
    )
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, regexp_extract_all(text, '{word}') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
  FROM texts
),
windows AS (
  SELECT k, i, array_to_string(list_slice(words, i, i + 7), ' ') AS w
  FROM (SELECT k, words, unnest(range(1, len(words) - 6)) AS i FROM split WHERE len(words) >= 8)
),
spots AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, w) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT k, sum(least(8, coalesce(next - i, 8))) AS n
  FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS next FROM spots) GROUP BY k
),
counts AS (
  SELECT k, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
         length(text) - length(replace(text, '!', '')) AS n_exclaimed
  FROM split LEFT JOIN covered USING (k)
),
shares AS (
  SELECT *, n_words < {spec.least_words} OR 100 * n_repeat_words > {spec.most_repeated} * n_words AS base_failed,
         CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbols,
         CASE WHEN word_chars > 0 THEN n_capitals * 1000 // word_chars ELSE 0 END AS capitals,
         CASE WHEN word_chars > 0 THEN n_exclaimed * 1000 // word_chars ELSE 0 END AS exclaimed,
         CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS doubled,
         CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeated,
         CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS letters
  FROM counts
),
long AS (
  UNPIVOT (SELECT lang, source, {', '.join(f'CAST({m} AS BIGINT) AS {m}' for m in measures)} FROM shares WHERE NOT base_failed)
  ON {', '.join(measures)} INTO NAME measure VALUE v
),
sketch AS (
  SELECT lang, source, measure, bucket, count(*) AS n FROM (
    SELECT *, CASE WHEN v < 32 THEN v ELSE 32 * (length(bin(v)) - 6) + (v >> (length(bin(v)) - 6)) END AS bucket FROM long
  ) GROUP BY ALL
),
{level('own', 'lang, source')}, {level('of_lang', 'lang')}, {level('of_all', '')},
drawn AS (SELECT l.lang, {of_lang} FROM of_lang_q l, of_all_q a),
chosen AS (SELECT o.lang, o.source, {picked} FROM own_q o JOIN drawn l ON o.lang IS NOT DISTINCT FROM l.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({inside}, FALSE) AS kept, {', '.join('s.' + m for m in measures)}
FROM shares s LEFT JOIN chosen c ON s.lang IS NOT DISTINCT FROM c.lang AND s.source IS NOT DISTINCT FROM c.source"""


@query("op10_quality_rules", _rules_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


@query("op11_collocations", rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
),
words AS (SELECT lang, p, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM pieces),
runs AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
  FROM words WINDOW o AS (PARTITION BY p ORDER BY i)
),
grams AS (
  SELECT lang, 1 AS m, w1 AS g FROM runs
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL
),
f AS (SELECT lang, m, g, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
found AS (SELECT *, string_split(g, ' ') AS w FROM f WHERE m >= 2 AND a >= 30),
cuts AS (
  SELECT c.lang, c.m, c.g, c.a, c.k, l.a AS l, r.a AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (l.a + r.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM found) c
  JOIN f l ON l.lang = c.lang AND l.m = c.k AND l.g = array_to_string(list_slice(c.w, 1, c.k), ' ')
  JOIN f r ON r.lang = c.lang AND r.m = c.m - c.k AND r.g = array_to_string(list_slice(c.w, c.k + 1, c.m), ' ')
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, m, g ORDER BY score, k) = 1),
around AS (
  SELECT lang, k AS m, array_to_string(list_slice(w, s, s + k - 1), ' ') AS g, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - k + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS k FROM found)) GROUP BY ALL
),
ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.g) AS rank
  FROM best LEFT JOIN around USING (lang, m, g) WHERE longer IS NULL OR 100 * longer < 80 * a
)
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op12_lm_score")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(table(spark, sf_dir, "documents"), scoring.ScoreSpec(piece_bpe()))


@query("op13_prefix_trie", """
WITH turns AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) || strlen(coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT conv_id, list(t ORDER BY turn NULLS FIRST, t) AS turns FROM turns GROUP BY conv_id),
started AS (
  SELECT *, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
      string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]
    ))),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END
  )) % 9 AS h
  FROM own
),
built AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) AS s
  FROM started c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
),
nodes AS (
  SELECT list_slice(s, 1, d) AS p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM built) GROUP BY ALL
),
children AS (SELECT list_slice(p, 1, depth - 1) AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
each AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * CAST(substr(p[depth], 33) AS BIGINT) END AS saved
  FROM nodes LEFT JOIN children USING (p)
),
sums AS (
  SELECT list_slice(p, 1, d) AS p, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM each) GROUP BY ALL
),
ends AS (SELECT s AS p, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM built GROUP BY s)
SELECT each.conv_id, each.depth, CAST(up.conv_id AS DOUBLE) AS parent_conv_id, each.n_convs, each.n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM each JOIN sums USING (p) LEFT JOIN ends USING (p)
LEFT JOIN nodes up ON each.depth > 0 AND up.p = list_slice(each.p, 1, each.depth - 1)""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
