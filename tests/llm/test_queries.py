"""Queries whose result SQL can give, and the columns that each query must have."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortry.llm import queries
from tests.oracle import compare

COLUMNS = {
    "op1_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op2_license_scan": "doc_id n_sentences sentence_ids licences",
    "op3_url_filter": "page_id host path rule verdict",
    "op4_vector_dedup": "vec_id n_links component_id kept",
    "op5_quality_classifier": "doc_id held_out score predicted",
    "op6_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7_near_duplicates": "doc_id n_shingles component_id kept",
    "op8_sentencepiece": "doc_id n_tokens ids_crc32 restored differences",
    "op9_token_store": "doc_id start n_tokens ids_crc32",
    "op10_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op11_collocations": "lang rank phrase a l r n score",
    "op12_lm_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op13_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


@pytest.mark.parametrize("name", queries.ORACLES)
def test_equals_sql(spark, sf_dir, duck, name):
    assert compare(queries.QUERIES[name](spark, sf_dir).toPandas(), duck, queries.ORACLES[name]) == ""


def test_names():
    assert sorted(queries.QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", COLUMNS)
def test_empty_tables(spark, sf_dir, tmp_path, name):
    """No rows give no rows, with the same columns."""
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        queries.table(spark, sf_dir, table).limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    got = queries.QUERIES[name](spark, str(tmp_path))
    assert got.columns[:len(COLUMNS[name].split())] == COLUMNS[name].split() and got.count() == 0


def test_pipeline(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    kept, names = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, sf_dir).persist()
        names.append((name, kept.count()))
        assert kept.columns == docs.columns
        assert kept.exceptAll(before).isEmpty()
    assert docs.count() > names[0][1] > names[1][1] > names[2][1] > 0.5 * docs.count()
    groups = {r.doc_id: r.component_id for r in queries.near_duplicates.near_duplicates(kept).collect()}
    assert all(a == b for a, b in groups.items())
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in kept.collect()}


def test_pipeline_edges(spark, sf_dir, tmp_path):
    """Null ids, null texts, repeated rows and columns with the operators' own names go through every stage."""
    good = [r.text for r in queries.table(spark, sf_dir, "documents").where("lang = 'en' AND n_chars BETWEEN 800 AND 3000").limit(6).collect()]
    rows = [(k, t, "en", None, len(t), "x", k) for k, t in enumerate(good)]
    rows += [rows[0], (None, good[1] + " more words here", None, "s", 5, "y", 1), (None, good[1], None, "s", 5, "y", 1), (50, None, "en", "s", None, None, 2), (51, "", "en", "s", 0, None, 2)]
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, id int"
    docs = spark.createDataFrame(rows, kinds)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.where("start = 0").count() == docs.count() and corpus_pipeline.packed(spark, docs.limit(0), sf_dir).count() == 0
    once = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, sf_dir)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in once.collect())[-3:] == [(False, 51), (True, 0), (True, 0)]
    assert once.where("doc_id = 0").count() == 1


def test_the_compared_row_of_a_repeated_id_stays(spark, sf_dir):
    """Rows that share an id: the one whose text was compared, whatever their order; ties by text and row."""
    texts = [" ".join(f"w{k}x{j}" for j in range(40)) for k in range(3)]
    rows = [(1, t, c) for t in [*texts, "", None] for c in ("b", "a")] + [(2, texts[0] + " end", "z"), (3, "", "e"), (3, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    found = [sorted(map(tuple, stage(spark, d.repartition(n), sf_dir).collect()), key=str) for d, n in ((docs, 1), (docs.orderBy("lang"), 4))]
    assert found[0] == found[1]
    near = queries.near_duplicates
    names = {t: c for t, c in docs.select("text", near.text_class(F.col("text"))).distinct().collect() if c is not None}
    first = min((names[t], t) for t in texts)[1]
    assert [r[1] for r in found[0] if r[0] == 1] == [first] and len([r for r in found[0] if r[0] == 3]) == 1


def test_long_texts_go_through_every_stage(spark, sf_dir):
    base = queries.table(spark, sf_dir, "documents").where("lang = 'en' AND n_chars > 800").limit(3).collect()
    rows = [(k, r.text, "en", "s", len(r.text)) for k, r in enumerate(base)] + [(9, " ".join(f"{r.text} {k}" for k in range(400) for r in base), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).where("doc_id >= 0").count() >= 0
    assert corpus_pipeline.packed(spark, docs, sf_dir).where("doc_id = 9").count() > 400
