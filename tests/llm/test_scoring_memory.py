"""What op12 hands to Python."""

from __future__ import annotations

from cohortry.llm import queries, scoring


def test_words_of_a_chunk_stay_away_from_the_last_step(spark):
    docs = spark.createDataFrame([(1, "one two two"), (2, None), (3, "two")], "doc_id bigint, text string")
    out = scoring.scored(docs, scoring.ScoreSpec(queries.piece_bpe()))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "doc_ids" in text and "trained" not in text and "n_trained" not in text
    assert sorted((r.doc_id, r.n_tokens, r.n_known > 0) for r in out.collect()) == [(1, 4, True), (2, 1, True), (3, 2, True)]
