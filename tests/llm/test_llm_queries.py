"""The queries with SQL against it, and the contract columns of the others."""

import pytest
from helpers import SF, canonical, duck

from obsledger.llm import on_corpus

COLUMNS = {
    "op2_jaccard_join": ["doc_id", "class_id", "n_links"],
    "op4_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5_line_quality": ["doc_id", "held_out", "score", "predicted"],
    "op7_secret_scans": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


@pytest.mark.parametrize("name", sorted(on_corpus.SQL))
def test_query_matches_sql(spark, name):
    got = on_corpus.QUERIES[name](spark, SF).toPandas()
    expected = duck().execute(on_corpus.SQL[name]).fetch_df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(got) > 0 and canonical(got) == canonical(expected)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert on_corpus.QUERIES[name](spark, SF).columns[: len(COLUMNS[name])] == COLUMNS[name]


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in on_corpus.QUERIES)
    assert numbers == list(range(1, 14))
