"""Each stage of the pipeline against brute force on what the stage before kept."""

from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from helpers import SF
from test_jaccard import brute as brute_classes
from test_line_dedup import brute as brute_lines
from test_mixing import brute_counts
from tokenizers import Tokenizer

from obsledger.llm.bpe import default_vocabulary
from obsledger.llm.line_quality import fit_on_labels, score_texts


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return [spark.read.parquet(f"{SF}/documents.parquet").toPandas(), *out]


def rows(df):
    return list(df[["doc_id", "text"]].itertuples(index=False, name=None))


def test_columns(stages):
    assert all(list(s.columns) == corpus_pipeline.COLUMNS for s in stages[:-1])
    assert list(stages[-1].columns) == [*corpus_pipeline.COLUMNS, "token_ids", "n_tokens"]


def test_quality(spark, stages):
    docs, kept = stages[:2]
    model = fit_on_labels(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    expected = docs.doc_id[score_texts(docs.text.tolist(), model) >= 0.3]
    assert sorted(kept.doc_id) == sorted(expected) and len(kept) < len(docs)


def test_lines(stages):
    expected = [(i, t) for i, t, _, _ in brute_lines(rows(stages[1]))]
    assert sorted(rows(stages[2])) == sorted(expected)
    assert (stages[2].n_chars == stages[2].text.str.len()).all()


def test_near_copies(stages):
    stays = {c for _, c, _ in brute_classes(rows(stages[2]))}
    assert sorted(stages[3].doc_id) == sorted(stays)


def test_mixture(stages):
    docs = list(stages[3][["doc_id", "text", "source"]].itertuples(index=False, name=None))
    size = Counter()
    for _, text, source in docs:
        size[source] += len(text)
    expected = brute_counts(docs, {s: np.sqrt(n) for s, n in size.items()})
    assert Counter(stages[4][["doc_id", "text", "source"]].itertuples(index=False, name=None)) == expected


def test_tokens(stages):
    library = Tokenizer.from_file(default_vocabulary())
    assert sorted(rows(stages[4])) == sorted(rows(stages[5]))
    for text, ids in zip(stages[5].text, stages[5].token_ids, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_run_is_the_stages_in_order(spark, stages):
    got = corpus_pipeline.run(spark, SF).toPandas()
    key = ["doc_id", "n_tokens"]
    assert sorted(map(tuple, got[key].values.tolist())) == sorted(map(tuple, stages[-1][key].values.tolist()))
