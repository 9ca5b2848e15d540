import itertools
import zlib

import numpy as np
import pytest
from helpers import SF, documents, table
from pyspark.sql import functions as F

from obsledger.llm import on_corpus
from obsledger.llm.line_quality import (
    document_features,
    fit,
    fit_on_labels,
    forward_backward,
    held_out,
    score_documents,
    score_texts,
)


def test_marginals_like_enumeration():
    rng = np.random.default_rng(1)
    scores = [rng.normal(size=n) for n in (1, 2, 5, 7)]
    pairs = rng.normal(size=(2, 2))
    good, expected, total = forward_backward(scores, pairs)
    both = np.zeros((2, 2))
    for k, s in enumerate(scores):
        weights, marginal = 0.0, np.zeros(len(s))
        counts = np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=len(s)):
            w = np.exp(sum(a for a, b in zip(s, y, strict=True) if b) + sum(pairs[a, b] for a, b in zip(y, y[1:])))
            weights += w
            marginal += w * np.array(y)
            for a, b in zip(y, y[1:]):
                counts[a, b] += w
        assert good[k] == pytest.approx(marginal / weights) and total[k] == pytest.approx(np.log(weights))
        both += counts / weights
    assert expected == pytest.approx(both)


def test_features_do_not_depend_on_the_group():
    texts = ["", "one line", "a\nb\n\nc c c", "É" * 50 + "\n!!!", " \n" * 300, "x " * 5000]
    together, _ = document_features(texts)
    for text, features in zip(texts, together, strict=True):
        alone, _ = document_features([text])
        assert features == pytest.approx(alone[0]) and len(features) == text.count("\n") + 1


def test_held_out_accuracy(spark):
    got = on_corpus.QUERIES["op5_line_quality"](spark, SF.replace("sf0.001", "sf0.01")).toPandas()
    labels = __import__("pandas").read_parquet(f"{SF.replace('sf0.001', 'sf0.01')}/labels.parquet")
    both = got.merge(labels, on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    test = both[both.held_out]
    assert (test.predicted == test.quality).mean() > 0.95
    assert test[test.quality == 1].predicted.mean() > 0.97
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_held_out_labels_are_not_used(spark):
    docs = documents(spark, [(r.doc_id, r.text) for r in table("documents").itertuples()])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    spoilt = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = fit_on_labels(docs, labels), fit_on_labels(docs, spoilt)
    assert (a.weights == b.weights).all() and a.slope == b.slope and a.offset == b.offset


def test_only_the_text_decides(spark):
    model = fit_on_labels(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    texts = table("documents").text.tolist()[:20] + ["", None, "x" * 200_000, "a\n" * 3000]
    docs = documents(spark, list(enumerate(texts))).withColumn("score", F.lit("old"))
    one = {r.doc_id: r.score for r in score_documents(docs, model).collect()}
    two = {r.doc_id: r.score for r in score_documents(docs.withColumn("lang", F.lit("zz")).repartition(3), model).collect()}
    assert one == pytest.approx(two) and len(one) == len(texts)
    assert score_texts([], model).shape == (0,)


def test_one_class_or_no_labels(spark):
    model = fit([], [], [])
    assert score_texts(["any"], model)[0] == pytest.approx(0.5)
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    model = fit_on_labels(documents(spark, [(1, "x")]), none)
    assert score_documents(documents(spark, []), model).count() == 0


def _labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int")


def _fitted(monkeypatch):
    seen = []
    monkeypatch.setattr("obsledger.llm.line_quality.fit", lambda features, lengths, labels: seen.append((features, labels)))
    return seen


def test_repeated_ids_do_not_widen_the_sample(spark, monkeypatch):
    seen = _fitted(monkeypatch)
    learnt = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(learnt[0], f"text {k}") for k in range(3000)] + [(learnt[1], "same text")] * 500 + [(i, "t") for i in learnt[2:]]
    labels = [(i, k % 2) for k, i in enumerate(learnt)] * 2
    fit_on_labels(documents(spark, rows), _labels(spark, labels), per_class=len(learnt))
    assert sorted(seen[0][1]) == sorted(k % 2 for k, _ in enumerate(learnt))


def test_long_documents_do_not_lose_a_label(spark, monkeypatch):
    seen = _fitted(monkeypatch)
    learnt = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5][:40]
    rows = [(i, "long\n" * 299 + "end" if k < 20 else "bad") for k, i in enumerate(learnt)]
    labels = _labels(spark, [(i, int(k < 20)) for k, i in enumerate(learnt)])
    fit_on_labels(documents(spark, rows), labels, per_class=30)
    features, found = seen[0]
    assert found.count(0) == found.count(1) == 20
    # Whole documents, as long as their lines fit: 6,000 of 300 each.
    fit_on_labels(documents(spark, rows), labels, per_class=12)
    features, found = seen[1]
    assert found.count(0) == 12 and found.count(1) == 8 and sum(map(len, features)) == 12 + 8 * 300
    with pytest.raises(ValueError, match="all documents of label"):
        fit_on_labels(documents(spark, rows), labels, per_class=1)
