import hashlib
import math
from collections import Counter

import pytest
from helpers import documents
from pyspark.sql import functions as F

from obsledger.llm.mixing import mix_sources, repetition_rates


def uniform(*parts):
    text = ":".join("null" if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52


def poisson(u, mean):
    k, p = 0, math.exp(-mean)
    c = p
    while c <= u:
        k += 1
        p *= mean / k
        c += p
    return k


ROWS = [(i, "word " * (i % 13), "abc"[i % 3]) for i in range(300)] + [
    (900, "x" * 100_000, "big"), (901, None, None), (902, "null source", None), (903, "", "empty"),
    (904, "again", "a"), (904, "again", "a"), (None, "no id", "b"),
]


def brute_counts(rows, weights, seed=1):
    size = Counter()
    for _, text, source in rows:
        size[source] += len(text or "")
    total, w = sum(size.values()), sum(weights.values())
    out = Counter()
    for i, text, source in rows:
        rate = total * weights.get(source, 0) / w / size[source] if size[source] else 1.0
        parts = max(1, math.ceil(rate / 32))
        n = sum(poisson(uniform(i, seed, part), rate / parts) for part in range(1, parts + 1))
        out[i, text, source] += n
    return +out


def counted(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_counts_like_brute_force(spark):
    size = Counter()
    for _, text, source in ROWS:
        size[source] += len(text or "")
    expected = brute_counts(ROWS, {s: math.sqrt(n) for s, n in size.items()})
    assert counted(mix_sources(documents(spark, ROWS))) == expected


def test_given_weights_and_large_rates(spark):
    weights = {"a": 80.0, "b": 1.0, "big": 0.0}
    table = spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = counted(mix_sources(documents(spark, ROWS), table, seed=7))
    assert got == brute_counts(ROWS, weights, seed=7)
    assert max(got.values()) > 40 and not any(s == "big" for _, _, s in got)


def test_shares_reach_their_targets(spark):
    docs = [(i, "x" * 50, "a" if i < 6000 else "b") for i in range(8000)]
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    got = Counter(r.source for r in mix_sources(documents(spark, docs), weights).select("source").collect())
    assert got["a"] == pytest.approx(4000, rel=0.08) and got["b"] == pytest.approx(4000, rel=0.08)


def test_order_is_random_and_reproducible(spark):
    docs = documents(spark, [(i, "x", "a" if i < 1000 else "b") for i in range(2000)])
    once = [(r.doc_id, r["copy"], r.shuffle_key) for r in mix_sources(docs).collect()]
    again = [(r.doc_id, r["copy"], r.shuffle_key) for r in mix_sources(docs.repartition(3)).collect()]
    assert sorted(once) == sorted(again)
    half = [i < 1000 for i, _, _ in once[: len(once) // 2]]
    assert 0.4 < sum(half) / len(half) < 0.6


def test_rates(spark):
    sizes = spark.createDataFrame([("a", 30), ("b", 10), (None, 0)], "source string, size long")
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, weight double")
    got = {r.source: r.rate for r in repetition_rates(sizes, weights).collect()}
    assert got == pytest.approx({"a": 1 / 3, "b": 3.0, None: 1.0})


def test_empty_table_and_clashing_columns(spark):
    assert mix_sources(documents(spark, [])).count() == 0
    docs = documents(spark, ROWS).withColumn("copy", F.lit("old")).withColumn("rate", F.lit("mine"))
    out = mix_sources(docs)
    assert counted(out) == counted(mix_sources(documents(spark, ROWS))) and "rate" in out.columns
