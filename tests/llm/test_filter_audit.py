import re
from collections import Counter
from itertools import permutations

import numpy as np
from helpers import documents
from pyspark.sql import functions as F

from obsledger.llm import filter_audit, tables
from obsledger.llm.filter_audit import TermMatrix, audit_filters, failures
from obsledger.llm.tables import Scratch

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failed(rows):
    """Letters that each document (id, text, part) fails."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        found = "A" if len(words) < 100 else ""
        found += "B" if 100 * len(set(words)) < 80 * len(words) else ""
        found += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
        found += "D" if re.search("[#$%&*|]", text) else ""
        found += "E" if i is not None and i > first.get(text, i) else ""
        out.append(found)
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    out = []
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, failed(rows), strict=True) if (p or "") == part]
        shapley = Counter()
        steps = []
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                fails = [d for d in mine if letter in d[1]]
                shapley[letter] += len(gone)
                counts = [len(left), len(gone), len(fails) - len(gone), sum(f == letter for _, f in fails)]
                steps.append((letter, part, order, step, *counts, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out += [(*s[1:], shapley[s[0]]) for s in steps]
    return sorted(out)


def docs_of(spark, rows):
    return documents(spark, []).drop("source").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), allowMissingColumns=True
    )


def labels_of(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def collected(df):
    return sorted(tuple(r) for r in df.select("part", "filter_order", "step", *COUNTS).collect())


LONG = " ".join(f"w{i}" for i in range(120))
DULL = " ".join(f"w{i % 90}" for i in range(120))
ROWS = [
    (1, LONG, "en"),
    (2, LONG, "en"),
    (3, DULL, "en"),
    (4, DULL + " #", "fr"),
    (5, LONG.upper(), "fr"),
    (6, LONG.upper(), None),
    (7, None, "en"),
    (8, "", ""),
    (9, " \t\n\x0b\x0c\r ", "en"),
    (10, "\x1c\x1d\x85\xa0x\xa0", "en"),
    (11, "a\x0bb\x0cb\rb b" * 40, "de"),
    (12, "Ünï " * 100 + "ÄÖ", "de"),
    (13, "word " * 90_000, "en"),
    (14, "|", "de"),
    (None, LONG, "en"),
    (None, "|", "de"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (5, None, 1), (6, 1, None), (6, 0, 0), (None, 1, 1), (77, 1, 1), (14, 1, 0)]


def test_like_brute_force(spark, monkeypatch):
    expected = brute(ROWS, LABELS)
    docs = docs_of(spark, ROWS).withColumn("quality", F.lit(1)).withColumn("part", F.lit("x")).withColumn("n", F.lit("x"))
    assert collected(audit_filters(docs, labels_of(spark, LABELS))) == expected
    # Many shards, and words that stand in many of them.
    monkeypatch.setattr(tables, "SLICE_BYTES", 500)
    assert collected(audit_filters(docs.repartition(3), labels_of(spark, LABELS))) == expected


def test_repeated_rows(spark):
    rows = [(5, LONG, "en"), (5, LONG, "en"), (4, "x", "en"), (6, LONG, "en")]
    docs = docs_of(spark, rows)
    got = failures(docs).groupBy("doc", "failed").count().collect()
    assert sorted(tuple(r) for r in got) == [(4, 1, 1), (5, 0, 2), (6, 16, 1)]
    assert collected(audit_filters(docs, labels_of(spark, []))) == brute(rows, [])


def test_the_matrix(spark, monkeypatch):
    monkeypatch.setattr(tables, "SLICE_BYTES", 2000)
    rows = [(i, t) for i, t, _ in ROWS]
    docs = documents(spark, rows).selectExpr(
        "doc_id as doc", "'' as part", "0L as a", "0L as b", "coalesce(text, '') as text"
    )
    matrix = TermMatrix(docs, Scratch(spark, "test"))
    word = {r.number: r.word for r in matrix.dictionary().collect()}
    assert sorted(word) == list(range(len(word)))
    assert set(word.values()) == {w for _, t in rows for w in WORD.findall(t or "")}
    found = []
    for shard in matrix.shards().collect():
        ptr, indices = (np.frombuffer(x, "<i8").tolist() for x in (shard.indptr, shard.indices))
        data = np.frombuffer(shard.data, "<i4").tolist()
        assert len(ptr) == len(shard.rows) + 1 and ptr[-1] == len(indices) == len(data)
        for k, row in enumerate(shard.rows):
            entries = range(ptr[k], ptr[k + 1])
            found.append((row.doc, {word[indices[e]]: data[e] for e in entries}))
    assert matrix.shards().count() > 1
    assert sorted(found, key=repr) == sorted(((i, dict(Counter(WORD.findall(t or "")))) for i, t in rows), key=repr)


def test_empty_tables(spark):
    assert audit_filters(documents(spark, []), labels_of(spark, LABELS)).count() == 0
    rows = [(1, "", "en"), (2, None, "en")]
    docs = docs_of(spark, rows)
    assert collected(audit_filters(docs, labels_of(spark, []))) == brute(rows, [])


def test_steps_are_fixed_in_number(spark):
    assert filter_audit.order_steps(spark).count() == 32 * 600
    assert np.unique([r.filter_order for r in filter_audit.order_steps(spark).collect()]).size == 120
