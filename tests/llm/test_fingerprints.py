import hashlib

import pytest
from helpers import documents
from pyspark.sql import functions as F
from test_jaccard import made, similarity

from obsledger.llm import fingerprints as fp
from obsledger.llm.fingerprints import fingerprint_edits, fingerprint_of, fingerprints, likeness, similar_pairs


def brute(rows):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        out.append((i, len(text), text[: len(text) - half] + after[:half], after, text))
    return out


ROWS = made() + [(7, "ünï ¢öde 😀 " * 40), (7, "again of one id"), (8, "x" * 150_000), (None, "without id"), (99999, None)]


def check(spark, rows):
    got = fingerprint_edits(documents(spark, rows).withColumn("own", F.lit(1))).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    got = sorted(((r.doc_id, r.n_chars, r.edited, r) for r in got), key=key)
    expected = sorted(brute(rows), key=key)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    for (_, _, _, r), (_, _, edited, after, text) in zip(got, expected, strict=True):
        assert r.fingerprint == fingerprint_of(text) and r.edited_fingerprint == fingerprint_of(edited)
        assert r.near_edited == likeness(r.fingerprint, fingerprint_of(edited))
        assert r.near_next == likeness(r.fingerprint, fingerprint_of(after))


def test_edits_like_brute_force(spark):
    check(spark, ROWS)


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_ROWS", 3)
    check(spark, ROWS)


@pytest.mark.parametrize("rows", [[], [(1, "alone in the world")], [(2, None), (1, "")]])
def test_few_rows(spark, rows):
    check(spark, rows)


def test_likeness_estimates_jaccard():
    rows = [t or "" for _, t in made(11)]
    for a, b in zip(rows, rows[1:]):
        assert abs(likeness(fingerprint_of(a), fingerprint_of(b)) - similarity(a, b)) < 0.2
    near = " ".join(map(str, range(300)))
    half = " ".join(map(str, range(150))) + " " + " ".join(map(str, range(1000, 1150)))
    assert abs(likeness(fingerprint_of(near), fingerprint_of(half)) - similarity(near, half)) < 0.12


def test_equal_texts_and_null(spark):
    rows = [(1, "the same text here"), (2, "the same text here"), (3, None), (4, "")]
    docs = documents(spark, rows).withColumn("fingerprint", F.lit("old"))
    got = {r.doc_id: r.fingerprint for r in fingerprints(docs).collect()}
    assert got[1] == got[2] != got[3] == got[4] == "f" * 8 * fp.PERMUTATIONS
    assert hashlib.sha256(got[1].encode()).hexdigest()  # a plain string


def test_pairs_are_verified(spark):
    rows = made(13)
    pairs = similar_pairs(documents(spark, rows)).collect()
    text = dict(rows)
    assert pairs and all(similarity(text[p.a], text[p.b]) == pytest.approx(p.similarity) for p in pairs)
