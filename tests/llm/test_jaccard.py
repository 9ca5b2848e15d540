import random

import numpy as np
import pytest
from helpers import documents
from pyspark.sql import functions as F

from obsledger.llm import jaccard
from obsledger.llm.jaccard import drop_near_duplicates, jaccard_join, jaccard_pairs, shared_counts
from obsledger.llm.shingles import choose_bands


def shingles(text, n=5):
    words = (text or "").split()
    n = min(n, len(words)) or 1
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows, threshold=0.8):
    n = len(rows)
    linked = [[i != j and similarity(rows[i][1], rows[j][1]) >= threshold for j in range(n)] for i in range(n)]
    out, seen = [], [None] * n
    for i in range(n):
        if seen[i] is None:
            group, todo = [], [i]
            while todo:
                x = todo.pop()
                if seen[x] is None:
                    seen[x] = i
                    group.append(x)
                    todo += [y for y in range(n) if linked[x][y]]
            low = min(rows[x][0] for x in group)
            out += [(rows[x][0], low, sum(linked[x])) for x in group]
    return sorted(out)


def made(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randrange(2, 8)))
    rows = []
    for base in range(12):
        words = [word() for _ in range(r.randrange(60, 200))]
        for _ in range(r.randrange(1, 8)):
            copy = list(words)
            for _ in range(r.randrange(0, 5)):
                copy[r.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += ["one two three", "one  two\nthree", "one two four", "", None, "  \n ", "solo", rows[0], rows[0]]
    rows.append("long " * 20_000 + "end")
    r.shuffle(rows)
    return [(10 * i + 1, t) for i, t in enumerate(rows)]


def collected(df):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_links_and_classes_like_brute_force(spark):
    rows = made()
    docs = documents(spark, rows).withColumn("_node", F.lit(1)).withColumn("class_id", F.lit("old"))
    assert collected(jaccard_join(docs)) == brute(rows)


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 2)
    monkeypatch.setattr(jaccard, "LEAST_ROWS", 2)
    rows = made(5)
    assert collected(jaccard_join(documents(spark, rows))) == brute(rows)


def test_pairs_between_representatives(spark):
    rows = made(7)
    first = {}
    for i, t in rows:
        first.setdefault(frozenset(shingles(t)), (i, t))
    reps = sorted(first.values())
    expected = {
        (a, b): similarity(x, y) for a, x in reps for b, y in reps if a < b and similarity(x, y) >= 0.8
    }
    got = {(r.a, r.b): r.similarity for r in jaccard_pairs(documents(spark, rows)).collect()}
    assert got == pytest.approx(expected)


def test_one_of_each_class_stays(spark):
    rows = made(9)
    stays = {c for _, c, _ in brute(rows)}
    got = drop_near_duplicates(documents(spark, [*rows, (None, rows[0][1])]))
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == sorted(stays)
    assert got.where("doc_id is null").count() == 1


def test_rows_without_id_and_of_one_id(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (None, "a b c d e f"), (None, "q")]
    got = {(r.doc_id, r.class_id) for r in jaccard_join(documents(spark, rows)).collect()}
    assert (2, 1) in got and (None, 1) in got and (None, None) in got
    assert jaccard_join(documents(spark, [])).count() == 0


def test_bands_reach_their_recall():
    for recall in (0.9, 0.99, 0.999):
        bands, rows = choose_bands(0.8, recall)
        assert 1 - (1 - 0.8**rows) ** bands >= recall and bands * rows <= 160


def test_intersections():
    sets = [np.unique(np.random.default_rng(i).integers(0, 60, 40)).astype(np.uint64) for i in range(9)]
    got = shared_counts(sets[:5], sets[3:])
    assert (got == [[len(set(a) & set(b)) for b in sets[3:]] for a in sets[:5]]).all()


def test_repeated_rows_count_once_each(spark):
    words = [f"w{i}" for i in range(60)]
    a, b, c = (" ".join(w) for w in (words, [*words[:-1], "x"], [f"v{i}" for i in range(60)]))
    rows = [(1, a), (1, a), (2, b)]
    assert collected(jaccard_join(documents(spark, rows))) == brute(rows) == [(1, 1, 2), (1, 1, 2), (2, 1, 2)]
    # Ids of several texts: near each other, and one whose other text has a smaller representative.
    rows = [(4, a), (4, b), (4, a), (5, b), (6, b), (6, c), (6, c), (7, c)]
    got = collected(jaccard_join(documents(spark, rows)))
    assert sorted((i, n) for i, _, n in got) == sorted((i, n) for i, _, n in brute(rows))
    assert {k for _, k, _ in got} == {4}


def test_one_text_reaches_the_blocks_for_each_representative(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    a, b = " ".join(words), " ".join([*words[:-1], "x"])
    rows = [(1, a)] * 500 + [(2, b)]
    join = jaccard._Join(documents(spark, rows), 0.8, 5, 0.999, "doc_id", "text")
    names = jaccard.LINKS.fieldNames()
    through = lambda t: t.select(["_set", "_node", "_node", "_copies"]).rename_columns(names)
    monkeypatch.setattr(jaccard, "_verify", lambda *_: through)
    assert sorted((r.node, r.links) for r in join.verified(pairs=False).collect()) == [(1, 500), (2, 1)]


def test_edges_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 8)
    monkeypatch.setattr(jaccard, "LEAST_ROWS", 8)
    r, n, seen = random.Random(4), 160, {}
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(f"x{i}" if k == at else w for k, w in enumerate(words)))
            for i in range(n) for at in [r.randrange(400)]]
    kept = jaccard.components
    monkeypatch.setattr(
        jaccard, "components", lambda edges, scratch, label: (seen.update({label: edges.count()}), kept(edges, scratch, label))[1]
    )
    got = collected(jaccard_join(documents(spark, rows)))
    assert {(c, k) for _, c, k in got} == {(0, n - 1)}
    assert n - 1 <= seen["candidates"] <= 2 * n and n - 1 <= seen["classes"] <= 2 * n
