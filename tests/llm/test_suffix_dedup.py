import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents, table
from pyspark.sql import functions as F

from obsledger.llm.anchors import anchors_of, width_for
from obsledger.llm.rolling import running_sums
from obsledger.llm.suffix_dedup import drop_repeated_strings


def brute(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    held = Counter(raw[s : s + length] for _, raw in raws for s in range(len(raw) - length + 1))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            if held[raw[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        out.append((i, len(raw), int(gone.sum()), tuple(edges.tolist()), kept))
    return sorted(out, key=repr)


def collected(df):
    return sorted(
        (
            (r.doc_id, r.n_bytes, r.n_removed, tuple(x for s in r.spans for x in (s.start, s.end)), bytes(r.kept))
            for r in df.collect()
        ),
        key=repr,
    )


def made(seed, length, letters="abcdefghijklmnop é"):
    r = random.Random(seed)
    fresh = lambda n: "".join(r.choice(letters) for _ in range(n))
    passages = [fresh(r.randrange(length - 5, 4 * length)) for _ in range(6)]
    rows = []
    for _ in range(40):
        parts = []
        for _ in range(r.randrange(1, 6)):
            parts.append(fresh(r.randrange(0, 2 * length)))
            p = r.choice(passages)
            cut = r.randrange(0, len(p) // 2)
            parts.append(r.choice([p, p[cut:], p[: len(p) - cut], p[:cut] + "#" + p[cut:]]))
        rows.append("".join(parts))
    rows += [rows[0], rows[1][:-3], "", None, "short", "a" * 5 * length, "ab" * 2 * length, "ab" * length + "c" * length]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,length", [(1, 60), (2, 33), (3, 100), (4, 400)])
def test_like_brute_force(spark, seed, length):
    rows = made(seed, length)
    assert collected(drop_repeated_strings(documents(spark, rows), length)) == brute(rows, length)


def test_two_letters_and_odd_rows(spark):
    rows = made(5, 48, "ab") + [(None, "n" * 10 + "xyz" * 40), (None, "xyz" * 40), (3, "same id " * 9), (3, "same id " * 9)]
    docs = documents(spark, rows).withColumn("kept", F.lit("old")).withColumn("rank", F.lit(1))
    out = drop_repeated_strings(docs, 48)
    assert collected(out) == brute(rows, 48) and "rank" in out.columns


def test_tables_like_brute_force(spark):
    rows = list(table("documents")[["doc_id", "text"]].itertuples(index=False, name=None))
    assert collected(drop_repeated_strings(documents(spark, rows))) == brute(rows, 400)


def test_nothing_repeats_and_empty_table(spark):
    assert drop_repeated_strings(documents(spark, [])).count() == 0
    got = drop_repeated_strings(documents(spark, [(1, "only one text, " + "and " * 3)]), 60).collect()
    assert got[0].n_removed == 0 and got[0].spans == []


def test_every_window_has_one_anchor_and_a_phrase():
    r = np.random.default_rng(1)
    for length in (17, 40, 64, 100, 400):
        width = width_for(length)
        for n in (length, length + 1, 3 * length + 7):
            raw = r.integers(97, 97 + r.integers(1, 9), n).astype(np.uint8)
            a = anchors_of(running_sums(raw), length, width)
            own = [s for f, e in zip(a.first, a.last, strict=True) for s in range(f, e + 1)]
            assert own == list(range(n - length + 1))
            has = np.flatnonzero(a.first <= a.last)
            assert has.max() < len(a.at) - 1 and (np.diff(a.at) <= width).all()
            assert (a.at[has + 1] <= a.at[has] + length - 16 - 2 * width + 2).all()


def test_texts_of_equal_short_hashes_stay_apart(spark):
    """Rows without id, or of one id, whose texts have one 32-bit hash: of equal and of different length."""
    made = spark.range(160_000).selectExpr(
        "id", "repeat(concat('x', id, '-', id * 7919, '; '), cast(10 + id % 2 as int)) as text"
    )
    found = made.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("texts"))
    pairs = [r.texts for r in found.where(F.size("texts") > 1).collect()]
    assert len(pairs) > 1
    for one in (None, 7):
        for a, b, *_ in pairs[:3]:
            once = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(300)) + b
            rows = [(one, a), (one, b), (one, a), (one, once)]
            assert collected(drop_repeated_strings(documents(spark, rows), 60)) == brute(rows, 60)
