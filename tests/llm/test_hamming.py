import random

from pyspark.sql import functions as F

from obsledger.llm.hamming import top_k


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute(rows, asked, k, bits):
    code = lambda v: [bool(i < len(v) and v[i] is not None and v[i] > 0) for i in range(bits)]
    usable = [(i, code(v)) for i, v in rows if i is not None and v is not None]
    out = []
    for q, v in asked:
        if q is None or v is None:
            continue
        near = sorted((sum(a != b for a, b in zip(code(v), c, strict=True)), i) for i, c in usable)[:k]
        out += [(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    return sorted(out)


def random_rows(n, bits, seed):
    r = random.Random(seed)
    centre = [[r.gauss(0, 1) for _ in range(bits)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = centre[r.randrange(5)]
        rows.append((i, [x if r.random() < 0.9 else -x for x in c]))
    same = rows[0][1]
    rows += [(n + i, same) for i in range(40)]  # a group of equal codes
    rows += [(3, same), (3, same), (None, same), (n + 90, None), (n + 91, [1.0, None]), (n + 92, [])]
    return rows


def test_exact_against_brute_force(spark):
    rows = random_rows(300, 32, 1)
    asked = [x for x in rows if x[0] is None or x[0] % 25 == 0]
    found = top_k(vectors(spark, rows).withColumn("segment", F.lit(0)), vectors(spark, asked), k=7, bits=32)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, asked, 7, 32)


def test_more_results_than_rows_and_far_rows(spark):
    rows = [(i, [1.0 if i >> b & 1 else -1.0 for b in range(16)]) for i in (0, 1, 3, 65535)]
    found = top_k(vectors(spark, rows), vectors(spark, rows[:2]), k=10, bits=16)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, rows[:2], 10, 16)


def test_empty_tables(spark):
    none = vectors(spark, [])
    one = vectors(spark, [(1, [1.0] * 16)])
    assert top_k(none, one, bits=16).count() == 0
    assert top_k(one, none, bits=16).count() == 0
