from collections import defaultdict

from helpers import documents
from pyspark.sql import functions as F

from obsledger.llm.line_dedup import drop_repeated_lines

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_chars=10, min_docs=2):
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate(UPPER)
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if i is None or len(holders.get(key(x), ())) < min_docs or min(holders[key(x)]) == i
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


ROWS = [
    (5, "A shared line here\nonly in five\n\nshort"),
    (2, "  a SHARED line here \t\nshort\nA shared line here"),
    (9, "A shared line here"),
    (9, "A shared line here"),
    (11, None),
    (12, ""),
    (13, "\n\n"),
    (14, "Ünïcode Ä line\n" * 3),
    (15, "ünïcode ä line\nÜnïcode Ä line\xa0"),
    (None, "A shared line here\nno id"),
    (16, "x" * 200_000 + "\nA shared line here\r\n" + "y" * 11),
    (17, "y" * 11 + "\n" + "q\n" * 2000),
]


def collected(df):
    rows = df.select("doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_lines_like_brute_force(spark):
    assert collected(drop_repeated_lines(documents(spark, ROWS))) == brute(ROWS)


def test_higher_threshold_counts_documents(spark):
    got = collected(drop_repeated_lines(documents(spark, ROWS), min_docs=4))
    assert got == brute(ROWS, min_docs=4)


def test_clashing_columns_pass_or_are_replaced(spark):
    docs = documents(spark, ROWS).withColumn("n_lines", F.lit("old")).withColumn("line", F.lit(1)).withColumn("key", F.lit(2))
    out = drop_repeated_lines(docs)
    assert collected(out) == brute(ROWS)
    assert {"line", "key", "source"} <= set(out.columns)


def test_empty_table(spark):
    assert drop_repeated_lines(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = drop_repeated_lines(documents(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_many_lines_of_one_document(spark):
    n = 100_000
    shared = [f"this line {i % 50} is in both" for i in range(n)]
    rows = [(1, "\n".join(shared)), (2, "\n".join(["own", *shared, "last"])), (2, "own\n" + shared[7]), (3, "x\n" * n)]
    assert collected(drop_repeated_lines(documents(spark, rows))) == brute(rows)
