from __future__ import annotations

import os

import duckdb
import pandas as pd
from pyspark.sql import types as T

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def documents(spark, rows):
    """Rows of (doc_id, text[, source]) as a documents table."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
    return spark.createDataFrame(full, DOCS)


def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    clean = [["" if v is None or v != v else v for v in df[c].tolist()] for c in df.columns]
    return sorted(zip(*clean), key=repr)


def table(name: str) -> pd.DataFrame:
    return pd.read_parquet(f"{SF}/{name}.parquet")
