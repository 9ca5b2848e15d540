"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from obsledger.plans import on_tables

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    clean = [["" if v is None or v != v else v for v in df[c].tolist()] for c in df.columns]
    return sorted(zip(*clean), key=repr)


def test_every_query_has_sql():
    assert set(on_tables.QUERIES) == set(on_tables.SQL)
    assert set(on_tables.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(on_tables.QUERIES))
def test_query_matches_sql(spark, sql, name):
    ours = contract.queries()[name](spark, SF)
    got = ours.toPandas()
    expected = sql.execute(contract.oracle_sql()[name]).fetch_df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert len(got) == len(expected) > 0
    assert canonical(got) == canonical(expected)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["entity_code", "latest_observation_date"] and df.count() > 0
