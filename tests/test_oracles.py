"""Every registered query against its DuckDB statement."""

import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    def text(value):
        if value is None or value is pd.NaT or value is pd.NA or value != value:
            return "null"
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        return repr(float(value)) if isinstance(value, float) else str(value)

    out = pd.DataFrame({c: df[c].astype(object).map(text) for c in sorted(df.columns)})
    return out.sort_values(list(out.columns), ignore_index=True)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, sf_dir, name):
    got = contract.queries()[name](spark, sf_dir).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).fetchdf()
    pd.testing.assert_frame_equal(canonical(got), canonical(want))


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
    assert "txnflow" in sys.modules
