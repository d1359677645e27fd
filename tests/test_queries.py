"""Every registered query with SQL against DuckDB, on the smallest given tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def comparable(frame: pd.DataFrame) -> pd.DataFrame:
    out = frame.copy()
    for c in out.columns:
        if pd.api.types.is_datetime64_any_dtype(out[c]):
            out[c] = out[c].dt.strftime("%Y-%m-%d")
        elif pd.api.types.is_bool_dtype(out[c]):
            out[c] = out[c].astype(object).map(lambda v: None if pd.isna(v) else bool(v))
        elif pd.api.types.is_integer_dtype(out[c]):
            out[c] = out[c].astype("float64")
        elif out[c].map(type).isin([type(None), int, float]).all():
            out[c] = out[c].astype("float64")
        elif out[c].map(lambda v: hasattr(v, "isoformat")).any():
            out[c] = out[c].map(lambda v: None if pd.isna(v) else v.isoformat()[:10])
    return check.canonical(out)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(comparable(got), comparable(want))


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 31 and df.count() > 0


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())
