"""Every named query against its SQL twin on the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"


def comparable(frame):
    """Rows as sorted tuples of text, independent of engine types."""
    out = frame[sorted(frame.columns)].copy()
    for name in out.columns:
        kind = out[name].dtype
        if str(kind).startswith("datetime"):
            out[name] = out[name].astype("datetime64[us]").astype(str)
        elif kind.kind in "fiub":
            out[name] = out[name].astype(float).map(lambda v: "null" if v != v else repr(v + 0.0))
        else:
            out[name] = out[name].map(lambda v: "null" if v is None or v != v else str(v))
    return sorted(out.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    expected = con.execute(entry_points.oracle_sql()[name]).df()
    actual = entry_points.queries()[name](spark, SF).toPandas()
    assert sorted(actual.columns) == sorted(expected.columns)
    assert comparable(actual) == comparable(expected)


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    rows = entry_points.entry(spark).collect()
    assert 0 < len(rows) <= 20
    assert all(r.severity in {"INFO", "WARNING", "CRITICAL"} and r.n_families == 9 for r in rows)
