import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def canonical(frame, columns):
    plain = lambda v: None if v is None or v != v else float(v) if isinstance(v, (int, float)) else str(v)
    return sorted(repr(tuple(map(plain, r))) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, duck, name):
    ours, theirs = entry.queries()[name](spark, FOLDER).toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours, sorted(ours.columns)) == canonical(theirs, sorted(ours.columns))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
