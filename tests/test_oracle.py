"""Every registered query with SQL against that SQL in DuckDB, on the same files."""

import glob
import os

import duckdb
import pytest

from ledgerframe import catalog

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple("null" if r[k] is None else str(r[k]).lower() if isinstance(r[k], bool) else str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rel = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = plain(df.collect(), df.columns), plain(rel.fetchall(), rel.columns)
    assert len(got) == len(want) and got == want


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
