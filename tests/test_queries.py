"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from goldleaf import catalog, oracle

DATA = Path("/root/testdata/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, db, name):
    df = QUERIES[name](spark, str(DATA))
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["sentiment", "n"] and entry.entry(spark).count() == 3
