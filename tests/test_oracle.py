"""Every query of the library against its SQL, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

from taxaspark import queries as library

TABLES = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in TABLES.glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(library.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = library.queries()[name](spark, str(TABLES))
    columns = sorted(df.columns)
    got = sorted(map(repr, map(tuple, df.select(columns).collect())))
    rel = duck.execute(library.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
