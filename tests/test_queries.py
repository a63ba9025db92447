"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

from pathlib import Path

import pytest

from weftline.registry import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    rows, columns = df.collect(), sorted(df.columns)
    assert rows
    if name in oracle_sql():
        found = duck.execute(oracle_sql()[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        want = sorted("|".join(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
        assert sorted("|".join(plain(r[c]) for c in columns) for r in rows) == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
