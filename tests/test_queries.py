"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from callweave import registry

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(table):
    names = sorted(table.column_names)
    cell = lambda v: round(v, 6) if isinstance(v, float) else v
    return names, sorted((tuple(map(cell, r)) for r in zip(*(table.column(n).to_pylist() for n in names), strict=True)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = rows_of(registry.queries()[name](spark, str(DATA)).toArrow())
    if name in registry.oracle_sql():
        assert got == rows_of(duck.execute(registry.oracle_sql()[name]).to_arrow_table())
    else:
        assert got[1]


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry_point(spark):
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries()) and __spark_entry__.entry(spark).columns[:3] == ["language", "fqcn", "method"]
