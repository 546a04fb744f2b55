"""The operator queries that SQL can express, against their SQL, and the contracts of the others."""

import duckdb
import pytest

import __spark_entry__
from callweave.llm import registry

DATA = "/root/testdata/sf0.001"


def rows_of(table):
    names = sorted(table.column_names)
    cell = lambda v: round(v, 6) if isinstance(v, float) else v
    return names, sorted((tuple(map(cell, r)) for r in zip(*(table.column(n).to_pylist() for n in names), strict=True)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for name_of in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{DATA}/{name_of}.parquet'")
    assert rows_of(registry.queries()[name](spark, DATA).toArrow()) == rows_of(con.execute(registry.oracle_sql()[name]).to_arrow_table())


def test_registration():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()


def test_token_rollup_query_sums_the_exact_counts(spark):
    from callweave.llm import tokens

    docs = spark.read.parquet(f"{DATA}/documents.parquet").toPandas()
    got = {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in registry.queries()["op2_token_rollup"](spark, DATA).collect()}
    want = {}
    for r in docs.itertuples():
        for v in ("byte_bpe_50k", "byte_bpe_multi_50k"):
            n = len(tokens.token_ids(r.text, v))
            if n >= registry.LEAST_TOKENS:
                d, t = want.get((r.source, r.lang, v), (0, 0))
                want[(r.source, r.lang, v)] = (d + 1, t + n)
    assert got == {k: v for k, v in want.items() if v != (0, 0)}
