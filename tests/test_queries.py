"""Every query against its SQL in DuckDB, on the smallest test tables."""

import os

import duckdb
import pytest

from paperloom.plans import algorithm_queries, bindings, contract_queries, payload_queries, rule_queries  # noqa: F401 - the others add their queries to the first's

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    return c


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    got = bindings.QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    clean = lambda rows: sorted(tuple("" if v is None else str(v) for v in r) for r in rows)
    names = ", ".join(f'"{c}"' for c in cols)
    want = con.execute(f"SELECT {names} FROM ({bindings.SQL[name]})").fetchall()
    assert clean(got.select(*cols).collect()) == clean(want)


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(bindings.QUERIES) <= set(entry.queries())
