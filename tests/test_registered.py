"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = "documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = contract.queries(), contract.oracle_sql()


def cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return (1, f"{float(value):.9g}")
    return (2, str(value))


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(tiny):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tiny}/{name}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, tiny, name):
    found = QUERIES[name](spark, tiny)
    rows = found.collect()
    assert len(set(found.columns)) == len(found.columns)
    if name in SQL:
        cursor = duck.execute(SQL[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == sorted(found.columns)
        assert table(found.columns, rows) == table(names, cursor.fetchall())
