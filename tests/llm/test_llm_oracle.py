"""The corpus queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from brackwater.llm import queries

SF = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cur = con.execute(f"select {', '.join(columns)} from ({queries.ORACLE_SQL[name]})")
    assert {c: TYPES[t] for c, t in df.dtypes} == {c[0]: str(c[1]) for c in cur.description}
    plain = [[tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows] for rows in (cur.fetchall(), df.select(*columns).collect())]
    want, got = (sorted(rows, key=str) for rows in plain)
    assert got == want


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
