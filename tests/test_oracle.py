"""Every registered query against DuckDB on the same tables."""

import datetime as dt
import decimal
import glob
import math
import os

import duckdb
import pytest

from brackwater.plans import registry

SF = "/root/testdata/sf0.001"
#: Where the small tables give no row, or a flag that never changes, a query could be wrong unseen: those run on this one.
LARGER = "/root/testdata/sf0.01"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def connected(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


@pytest.fixture(scope="module")
def ducks():
    return {folder: connected(folder) for folder in (SF, LARGER)}


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, ducks, name):
    sql = registry.ORACLE_SQL[name]
    for folder in (SF, LARGER):
        duck = ducks[folder]
        flags = [c[0] for c in duck.execute(f"describe {sql}").fetchall() if str(c[1]) == "BOOLEAN"]
        seen = duck.execute(f"select count(*), {', '.join(f'count(distinct {c})' for c in flags) or 2} from ({sql})").fetchone()
        if seen[0] and min(seen[1:]) > 1:
            break
    assert seen[0] > 0
    df = registry.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    kinds = {c[0]: c[1] for c in duck.execute(f"describe {sql}").fetchall()}
    assert sorted(kinds) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == {c: str(t) for c, t in kinds.items()}
    cur = duck.execute(sql)
    place = [[c[0] for c in cur.description].index(c) for c in columns]
    want = [tuple(plain(r[i]) for i in place) for r in cur.fetchall()]
    got = [tuple(plain(v) for v in r) for r in df.select(*columns).collect()]
    assert ordered(got) == ordered(want)


def test_queries_without_sql():
    """Checked against plain code elsewhere in the tests."""
    assert set(registry.QUERIES) - set(registry.ORACLE_SQL) == {"raster_regions"}


def test_raster_regions_equal_flood_fill(spark):
    value = {(r.row, r.col): r for r in registry.QUERIES["raster_regions"](spark, SF).collect()}
    seen = set()
    for start in sorted(value):
        if start in seen:
            continue
        region, todo = set(), [start]
        while todo:
            at = todo.pop()
            if at in region:
                continue
            region.add(at)
            todo += [p for dr, dc in ((0, 1), (1, 0), (0, -1), (-1, 0)) if (p := (at[0] + dr, at[1] + dc)) in value and value[p].value == value[at].value]
        seen |= region
        assert {value[p].region for p in region} == {start[0] * 2**31 + start[1]}
