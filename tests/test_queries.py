"""Every registered query of the library against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tickertide.plans.registry import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v + 0.0:.5f}"
    return None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str)
    if name not in ORACLE_SQL:
        assert rows
        return
    found = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)
    assert sorted(names) == columns
    assert rows == want
