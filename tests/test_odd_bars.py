"""Queries on bars whose ticks are odd, against their SQL."""

from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.test_queries import plain
from tickertide.plans.registry import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def odd_ticks(spark, tmp_path_factory):
    """Ticks of 0, below 0 and above a million in recent hours, ticks of one instant, and symbols that are too long or missing."""
    path, start, rows = str(tmp_path_factory.mktemp("odd")), datetime(2024, 1, 29, 12), []
    for k, symbol in enumerate(("view", "click", "much_too_long_a_symbol", None)):
        for h in range(24):
            at = start + timedelta(hours=h)
            rows += [(len(rows) + i, at + timedelta(minutes=i // 2), 7, symbol, v, "{}") for i, v in enumerate((10.0 + k, 11.0, 12.0, 10.5, 11.5 + h % 3))]
            if h in (5, 11, 14):
                rows.append((len(rows), at + timedelta(minutes=1), 7, symbol, {5: 0.0, 11: 2e6, 14: -1.0}[h], "{}"))
    table = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    table.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{path}/events.parquet")
    return path


def both(spark, path, name):
    """The sorted rows of the query and of its SQL."""
    got = QUERIES[name](spark, path)
    columns = sorted(got.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet/*.parquet'")
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=str)
    return sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str), want


@pytest.mark.parametrize("name", ["r1_route", "r1_route_stream", "v26_validate_bars"])
def test_odd_bars(spark, odd_ticks, name):
    rows, want = both(spark, odd_ticks, name)
    assert rows and rows == want


def test_odd_bars_in_order(spark, odd_ticks, tmp_path):
    """Bars without a symbol are judged as well, and two spellings of a symbol are one, in order of the closes where their hours are equal."""
    ticks = spark.read.parquet(f"{odd_ticks}/events.parquet")
    other = ticks.where("event_type = 'view'").selectExpr("event_id + 100000 AS event_id", "ts", "user_id", "'View' AS event_type", "value * 1.15D AS value", "props")
    ticks.unionByName(other).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows, want = both(spark, str(tmp_path), "v26_validate_bars_in_order")
    assert rows == want
    assert any(r[1] is None for r in rows) and any("Suspicious" in r[0] for r in rows)
