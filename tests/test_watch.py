"""Watched bars over restarts: state goes on, silent symbols are reported and then forgotten."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickertide.streaming import stream, watch


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(watch.STATE_STORE[0])
    spark.conf.set(*watch.STATE_STORE)
    yield
    spark.conf.set(watch.STATE_STORE[0], before)


def test_silent_symbols_expire(spark, tmp_path, rocks):
    start, done = dt.datetime(2024, 1, 1), []

    def run(k, bars):
        rows = [(s, start + dt.timedelta(hours=h), c, True) for s, h, c in bars]
        spark.createDataFrame(rows, "symbol string, bar_ts timestamp, close double, ok boolean").write.parquet(f"{tmp_path}/in/part={k}")
        df = spark.readStream.schema("symbol string, bar_ts timestamp, close double, ok boolean, part int").parquet(f"{tmp_path}/in").drop("part")
        query = stream.start(watch.watch_bars(df, 3600, 4 * 3600, "0 seconds"), lambda batch, i: batch.write.mode("append").parquet(f"{tmp_path}/out/run={k}"), f"{tmp_path}/check")
        query.awaitTermination()
        out = spark.read.schema("symbol string, bar_ts timestamp, accepted boolean, absent boolean, last_close double").parquet(f"{tmp_path}/out/run={k}") if (tmp_path / f"out/run={k}").exists() else None
        done[:] = [query.recentProgress[-1].stateOperators[0].numRowsTotal]
        return sorted((r["symbol"], int((r["bar_ts"] - start).total_seconds() // 3600), r["accepted"], r["absent"]) for r in out.collect())

    assert run(0, [("A", 0, 100.0), ("B", 0, 50.0), ("B", 1, 51.0)])[:3] == [("A", 0, True, False), ("A", 1, False, True), ("B", 0, True, False)]
    # A goes on from its state: 150 is too far from 100; B is silent, its bars of 2 to 5 are missed, then it is forgotten
    second = run(1, [("A", h, 150.0 if h < 5 else 101.0) for h in range(2, 12)])
    assert [r[1:] for r in second if r[0] == "A" and not r[3]] == [(h, h >= 5, False) for h in range(2, 12)]
    assert [r[1] for r in second if r[0] == "B"] == [2, 3, 4, 5] and all(r[3] for r in second if r[0] == "B")
    # B comes back far from where it was and begins anew
    third = run(2, [("B", 12, 500.0), ("A", 12, 102.0)])
    assert ("B", 12, True, False) in third and ("A", 12, True, False) in third
