"""Indicators in blocks against the same over whole symbols, which test_queries compares with SQL."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tickertide.operators import bars as B

CASES = {
    "sma": lambda b, k: B.sma(b, 10, k), "volatility": lambda b, k: B.volatility(b, 12, k), "returns": B.log_returns, "rsi": lambda b, k: B.rsi(b, 14, k),
    "bollinger": lambda b, k: B.bollinger(b, 9, 2.0, k), "zscore": lambda b, k: B.zscore(b, 8, k), "minmax": lambda b, k: B.minmax(b, 8, k), "outliers": lambda b, k: B.outliers(b, 11, 2.0, k),
    "spikes": lambda b, k: B.spikes(b, 6, 1.5, "volume", k), "gaps": lambda b, k: B.gaps(b, 3600, k), "calendar": lambda b, k: B.filled_calendar(b, 3600, k), "regime": lambda b, k: B.regime(b, 5, 12, k), "ema": lambda b, k: B.ema_columns(b, {"a": 1, "b": 2, "c": 3}, size=k), "macd": lambda b, k: B.macd(b, 2, 3, 2, k),
}


@pytest.fixture(scope="module")
def bars(spark):
    rng, start = random.Random(6), datetime.datetime(2024, 1, 1)
    rows = []
    for symbol, n in (("A", 170), ("B", 9), (None, 30)):
        hour = 0
        for _ in range(n):
            hour += rng.choice([1, 1, 1, 2, 5, 30])
            close = round(rng.uniform(90, 110), 2)
            rows.append((symbol, start + datetime.timedelta(hours=hour), None if rng.random() < 0.03 else close, rng.randint(1, 100)))
    return spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, close double, volume long").cache()


def plain(df):
    value = lambda v: "none" if v is None else "nan" if isinstance(v, float) and math.isnan(v) else f"{v:.9f}" if isinstance(v, float) else str(v)
    return sorted(tuple(value(r[c]) for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("name", CASES)
def test_blocks_change_nothing(bars, name):
    whole = CASES[name](bars, 10**6)
    assert not {"_block", "_copy"} & set(whole.columns)
    assert plain(CASES[name](bars, 20)) == plain(whole)


def test_one_symbol_fills_many_blocks(bars):
    one = bars.where("symbol = 'A'")
    seen = B.in_blocks(one, 5, lambda rows: rows.withColumn("block", F.col("_block")).withColumn("n", F.count(F.lit(1)).over(B.last_rows(6))), 20).collect()
    assert len(seen) == 170 and len({r["block"] for r in seen}) == 9
    assert all(r["n"] == 6 for r in seen if r["block"]) and max(r["n"] for r in seen) == 6


def test_no_bars(bars):
    for case in CASES.values():
        assert case(bars.where("false"), 20).count() == 0
