"""The fold of accepted closes against a plain loop, in blocks of all kinds, and the rule inside validation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickertide.functions import rules
from tickertide.operators import folds
from tickertide.operators import records as P


def plain(rows, most=20.0):
    """rows (symbol, ts, close, ok) in order -> [(last, accepted)]"""
    out, symbol, last = [], object(), None
    for name, _, close, ok in rows:
        if name != symbol:
            symbol, last = name, None
        good = bool(ok) and close is not None and close > 0 and (last is None or not abs(close - last) / last * 100 > most)
        out.append((last, good))
        last = close if good else last
    return out


def walk(rng, n, jumps=0.1):
    price, out = 100.0, []
    for _ in range(n):
        price = max(1.0, price * (1 + rng.uniform(-0.05, 0.05)))
        close = price * rng.choice([1.5, 0.5, 10]) if rng.random() < jumps else price
        out.append(rng.choice([None, 0.0, -3.0, float("nan")]) if rng.random() < 0.05 else close)
    return out


def test_accept_equals_the_loop():
    rng = random.Random(4)
    for n in (0, 1, 2, 5, 500):
        for jumps in (0.0, 0.1, 0.6):
            closes, oks = walk(rng, n, jumps), [rng.random() < 0.9 for _ in range(n)]
            for last in (None, 50.0):
                held, want = last, []
                for c, ok in zip(closes, oks, strict=True):
                    good = ok and c is not None and c > 0 and (held is None or not abs(c - held) / held * 100 > 20)
                    want.append((held, good))
                    held = c if good else held
                before, accepted, end = folds.accept(np.array([np.nan if c is None else c for c in closes], float), np.array(oks, bool), last)
                assert [(None if np.isnan(b) else b, bool(a)) for b, a in zip(before, accepted, strict=True)] == want and end == held


def frame(spark, rows):
    return spark.createDataFrame(rows, "symbol string, bar_ts long, close double, ok boolean, part long, last_close string")


@pytest.mark.parametrize("blocks", [None, 1, 7, 40])
def test_blocks_equal_the_loop(spark, blocks):
    """One symbol with most bars; runs of rejected bars longer than a block, so that guesses fail again and again."""
    rng = random.Random(5)
    rows = [("A", i, c) for i, c in enumerate(walk(rng, 600))] + [(s, i, c) for s in ("B", None, "C", "D") for i, c in enumerate(walk(rng, 25))]
    rows += [("Z", i, 100.0 if i < 3 or i > 90 else 300.0) for i in range(100)]  # a block on its own would take 300
    rows = [(*r, rng.random() < 0.95) for r in rows]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    want = {(r[0], r[1]): w for r, w in zip(order, plain(order), strict=True)}
    mixed = [(*r, 1, "x") for r in rows]
    rng.shuffle(mixed)
    got = {(r["symbol"], r["bar_ts"]): (r["last_close"], r["accepted"]) for r in folds.with_last_valid(frame(spark, mixed), blocks=blocks).collect()}
    assert got == want


def test_closes_at_and_below_zero(spark):
    rows = [("A", 0, 0.0, True), ("A", 1, -5.0, True), ("A", 2, 10.0, True), ("A", 3, 0.0, True), ("A", 4, 11.0, True), ("A", 5, 10.5, None)]
    got = folds.with_last_valid(frame(spark, [(*r, 1, "x") for r in rows])).orderBy("bar_ts").collect()
    assert [r["accepted"] for r in got] == [False, False, True, False, True, False]
    assert [r["last_close"] for r in got] == [None, None, None, 10.0, 10.0, 11.0]
    assert got[0].asDict().keys() == {"symbol", "bar_ts", "close", "ok", "part", "last_close", "accepted"}
    assert folds.with_last_valid(frame(spark, [])).count() == 0
    assert spark.range(1).select(rules.change_percent(F.lit(5.0), F.lit(0.0)).alias("p")).first()["p"] is None


def test_sudden_change_in_validation(spark):
    """100, 131 and 110 pass all other rules; 131 is no base for what follows."""
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    start = 1706659200000 - 3600000

    def message(k, close, symbol="abc", **more):
        fields = {"symbol": f'"{symbol}"', "close": close, "timestamp": start + k * 1000, "collection_timestamp": '"2024-01-31T00:00:00Z"', **more}
        return (",".join(f'"{n}":{v}' for n, v in fields.items()),)

    rows = [message(0, 100.0), message(1, 131.0), message(2, 110.0), message(3, 0.0), message(4, 88.5, volume=-1), message(5, 131.0), message(6, 131.0, "xyz")]
    raw = spark.createDataFrame([("{" + v + "}",) for (v,) in rows], "value string")
    for blocks in (None, 5):
        got = {(r["symbol"], int(r["timestamp"]) - start): r["errors"] for r in P.validate_bars_in_order(P.classify_payload(raw), now, blocks).collect()}
        assert got["ABC", 0] == got["ABC", 2000] == got["ABC", 5000] == got["XYZ", 6000] == []
        assert got["ABC", 1000] == ["Business rule error: Suspicious price change of 31.00%"]
        assert len(got["ABC", 3000]) == 1 and "price_bounds" in got["ABC", 3000][0]
        assert len(got["ABC", 4000]) == 1 and got["ABC", 4000][0].startswith("Schema error")
