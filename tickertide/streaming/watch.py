"""Bars of a stream, judged against the last accepted close of their symbol, and a report of bars that did not come.

State is one small row a symbol. It goes when a symbol has been silent for long, so it is bounded by the symbols that
are alive, and a symbol that comes back begins anew. It needs Spark's RocksDB state store (STATE_STORE).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickertide.operators.folds import MAX_PERCENT, accept

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
SCHEMA = "symbol string, bar_ts timestamp, close double, ok boolean, last_close double, accepted boolean, absent boolean"
_COLUMNS = ["symbol", "bar_ts", "close", "ok", "last_close", "accepted", "absent"]


def _ms(at: pd.Timestamp) -> int:
    return at.value // 1_000_000


class BarWatch(StatefulProcessor):
    def __init__(self, every_ms: int, idle_ms: int, max_percent: float = MAX_PERCENT):
        self.every, self.idle, self.max_percent = every_ms, idle_ms, max_percent

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "close double")
        self.newest = handle.getValueState("newest", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bars = pd.concat(list(rows)).sort_values(["bar_ts", "close"])
        close, ok = bars["close"].to_numpy(float, na_value=float("nan")), bars["ok"].fillna(False).to_numpy(bool)
        before, accepted, last = accept(close, ok, self.last.get()[0] if self.last.exists() else None, self.max_percent)
        if last is not None:
            self.last.update((last,))
        newest = max(_ms(bars["bar_ts"].max()), self.newest.get()[0] if self.newest.exists() else 0)
        self.newest.update((newest,))
        self._expect(newest + self.every)
        yield bars.assign(last_close=before, accepted=accepted, absent=False)[_COLUMNS]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, now, newest = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs(), self.newest.get()[0]
        missed = []
        while at <= now and at - newest <= self.idle:
            missed.append(at)
            at += self.every
        last = self.last.get()[0] if self.last.exists() else None
        if at - newest <= self.idle:
            self._expect(at)
        else:
            self.last.clear()
            self.newest.clear()
        found = pd.DataFrame({"symbol": [key[0]] * len(missed), "bar_ts": pd.to_datetime(missed, unit="ms"), "close": float("nan"), "ok": False, "last_close": last, "accepted": False, "absent": True})
        yield found.astype({"last_close": float})[_COLUMNS]

    def _expect(self, at: int) -> None:
        """One timer a symbol: for its next bar."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def watch_bars(bars: DataFrame, every_seconds: int = 3600, idle_seconds: int = 86400, late: str = "2 hours", max_percent: float = MAX_PERCENT) -> DataFrame:
    """A stream of bars (symbol, bar_ts, close, ok) -> the same with last_close, accepted, and absent: true for a row that
    stands for a bar that had not come when the watermark passed its time, up to idle_seconds after a symbol's newest."""
    rows = bars.select("symbol", "bar_ts", "close", "ok").withWatermark("bar_ts", late)
    return rows.groupBy("symbol").transformWithStateInPandas(BarWatch(every_seconds * 1000, idle_seconds * 1000, max_percent), SCHEMA, "append", "eventTime")
