"""Bars and indicators. Row windows go by symbol and bar_ts, in blocks of rows with those before each copied in."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, log

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.functions.rules import rule_ohlc

#: Rows of a symbol in a block.
BLOCK = 50_000
_KEYS = ("symbol", "_block")


def in_order():
    """The rows of a block in time; only inside in_blocks()."""
    return Window.partitionBy(*_KEYS).orderBy("bar_ts")


def last_rows(n: int):
    return in_order().rowsBetween(-(n - 1), 0)


def rows_before(n: int):
    return in_order().rowsBetween(-n, -1)


def in_blocks(bars: DataFrame, before: int, f: Callable[[DataFrame], DataFrame], size: int = BLOCK) -> DataFrame:
    """f of bars, whose windows reach back `before` rows of a symbol, over blocks of rows instead of whole symbols.

    A symbol's rows are numbered (by what the days before hold and by the place in the day) and cut into blocks of
    `size`; the last `before` rows of a block stand in the next one too, as copies, which f sees and which go afterwards.
    So one symbol fills as many tasks as it has blocks, and each row is sent twice at most. f keeps the columns _block
    and _copy; null times come first.
    """
    size = max(size, before, 1)
    rows = bars.withColumn("_day", F.coalesce(F.to_date("bar_ts"), F.lit("0001-01-01").cast("date")))
    days = rows.groupBy(F.col("symbol").alias("_s"), F.col("_day").alias("_d")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("_s").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_s", "_d", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_base"))
    rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy("symbol", "_day").orderBy("bar_ts")) - 1)
    rows = rows.join(days, F.col("symbol").eqNullSafe(F.col("_s")) & (F.col("_day") == F.col("_d"))).withColumn("_at", F.col("_at") + F.col("_base"))
    own = F.floor(F.col("_at") / size)
    homes = F.when(F.col("_at") % size >= size - before, F.array(own, own + 1)).otherwise(F.array(own))
    rows = rows.withColumn("_own", own).withColumn("_block", F.explode(homes)).withColumn("_copy", F.col("_block") != F.col("_own"))
    return f(rows.drop("_day", "_s", "_d", "_base", "_at", "_own")).where(~F.col("_copy")).drop("_block", "_copy")


def lagged(bars: DataFrame, column: str, name: str, size: int = BLOCK) -> DataFrame:
    """bars with a column's value one row before."""
    return in_blocks(bars, 1, lambda rows: rows.withColumn(name, F.lag(column).over(in_order())), size)


def _full(value: Column, n: int, w) -> Column:
    """value where the frame holds n rows, else null."""
    return F.when(F.count(F.lit(1)).over(w) >= n, value)


def filter_bars(bars: DataFrame) -> DataFrame:
    """Complete bars whose prices and volume make sense."""
    whole = [F.col(c).isNotNull() for c in ("open", "high", "low", "close", "volume", "symbol")]
    ok = F.col("volume") >= 0
    for c in whole:
        ok = ok & c
    return bars.where(ok & rule_ohlc(F.col("open"), F.col("high"), F.col("low"), F.col("close")).isNull())


def resample(ticks: DataFrame, unit: str) -> DataFrame:
    """Ticks (symbol, ts, price, event_id) to bars of a minute, hour, day, week, month, quarter or year."""
    order = F.struct("ts", "event_id")
    return ticks.groupBy("symbol", F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("bar_ts")).agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.count("*").alias("volume"))


def rebar(bars: DataFrame, unit: str) -> DataFrame:
    """Bars to longer bars."""
    return bars.groupBy("symbol", F.date_trunc(unit, "bar_ts").cast("timestamp_ntz").alias("bar_ts")).agg(F.min_by("open", F.col("bar_ts")).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", F.col("bar_ts")).alias("close"), F.sum("volume").alias("volume"))


def _log_return() -> Column:
    return F.log(F.col("close") / F.lag("close").over(in_order()))


def log_returns(bars: DataFrame, size: int = BLOCK) -> DataFrame:
    return in_blocks(bars, 1, lambda rows: rows.withColumn("log_return", _log_return()), size)


def sma(bars: DataFrame, n: int, size: int = BLOCK) -> DataFrame:
    return in_blocks(bars, n - 1, lambda rows: rows.withColumn("sma", _full(F.avg("close").over(last_rows(n)), n, last_rows(n))), size)


def _volatility(rows: DataFrame, n: int) -> DataFrame:
    w = last_rows(n)
    rows = rows.withColumn("log_return", _log_return())
    return rows.withColumn("volatility", F.when(F.count("log_return").over(w) >= n, F.stddev_samp("log_return").over(w)))


def volatility(bars: DataFrame, n: int, size: int = BLOCK) -> DataFrame:
    """Sample deviation of log returns; null until n returns are there."""
    return in_blocks(bars, n, lambda rows: _volatility(rows, n), size)


def reach(n: int) -> int:
    """Rows after which what came before weighs less in an exponential mean than a double can hold: (1 - 2 / (n + 1)) ** rows < 2 ** -60."""
    return ceil(60 * log(2) / -log(1 - 2 / (n + 1))) if n > 1 else 1


def ema_columns(bars: DataFrame, spans: dict[str, int], of: str = "close", size: int = BLOCK) -> DataFrame:
    """symbol, bar_ts, x (the column) and exponential means of each symbol in order of time: e0 = x0, then e + 2 / (n + 1) * (x - e).

    Blocks start from so many rows before them that nothing earlier is left in the mean, so no block waits for another.
    Rows without a value are left out.
    """
    kinds = {c: bars.schema[k].dataType.simpleString() for c, k in (("symbol", "symbol"), ("bar_ts", "bar_ts"), ("x", of))}
    weights = [2 / (n + 1) for n in spans.values()]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, means = None, []
        for batch in batches:
            out = [[] for _ in weights]
            for symbol, block, x in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(2).cast(pa.float64()).to_pylist(), strict=True):
                if (symbol, block) != at:
                    at, means = (symbol, block), [x] * len(weights)
                else:
                    means = [e + w * (x - e) for e, w in zip(means, weights, strict=True)]
                for column, e in zip(out, means, strict=True):
                    column.append(e)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.float64()) for c in out)], [*batch.schema.names, *spans])

    def run(rows: DataFrame) -> DataFrame:
        rows = rows.select("symbol", "bar_ts", "x", "_block", "_copy").repartition(*_KEYS).sortWithinPartitions(*_KEYS, "bar_ts")
        return rows.mapInArrow(fold, ", ".join([*(f"{c} {k}" for c, k in kinds.items()), "_block long, _copy boolean", *(f"`{c}` double" for c in spans)]))

    return in_blocks(bars.where(F.col(of).isNotNull()).select("symbol", "bar_ts", F.col(of).alias("x")), max(map(reach, spans.values())), run, size)


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, size: int = BLOCK) -> DataFrame:
    lines = ema_columns(bars, {"fast": fast, "slow": slow}, size=size).withColumn("macd", F.col("fast") - F.col("slow"))
    signals = ema_columns(lines, {"signal": signal}, of="macd", size=size).select("symbol", "bar_ts", "signal")
    return lines.join(signals, ["symbol", "bar_ts"]).withColumn("histogram", F.col("macd") - F.col("signal"))


def rsi(bars: DataFrame, n: int = 14, size: int = BLOCK) -> DataFrame:
    def run(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_d", F.col("close") - F.lag("close").over(in_order()))
        w = last_rows(n)
        gain, loss = F.avg(F.greatest("_d", F.lit(0.0))).over(w), F.avg(F.greatest(-F.col("_d"), F.lit(0.0))).over(w)
        return rows.withColumn("rsi", F.when(F.count("_d").over(w) >= n, F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + gain / loss)))).drop("_d")

    return in_blocks(bars, n, run, size)


def bollinger(bars: DataFrame, n: int = 20, k: float = 2.0, size: int = BLOCK) -> DataFrame:
    def run(rows: DataFrame) -> DataFrame:
        w = last_rows(n)
        mean, dev = F.avg("close").over(w), F.stddev_pop("close").over(w)
        return rows.withColumn("middle", _full(mean, n, w)).withColumn("upper", _full(mean + k * dev, n, w)).withColumn("lower", _full(mean - k * dev, n, w))

    return in_blocks(bars, n - 1, run, size)


def vwap(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol", F.to_date("bar_ts").alias("date")).agg((F.sum(F.col("close") * F.col("volume")) / F.sum("volume")).alias("vwap"), F.sum("volume").alias("volume"))


def volume_profile(bars: DataFrame, bins: int, low: float, high: float) -> DataFrame:
    return bars.groupBy("symbol", F.width_bucket("close", F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.sum("volume").alias("volume"))


def zscore(bars: DataFrame, n: int, size: int = BLOCK) -> DataFrame:
    def run(rows: DataFrame) -> DataFrame:
        w = last_rows(n)
        dev = F.stddev_samp("close").over(w)
        return rows.withColumn("zscore", F.when(F.count(F.lit(1)).over(w) >= n, F.when(dev > 0, (F.col("close") - F.avg("close").over(w)) / dev)))

    return in_blocks(bars, n - 1, run, size)


def minmax(bars: DataFrame, n: int, size: int = BLOCK) -> DataFrame:
    def run(rows: DataFrame) -> DataFrame:
        w = last_rows(n)
        span = F.max("close").over(w) - F.min("close").over(w)
        return rows.withColumn("minmax", F.when(span > 0, (F.col("close") - F.min("close").over(w)) / span))

    return in_blocks(bars, n - 1, run, size)


def outliers(bars: DataFrame, n: int, k: float = 3.0, size: int = BLOCK) -> DataFrame:
    """Against the n rows before, which must all be there."""

    def run(rows: DataFrame) -> DataFrame:
        w = rows_before(n)
        z = (F.col("close") - F.avg("close").over(w)) / F.nullif(F.stddev_samp("close").over(w), F.lit(0.0))
        return rows.withColumn("z", F.when(F.count(F.lit(1)).over(w) >= n, z)).withColumn("outlier", F.coalesce(F.abs("z") > k, F.lit(False)))

    return in_blocks(bars, n, run, size)


def spikes(bars: DataFrame, n: int, k: float = 2.0, of: str = "volume", size: int = BLOCK) -> DataFrame:
    def run(rows: DataFrame) -> DataFrame:
        w = rows_before(n)
        return rows.withColumn("spike", F.coalesce((F.count(F.lit(1)).over(w) >= n) & (F.col(of) > k * F.avg(of).over(w)), F.lit(False)))

    return in_blocks(bars, n, run, size)


def gaps(bars: DataFrame, seconds: int = 3600, size: int = BLOCK) -> DataFrame:
    """Where a symbol's next bar is missing: from, to, and how many bars are absent."""
    rows = lagged(bars.select("symbol", "bar_ts"), "bar_ts", "gap_from", size).select("symbol", "gap_from", F.col("bar_ts").alias("gap_to"))
    step = F.unix_timestamp(F.col("gap_to").cast("timestamp")) - F.unix_timestamp(F.col("gap_from").cast("timestamp"))
    return rows.where(step > seconds).withColumn("missing", F.expr(f"(unix_timestamp(cast(gap_to as timestamp)) - unix_timestamp(cast(gap_from as timestamp))) div {seconds} - 1"))


def filled_calendar(bars: DataFrame, seconds: int = 3600, size: int = BLOCK) -> DataFrame:
    """bars with a row for each absent bar between two present ones; its other columns are null and absent is true."""
    step = F.expr(f"INTERVAL {seconds} SECONDS")
    missing = lagged(bars.select("symbol", "bar_ts"), "bar_ts", "a", size).withColumnRenamed("bar_ts", "b").where(F.col("b") > F.col("a") + step)
    rows = missing.select("symbol", F.explode(F.sequence(F.col("a") + step, F.col("b"), step)).alias("bar_ts"), "b").where("bar_ts < b").drop("b")
    return bars.withColumn("absent", F.lit(False)).unionByName(rows.withColumn("absent", F.lit(True)), allowMissingColumns=True)


def regime(bars: DataFrame, n: int = 20, history: int = 100, size: int = BLOCK) -> DataFrame:
    """high where volatility exceeds its median over the rows before."""

    def run(rows: DataFrame) -> DataFrame:
        rows = _volatility(rows, n)
        usual = F.percentile("volatility", F.lit(0.5)).over(rows_before(history))
        return rows.withColumn("regime", F.when(F.col("volatility").isNull() | usual.isNull(), None).when(F.col("volatility") > usual, "high").otherwise("low"))

    return in_blocks(bars, n + history, run, size)
