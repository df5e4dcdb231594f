"""Streaming forms: checkpointed queries, dual writes, keyed validation state, windowed counts and de-duplication."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickertide.operators.folds import accept
from tickertide.operators.records import parse_posts
from tickertide.operators.sentiment import ticker_rows


def start(df: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None):
    """A query with a stable checkpoint; without an interval it takes what is there and ends."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def dual_write(df: DataFrame, first: Callable[[DataFrame, int], None], second: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None):
    """Two sinks from one query: the chain before them runs once a batch."""

    def both(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            first(kept, batch_id)
            second(kept, batch_id)
        finally:
            kept.unpersist()

    return start(df, both, checkpoint, every)


def sentiment_job(raw: DataFrame, score: Callable[[DataFrame], DataFrame], posts: Callable[[DataFrame, int], None], tickers: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None):
    """The whole job: messages (value) are parsed and scored, and each batch goes to a store of posts and to one of ticker sentiments."""
    scored = score(parse_posts(raw))
    return dual_write(scored, posts, lambda batch, i: tickers(ticker_rows(batch), i), checkpoint, every)


def write_routed(df: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], checkpoint: str, every: str | None = None):
    """A stream with the column topic of route(): each batch is kept once and each sink is given the rows of its topic."""

    def all_of(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for topic, sink in sinks.items():
                sink(kept.where(F.col("topic") == topic), batch_id)
        finally:
            kept.unpersist()

    return start(df, all_of, checkpoint, every)


def await_any(spark: SparkSession, timeout: int | None = None) -> None:
    """Wait for the first query to end, then stop the others."""
    spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()
    for q in spark.streams.active:
        q.stop()


def validate_bars_stream(df: DataFrame, max_percent: float = 20.0) -> DataFrame:
    """df (symbol, bar_ts, close, ok) -> the same with last_close and accepted; the last accepted close is kept by symbol over batches and runs."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(["bar_ts", "close"])
        close, ok = rows["close"].to_numpy(float, na_value=float("nan")), rows["ok"].fillna(False).to_numpy(bool)
        before, accepted, last = accept(close, ok, state.get[0] if state.exists else None, max_percent)
        if last is not None:
            state.update((last,))
        yield rows.assign(last_close=before, accepted=accepted)[["symbol", "bar_ts", "close", "ok", "last_close", "accepted"]]

    rows = df.select("symbol", "bar_ts", "close", "ok")
    return rows.groupBy("symbol").applyInPandasWithState(fold, "symbol string, bar_ts timestamp, close double, ok boolean, last_close double, accepted boolean", "last double", "append", GroupStateTimeout.NoTimeout)


def stream_bars(ticks: DataFrame, every: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Bars of a tick stream (symbol, ts, price, event_id); a bar is given once the watermark has passed it."""
    order = F.struct("ts", "event_id")
    a = ticks.withWatermark("ts", late).groupBy("symbol", F.window("ts", every).alias("w")).agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.count("*").alias("volume"))
    return a.select("symbol", F.col("w.start").alias("bar_ts"), "open", "high", "low", "close", "volume")


def stream_stats(routed: DataFrame, every: str = "60 seconds", late: str = "2 minutes") -> DataFrame:
    a = routed.withWatermark("ts", late).groupBy(F.window("ts", every).alias("w")).agg(F.count("*").alias("processed"), F.count_if(F.col("outcome") == "valid").alias("valid"), F.count_if(F.col("outcome") == "invalid").alias("invalid"), F.count_if(F.col("outcome") == "error").alias("errors"))
    return a.select(F.col("w.start").alias("start"), "processed", "valid", "invalid", "errors")


OUTCOMES = ("valid", "invalid", "error")


def live_counts(routed: DataFrame, name: str = "outcomes") -> DataFrame:
    """routed (outcome) as it is, counted on the way: each micro-batch, or the one run of a table, reports processed and
    each of OUTCOMES under the name. Nothing is shuffled or kept; read them with LiveStats or from the query's progress."""
    return routed.observe(name, F.count(F.lit(1)).alias("processed"), *(F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES))


class LiveStats(StreamingQueryListener):
    """Sums what live_counts() reports, and calls `tell` with each batch's id, its counts and the sums so far.

    A batch that is run again after a failure counts once, by its query and id.
    """

    def __init__(self, name: str = "outcomes", tell: Callable[[int, dict, dict], None] | None = None):
        self.name, self.tell, self.batches = name, tell, {}

    @property
    def totals(self) -> dict[str, int]:
        return {k: sum(b[k] for b in self.batches.values()) for k in ("processed", *OUTCOMES)}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            counts = found.asDict()
            self.batches[str(event.progress.id), event.progress.batchId] = counts
            if self.tell:
                self.tell(event.progress.batchId, counts, self.totals)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def stream_dedup(df: DataFrame, key: str, ts: str = "ts", late: str = "1 day") -> DataFrame:
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def fresh_counts(rows: DataFrame, key: str, now: Column, ts: str = "ts", every: str = "60 seconds", late: str = "1 hour", max_age_hours: int = 48, skew_minutes: int = 5) -> DataFrame:
    """rows (key, ts, outcome) of a stream: those neither too old nor ahead of now, each key once, counted by period.

    One watermark bounds the keys that are held and closes the periods: a row that is later than that against what
    has come counts no more.
    """
    held = drop_late(rows, ts, now, max_age_hours, skew_minutes, late).dropDuplicatesWithinWatermark([key])
    counted = held.groupBy(F.window(ts, every).alias("w")).agg(F.count("*").alias("processed"), *(F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES))
    return counted.select(F.col("w.start").alias("start"), "processed", *OUTCOMES)


def drop_late(df: DataFrame, ts: str, now, max_age_hours: int = 48, skew_minutes: int = 5, late: str = "2 days") -> DataFrame:
    """Rows neither too old nor too far ahead, with a watermark so that later state stays bounded."""
    t = F.col(ts)
    return df.where((t >= now - F.expr(f"INTERVAL {max_age_hours} HOURS")) & (t <= now + F.expr(f"INTERVAL {skew_minutes} MINUTES"))).withWatermark(ts, late)
