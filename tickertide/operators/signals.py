"""Signals from scored posts, news and bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.config import SentimentConfig
from tickertide.functions.text import EMOJI, count_of, words
from tickertide.operators.sentiment import words_of
from tickertide.operators.tables import first_n_per_group, top

_CFG = SentimentConfig()


def term_share(df: DataFrame, terms: DataFrame, id_col: str, text: Column) -> DataFrame:
    """relevance of each row: matched words over all words, times 10, at most 1; texts without words have 0.
    Words are looked up where they are (terms: a vocabulary), so nothing is sent."""
    known = words_of(terms, "term")
    counted = df.select(id_col, F.coalesce(words(F.lower(text)), F.array().cast("array<string>")).alias("ws"))
    hits = F.size(F.filter("ws", lambda w: known.valence(w).isNotNull()))
    return counted.select(id_col, F.least(F.lit(1.0), 10.0 * hits / F.greatest(F.size("ws"), F.lit(1))).alias("relevance"))


def calibrate(df: DataFrame, calibration: DataFrame, score: str = "sentiment_score") -> DataFrame:
    """score * scale + bias of the row's community, clamped to -1 .. 1; others stay as they are."""
    value = F.col(score) * F.coalesce("scale", F.lit(1.0)) + F.coalesce("bias", F.lit(0.0))
    return df.join(calibration, "subreddit", "left").withColumn("calibrated", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))).drop("scale", "bias")


def quality_score(text: Column) -> Column:
    clamp = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    ramp = clamp((F.length(text) - 50) / 450.0)
    return clamp(ramp - F.when(count_of(text, EMOJI) > 3, 0.1).otherwise(0.0) + F.when(text.rlike(r"https?://"), 0.05).otherwise(0.0))


def meme_adjust(compound: Column, meme_compound: Column, has_meme: Column, w: float = 0.3) -> Column:
    return F.when(has_meme, (1 - w) * compound + w * meme_compound).otherwise(compound)


def exclude_common_words(mentions: DataFrame, common: DataFrame) -> DataFrame:
    return mentions.join(common.select(F.col("term").alias("ticker")).distinct(), "ticker", "left_anti")


def decayed_sentiment(rows: DataFrame, now: Column, cfg: SentimentConfig = _CFG, key: str = "ticker") -> DataFrame:
    """rows (key, score, ts in epoch seconds) -> key, sentiment, n."""
    age = (now.cast("long") - F.col("ts")) / 3600.0
    w = F.exp(-cfg.decay * age)
    return rows.where(age.between(0, cfg.max_age_hours)).groupBy(key).agg((F.sum(F.col("score") * w) / F.sum(w)).alias("sentiment"), F.count("*").alias("n"))


def source_weighted(rows: DataFrame, cfg: SentimentConfig = _CFG) -> DataFrame:
    """rows (ticker, source, score): the sources' means, weighted by what is present."""
    weight = F.lit(cfg.source_weights["other"])
    for name, w in cfg.source_weights.items():
        weight = F.when(F.col("source") == name, w).otherwise(weight)
    means = rows.groupBy("ticker", "source").agg(F.avg("score").alias("m")).withColumn("w", weight)
    return means.groupBy("ticker").agg((F.sum(F.col("m") * F.col("w")) / F.sum("w")).alias("sentiment"), F.count("*").alias("n_sources"))


def market_sentiment(decayed: DataFrame, k: int = 20) -> DataFrame:
    return top(decayed, k, "n", "ticker").agg((F.sum(F.col("sentiment") * F.col("n")) / F.sum("n")).alias("market_sentiment"), F.count("*").alias("n_tickers"))


def changes(daily: DataFrame, trend: float = 0.05, shift: float = 0.15) -> DataFrame:
    """daily (ticker, date, sentiment) -> trend, shift, velocity, acceleration, reversal against the days before."""
    w = Window.partitionBy("ticker").orderBy("date")
    rows = daily.withColumn("velocity", F.col("sentiment") - F.lag("sentiment").over(w))
    rows = rows.withColumn("acceleration", F.col("velocity") - F.lag("velocity").over(w))
    rows = rows.withColumn("reversal", F.coalesce(F.signum("velocity") * F.signum(F.lag("velocity").over(w)) < 0, F.lit(False)))
    rows = rows.withColumn("trend", F.when(F.col("velocity") >= trend, "up").when(F.col("velocity") <= -trend, "down").when(F.col("velocity").isNotNull(), "flat"))
    return rows.withColumn("shift", F.coalesce(F.abs("velocity") >= shift, F.lit(False)))


def extremes(daily: DataFrame, n: int = 20, k: float = 2.0) -> DataFrame:
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(-n, -1)
    z = (F.col("sentiment") - F.avg("sentiment").over(w)) / F.nullif(F.stddev_samp("sentiment").over(w), F.lit(0.0))
    return daily.withColumn("z", F.when(F.count(F.lit(1)).over(w) >= n, z)).withColumn("extreme", F.when(F.col("z") > k, "euphoria").when(F.col("z") < -k, "panic").otherwise("none"))


def consistency(rows: DataFrame) -> DataFrame:
    means = rows.groupBy("ticker", "source").agg(F.avg("score").alias("m"))
    return means.groupBy("ticker").agg((1 - F.least(F.lit(1.0), F.stddev_pop("m"))).alias("consistency"))


def volume_normalised(daily: DataFrame, n: int = 7) -> DataFrame:
    """daily (ticker, date, n): mentions over the mean of the rows before."""
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(-n, -1)
    return daily.withColumn("relative", F.col("n") / F.avg("n").over(w))


def news_timeseries(rows: DataFrame, every: str = "1 day") -> DataFrame:
    """rows (symbol, ts, score, magnitude, source, article_id) -> buckets with sorted sources and article ids."""
    a = rows.groupBy("symbol", F.window("ts", every).alias("w")).agg(F.avg("score").alias("sentiment_score"), F.avg("magnitude").alias("sentiment_magnitude"), F.count("*").alias("article_count"), F.array_sort(F.collect_set("source")).alias("sources"), F.array_sort(F.collect_list("article_id")).alias("article_ids"))
    return a.select("symbol", F.col("w.start").alias("start"), "sentiment_score", "sentiment_magnitude", "article_count", "sources", "article_ids")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def news_search(news: DataFrame, terms: list[str], k: int = 10) -> DataFrame:
    """Hits of the terms, weighted 10 in the title, 5 in the description, 1 in the content."""
    hits = lambda c: F.size(F.filter(words(F.lower(c)), lambda w: w.isin(terms)))
    scored = news.withColumn("relevance", (10 * hits(F.col("title")) + 5 * hits(F.col("description")) + hits(F.col("content"))).cast("long"))
    return scored.where("relevance > 0").orderBy(F.desc("relevance"), "url").limit(k)


def articles_by_symbol(news: DataFrame, symbol: str, now: Column, days: int, limit: int) -> DataFrame:
    rows = news.where(F.array_contains("symbols", symbol) & ((now.cast("long") - F.col("published_utc")).between(0, days * 86400)))
    return rows.orderBy(F.desc("published_utc"), "url").limit(limit)


def recent_ticker_sentiment(rows: DataFrame, n: int) -> DataFrame:
    return first_n_per_group(rows, ["ticker"], [F.desc("ts"), "id"], n)


def sentiment_by(scored: DataFrame, key: str, period: str, ts: str = "created_utc") -> DataFrame:
    """scored (key, ts in epoch seconds, sentiment_score) -> mean, deviation and count by key and period (hour, day, week, month)."""
    start = F.date_trunc(period, F.timestamp_seconds(ts))
    return scored.groupBy(key, start.alias("start")).agg(F.avg("sentiment_score").alias("mean_sentiment"), F.stddev_pop("sentiment_score").alias("deviation"), F.count("*").alias("n"))


def strong_signals(rows: DataFrame, score: float = 0.4, confidence: float = 0.8) -> DataFrame:
    return rows.where((F.abs("score") >= score) & (F.col("confidence") >= confidence))


def asof_price(sentiment: DataFrame, bars: DataFrame, tolerance_seconds: int | None = None) -> DataFrame:
    """sentiment (symbol, ts, id, score) with price and price_ts of the last bar with a close at or before ts.

    No range join: both sides are united and run through by symbol and day, and what a day does not hold itself comes
    from the last bar of the days before, of which there is one row a symbol and day.
    """
    known = bars.where("close is not null")
    bar = F.struct(F.col("bar_ts").alias("t"), F.col("close").cast("double").alias("p"))
    left = sentiment.select("symbol", F.to_date("ts").alias("day"), "ts", F.lit(1).alias("side"), "id", "score", F.lit(None).cast(known.select(bar.alias("b")).schema["b"].dataType).alias("bar"))
    right = known.select("symbol", F.to_date("bar_ts").alias("day"), F.col("bar_ts").alias("ts"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("double").alias("score"), bar.alias("bar"))
    rows = left.unionByName(right)
    within = Window.partitionBy("symbol", "day").orderBy("ts", "side").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("symbol").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("symbol", "day").agg(F.max("bar").alias("last")).withColumn("before", F.last("last", ignorenulls=True).over(earlier)).drop("last")
    rows = rows.withColumn("found", F.last("bar", ignorenulls=True).over(within)).where("side = 1").join(before, ["symbol", "day"])
    rows = rows.withColumn("found", F.coalesce("found", "before")).withColumn("price", F.col("found.p")).withColumn("price_ts", F.col("found.t"))
    if tolerance_seconds is not None:
        near = F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.col("price_ts").cast("timestamp")) <= tolerance_seconds
        rows = rows.withColumn("price", F.when(near, F.col("price"))).withColumn("price_ts", F.when(near, F.col("price_ts")))
    return rows.select("symbol", "ts", "id", "score", "price", "price_ts")


def lead_lag_corr(sentiment: DataFrame, returns: DataFrame, lags: list[int]) -> DataFrame:
    """sentiment (symbol, hour, score), returns (symbol, hour, ret), hours since the epoch -> lag, correlation, n."""
    later = sentiment.withColumn("lag", F.explode(F.array(*map(F.lit, lags)))).withColumn("hour", F.col("hour") + F.col("lag"))
    return later.join(returns, ["symbol", "hour"]).groupBy("lag").agg(F.corr("score", "ret").alias("correlation"), F.count("*").alias("n"))


def accuracy(rows: DataFrame, *keys: str) -> DataFrame:
    """rows (keys, predicted, actual) of up / down -> accuracy, precision and recall of up."""
    hit = F.count_if((F.col("predicted") == "up") & (F.col("actual") == "up"))
    share = lambda n, d: F.when(d > 0, n / d)
    return rows.groupBy(*keys).agg(F.avg((F.col("predicted") == F.col("actual")).cast("double")).alias("accuracy"), share(hit, F.count_if(F.col("predicted") == "up")).alias("precision"), share(hit, F.count_if(F.col("actual") == "up")).alias("recall"), F.count("*").alias("n"))


def dynamic_weights(scored: DataFrame, n: int = 30, floor: float = 0.05) -> DataFrame:
    """scored (source, period, accuracy): weights by mean accuracy over the rows before, floored, of sum 1 in each period."""
    w = Window.partitionBy("source").orderBy("period").rowsBetween(-n, -1)
    raw = F.greatest(F.coalesce(F.avg("accuracy").over(w), F.lit(floor)), F.lit(floor))
    return scored.withColumn("_w", raw).withColumn("weight", F.col("_w") / F.sum("_w").over(Window.partitionBy("period"))).drop("_w")


def drift(a: DataFrame, b: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Population stability index of column between two periods over the exact deciles of the first; sketched_drift() is the form for very many values."""
    edges = a.agg(F.percentile(column, F.array(*(F.lit(k / bins) for k in range(1, bins)))).alias("edges"))
    cut = lambda df: df.select(column).withColumn("_k", F.lit(1)).join(F.broadcast(edges.withColumn("_k", F.lit(1))), "_k").select(F.size(F.filter("edges", lambda e: e < F.col(column))).alias("bin"))
    both = cut(a).withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(cut(b).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1)))
    counts = both.groupBy("bin").agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    totals = Window.partitionBy()  # bins rows at most
    pa, pb = F.greatest(F.col("na") / F.sum("na").over(totals), F.lit(1e-6)), F.greatest(F.col("nb") / F.sum("nb").over(totals), F.lit(1e-6))
    return counts.select("bin", pa.alias("pa"), pb.alias("pb")).agg(F.sum((F.col("pa") - F.col("pb")) * F.log(F.col("pa") / F.col("pb"))).alias("psi"))


#: Size of a quantile sketch: ranks are right to about 1 in 1,000.
SKETCH = 3000


def daily_sketches(df: DataFrame, column: str, ts: str, *keys: str, k: int = SKETCH) -> DataFrame:
    """keys, day, sketch: a mergeable quantile sketch (KLL) of the column for each day, of bounded size. Nulls do not count."""
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), k).alias("sketch"))


def merged(sketches: DataFrame, *keys: str, k: int = SKETCH) -> DataFrame:
    """One sketch for each of the keys, or one in all."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles(sketch: Column, bins: int = 10) -> Column:
    """The values at 1/bins, 2/bins, ...; null for a sketch of nothing."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*(F.lit(i / bins) for i in range(1, bins)))))


def sketched_drift(a: DataFrame, b: DataFrame, bins: int = 10, k: int = SKETCH) -> DataFrame:
    """drift() between two sets of kept sketches: what each period has in the deciles of the first is read from ranks, so
    no row is looked at again and no state grows with the values. Each share is right to about 2 / k ** 0.9 of the rows.
    A period without values has no drift (null)."""
    first = merged(a, k=k)
    edges = first.select(quantiles(F.col("sketch"), bins).alias("e")).first()["e"]  # bins - 1 numbers, which rank functions take as literals
    if edges is None:
        return first.select(F.lit(None).cast("double").alias("psi"))
    upto = lambda sketch: F.when(F.kll_sketch_get_n_double(sketch) > 0, F.array(F.lit(0.0), *(F.kll_sketch_get_rank_double(sketch, F.lit(float(e))) for e in edges), F.lit(1.0)))
    share = lambda s, i: F.when(s.isNotNull(), F.greatest(F.get(s, i + 1) - F.get(s, i), F.lit(1e-6)))
    both = first.select(upto(F.col("sketch")).alias("ra")).crossJoin(merged(b, k=k).select(upto(F.col("sketch")).alias("rb")))  # one row each
    rows = both.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("i"), "ra", "rb").select(share(F.col("ra"), F.col("i")).alias("pa"), share(F.col("rb"), F.col("i")).alias("pb"))
    return rows.agg(F.sum((F.col("pa") - F.col("pb")) * F.log(F.col("pa") / F.col("pb"))).alias("psi"))


def normalised_copies(df: DataFrame, id_col: str, text: Column) -> DataFrame:
    """id, group_id (the least id of the same text but for case and spacing), n."""
    keyed = df.select(id_col, F.sha2(F.trim(F.regexp_replace(F.lower(text), r"[ \t\n]+", " ")), 256).alias("_h"))
    groups = keyed.groupBy("_h").agg(F.min(id_col).alias("group_id"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(groups, "_h").select(id_col, "group_id", "n")


def corr_matrix(returns: DataFrame) -> DataFrame:
    """returns (symbol, bar_ts, ret) -> symbol_a < symbol_b, correlation, n: joined on time."""
    x, y = returns.select(F.col("symbol").alias("symbol_a"), "bar_ts", F.col("ret").alias("a")), returns.select(F.col("symbol").alias("symbol_b"), "bar_ts", F.col("ret").alias("b"))
    return x.join(y, "bar_ts").where("symbol_a < symbol_b").groupBy("symbol_a", "symbol_b").agg(F.corr("a", "b").alias("correlation"), F.count("*").alias("n"))


def faceted_counts(rows: DataFrame, *facets: str) -> DataFrame:
    """Counts by each facet alone: facet, value, n."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in facets)))
    return rows.select(pairs.alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))
