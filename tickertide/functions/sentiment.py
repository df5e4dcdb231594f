"""Sentiment arithmetic: column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickertide.config import SentimentConfig

_CFG = SentimentConfig()


def label3(compound: Column) -> Column:
    return F.when(compound >= 0.05, "Bullish").when(compound <= -0.05, "Bearish").otherwise("Neutral")


def label5_from_probs(neg: Column, neu: Column, pos: Column) -> Column:
    """label, score and the probabilities, with the two extreme ones taken as 0.7 of the plain ones."""
    cases = ((pos > 0.7, "Very Bullish", 0.75), (pos > 0.5, "Bullish", 0.25), (neg > 0.7, "Very Bearish", -0.75), (neg > 0.5, "Bearish", -0.25))
    label, score = F.lit("Neutral"), F.lit(0.0)
    for when, name, value in reversed(cases):
        label, score = F.when(when, name).otherwise(label), F.when(when, value).otherwise(score)
    return F.struct(label.alias("label"), score.alias("score"), (neg * 0.7).alias("very_bearish"), neg.alias("bearish"), neu.alias("neutral"), pos.alias("bullish"), (pos * 0.7).alias("very_bullish"))


def ensemble_score(fast: Column, deep: Column, score: Column, upvote_ratio: Column, cfg: SentimentConfig = _CFG) -> Column:
    """Weighted tiers times engagement. A missing deep tier drops out, its weight with it, or counts 0.5 if cfg says so."""
    if cfg.legacy_default:
        tiers = cfg.fast_weight * fast + cfg.deep_weight * F.coalesce(deep, F.lit(0.5))
    else:
        tiers = F.when(deep.isNull(), fast).otherwise((cfg.fast_weight * fast + cfg.deep_weight * deep) / (cfg.fast_weight + cfg.deep_weight))
    return tiers * F.least(F.lit(1.0), 0.5 + F.coalesce(score, F.lit(0)) / 1000) * F.coalesce(upvote_ratio, F.lit(0.5))


def label5(final: Column) -> Column:
    return F.when(final >= 0.4, "Very Bullish").when(final >= 0.1, "Bullish").when(final <= -0.4, "Very Bearish").when(final <= -0.1, "Bearish").otherwise("Neutral")


def confidence(final: Column) -> Column:
    return F.least(0.5 + F.abs(final), F.lit(0.99))


def market_impact(score: Column, conf: Column) -> Column:
    size = F.abs(score)
    return F.when(conf > 0.8, F.when(size > 0.5, "high").otherwise("moderate")).otherwise(F.when(size > 0.3, "moderate").otherwise("low"))


def ticker_sentiments(tickers: Column, label: Column, score: Column, conf: Column) -> Column:
    return F.transform(tickers, lambda t: F.struct(t.alias("ticker"), label.alias("sentiment"), score.alias("score"), conf.alias("confidence")))


def confidence_factors(score: Column, num_comments: Column, upvote_ratio: Column) -> Column:
    ramp = lambda x, n: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x / n))
    return ramp(score, 5) * ramp(num_comments, 3) * F.when(upvote_ratio >= 0.6, 1.0).otherwise(F.greatest(F.lit(0.0), upvote_ratio / 0.6))


def data_point_confidence(count: Column, n: int = _CFG.min_points) -> Column:
    return F.least(F.lit(1.0), count / n)


def fuse(price: Column, sentiment: Column, w_price: float = 0.6, w_sentiment: float = 0.4) -> Column:
    total = F.when(price.isNotNull(), w_price).otherwise(0.0) + F.when(sentiment.isNotNull(), w_sentiment).otherwise(0.0)
    signal = F.when(total > 0, (F.coalesce(price * w_price, F.lit(0.0)) + F.coalesce(sentiment * w_sentiment, F.lit(0.0))) / total)
    clash = (F.signum(price) != F.signum(sentiment)) & (F.abs(price) >= 0.1) & (F.abs(sentiment) >= 0.1)
    return F.struct(signal.alias("signal"), F.coalesce(clash, F.lit(False)).alias("conflict"))
