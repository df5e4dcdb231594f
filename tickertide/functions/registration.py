"""SQL functions under fixed names: expressions where Spark has them, one Arrow function for models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import copysign, sqrt

import pandas as pd
import regex
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tickertide.config import SentimentConfig
from tickertide.functions.text import NON_WORD

FAST = ("compound", "pos", "neg", "neu")
DEEP = ("p_neg", "p_neu", "p_pos")


def fast_scores(text: str, lexicon: dict[str, float], negations: Sequence[str] = (), boosters: Sequence[str] = (), cfg: SentimentConfig = SentimentConfig(), look_back: int = 3) -> tuple[float, float, float, float]:
    """What operators.sentiment.lexicon_scores works out, for one text at a time."""
    words = [w for w in regex.split(NON_WORD, text.lower()) if w]
    found = []
    for i, w in enumerate(words):
        v = lexicon.get(w, 0.0)
        if v:
            before = words[max(0, i - look_back) : i]
            v += copysign(cfg.boost, v) if any(b in boosters for b in before) else 0.0
            v *= cfg.negation if any(b in negations for b in before) else 1.0
            found += [v] if v else []
    total, pos, neg, neu = sum(found), sum(v + 1 for v in found if v > 0), sum(1 - v for v in found if v < 0), len(words) - len(found)
    every = pos + neg + neu
    return (total / sqrt(total * total + cfg.alpha), pos / every, neg / every, neu / every) if words else (0.0, 0.0, 0.0, 1.0)


def register_functions(spark: SparkSession, lexicon: dict[str, float] | None = None, scorer: Callable[[pd.Series], pd.DataFrame] | None = None, negations: Sequence[str] = (), boosters: Sequence[str] = ()) -> list[str]:
    """Register the five functions; their names are returned.

    lexicon: for fast_sentiment_udf (operators.sentiment.lexicon_sentiment is the way for large tables); without one no word counts.
    scorer: texts -> a frame with p_neg, p_neu and p_pos, for deep_sentiment_udf; without one these are null.
    """
    run = spark.sql
    run(
        r"CREATE OR REPLACE TEMPORARY FUNCTION preprocess_udf(title STRING, body STRING) RETURNS STRUCT<cleaned_text STRING, tickers ARRAY<STRING>> RETURN "
        r"named_struct('cleaned_text', lower(regexp_replace(regexp_replace(regexp_replace(concat(coalesce(title, ''), ' ', coalesce(body, '')), 'https?://\\S+', ''), '<[^>]+>', ''), '@[\\p{L}\\p{M}\\p{N}_]+', '')), "
        r"'tickers', regexp_extract_all(concat(coalesce(title, ''), ' ', coalesce(body, '')), '\\$([A-Z]{1,5})', 1))"
    )
    run("CREATE OR REPLACE TEMPORARY FUNCTION weighted_sentiment_udf(fast DOUBLE, deep DOUBLE, score DOUBLE, upvote DOUBLE) RETURNS DOUBLE RETURN (0.3D * fast + 0.7D * deep) * least(1.0D, 0.5D + coalesce(score, 0.0D) / 1000) * coalesce(upvote, 0.5D)")
    run(
        "CREATE OR REPLACE TEMPORARY FUNCTION explode_ticker_sentiment_udf(tickers ARRAY<STRING>, label STRING, score DOUBLE, conf DOUBLE) RETURNS ARRAY<STRUCT<ticker STRING, sentiment STRING, score DOUBLE, confidence DOUBLE>> "
        "RETURN transform(tickers, t -> named_struct('ticker', t, 'sentiment', label, 'score', score, 'confidence', conf))"
    )
    values, before = dict(lexicon or {}), (frozenset(negations), frozenset(boosters))

    @F.pandas_udf(", ".join(f"{c} double" for c in FAST))
    def fast_sentiment_udf(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fast_scores(t, values, *before) for t in texts.fillna("")], columns=FAST)

    @F.pandas_udf(", ".join(f"{c} double" for c in DEEP))
    def deep_sentiment_udf(texts: pd.Series) -> pd.DataFrame:
        return scorer(texts.fillna(""))[list(DEEP)] if scorer else pd.DataFrame({c: pd.Series([None] * len(texts), dtype="float64") for c in DEEP})

    spark.udf.register("fast_sentiment_udf", fast_sentiment_udf)
    spark.udf.register("deep_sentiment_udf", deep_sentiment_udf)
    return ["preprocess_udf", "fast_sentiment_udf", "deep_sentiment_udf", "weighted_sentiment_udf", "explode_ticker_sentiment_udf"]
