"""Golden values, rule boundaries, nulls and streams of the library."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickertide.config import SentimentConfig
from tickertide.functions import rules as R
from tickertide.functions import sentiment as S
from tickertide.functions import text as X
from tickertide.functions.registration import register_functions
from tickertide.operators import records as P
from tickertide.operators import sentiment as O
from tickertide.operators import tables as T
from tickertide.sources import io
from tickertide.streaming import stream as M


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_golden_post(spark):
    final = S.ensemble_score(F.lit(-0.7677000164985657), F.lit(None).cast("double"), F.lit(4759), F.lit(0.9700000286102295), SentimentConfig(legacy_default=True))
    score, conf, label, impact = one(spark, final.cast("float"), S.confidence(final).cast("float"), S.label5(final), S.market_impact(final, S.confidence(final)))
    assert score == pytest.approx(0.1160992980003357, abs=1e-9)
    assert (conf, label, impact) == (pytest.approx(0.6160992980003357, abs=1e-7), "Bullish", "low")


def test_missing_deep_tier_drops_out(spark):
    assert one(spark, S.ensemble_score(F.lit(0.5), F.lit(None).cast("double"), F.lit(500), F.lit(1.0))) == (0.5,)


def test_text(spark):
    raw = "Buy $AAPL and $GOOGLE now https://x.io/a?b=1 <b>hi</b> @Éric @bob $AAPL"
    tags, clean, both = one(spark, X.cashtags(F.lit(raw)), X.clean_text(F.lit(raw)), X.full_text(F.lit(None).cast("string"), F.lit(None).cast("string")))
    assert tags == ["AAPL", "GOOGL", "AAPL"]
    assert "http" not in clean and "<" not in clean and "@" not in clean
    assert both == " "


@pytest.mark.parametrize(
    ("rule", "passes", "fails"),
    [
        (lambda v: R.rule_price_band(F.lit(v)), [0.0011, 1.0, 1000.0, 9999.9], [0.001, 10000.0]),
        (lambda v: R.check_price("p", F.lit(v)), [0.01, 1_000_000.0], [0.0, -1.0, 1_000_000.1]),
        (lambda v: R.check_count("n", F.lit(v)), [0, 10_000_000_000], [-1, 10_000_000_001]),
        (lambda v: R.check_symbol(F.lit("A" * v)), [1, 10], [0, 11]),
        (lambda v: R.rule_title(F.lit("aB" * 5 if v == 10 else "a" * v)), [10, 11], [0, 9]),
        (lambda v: R.rule_content(F.lit("d"), F.lit("c" * v)), [50, 51], [0, 49]),
    ],
)
def test_boundaries(spark, rule, passes, fails):
    assert all(one(spark, rule(v))[0] is None for v in passes)
    assert all(one(spark, rule(v))[0] is not None for v in fails)


def test_recency(spark):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    at = lambda h: now - F.make_interval(hours=F.lit(h))
    assert one(spark, *(R.rule_bar_recency(at(h), now) for h in (48, 49, 0, -1))) == (None, "Data is too old (older than 48 hours)", None, "Data timestamp is in the future")


def test_labels(spark):
    assert one(spark, *(S.label3(F.lit(v)) for v in (0.05, 0.049, -0.049, -0.05))) == ("Bullish", "Neutral", "Neutral", "Bearish")
    assert one(spark, *(S.label5(F.lit(v)) for v in (0.4, 0.1, 0.0, -0.1, -0.4))) == ("Very Bullish", "Bullish", "Neutral", "Bearish", "Very Bearish")
    assert one(spark, S.label5_from_probs(F.lit(0.1), F.lit(0.2), F.lit(0.7)))[0]["label"] == "Bullish"


def test_last_valid_is_not_lag(spark):
    closes = [100.0, 130.0, 131.0, 110.0, 135.0, 90.0, 88.0]
    rows = spark.createDataFrame([("a", i, c, True) for i, c in enumerate(closes)], "symbol string, bar_ts long, close double, ok boolean")
    got = {r["bar_ts"] for r in T.with_last_valid(rows).where("accepted").collect()}
    assert got == {0, 3, 5, 6}


def test_payloads(spark):
    raw = spark.createDataFrame([(None,), ("{bad",), ("[1]",), ("3",), ('"x"',), ("{}",)], "value string")
    assert [r["kind"] for r in P.classify_payload(raw).collect()] == ["skipped", "error", "error", "error", "error", "object"]


def test_bar_validation_partitions(spark):
    good = '{"symbol":"A","open":1,"high":2,"low":1,"close":1.5,"volume":3,"timestamp":1706659000000,"collection_timestamp":"2024-01-31T00:00:00Z"}'
    rows = [good, good.replace("}", ',"x":1}'), good.replace('"close":1.5,', ""), good.replace("1.5", '"no"'), good.replace('"high":2', '"high":1.2')]
    got = P.validate_bars(P.classify_payload(spark.createDataFrame([(r,) for r in rows], "value string")), F.lit("2024-01-31 00:00:00").cast("timestamp"))
    errors = [r["errors"] for r in got.collect()]
    assert errors[0] == []
    assert errors[1] == ["Schema error: Field 'x': extra_forbidden"]
    assert errors[2] == ["Schema error: Field 'close': missing"]
    assert errors[3] == ["Schema error: Field 'close': type"]
    assert errors[4] == ["Business rule error: High price is not the highest value"]


def test_deep_scores_by_distinct_text_and_failure(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id long, text string")
    got = O.deep_scores(rows, lambda ts: [(0.1, 0.2, 0.7)] * len(ts)).orderBy("id").collect()
    assert [r["p_pos"] for r in got] == [0.7, 0.7, 0.7]

    def broken(ts):
        raise ValueError

    assert all(r["p_pos"] is None and r["deep_failed"] for r in O.deep_scores(rows, broken).collect())


def test_empty_inputs(spark):
    posts = spark.createDataFrame([], "id long, subreddit string, title string, selftext string, score long, num_comments long, upvote_ratio double, created_utc long")
    lexicon = spark.createDataFrame([("up", 1.0)], "term string, valence double")
    assert O.score_posts(posts, lexicon).count() == 0
    assert T.overview(posts).first()["total_comments"] == 0


def test_sql_functions(spark):
    names = register_functions(spark, {"good": 2.0}, None)
    assert names == ["preprocess_udf", "fast_sentiment_udf", "deep_sentiment_udf", "weighted_sentiment_udf", "explode_ticker_sentiment_udf"]
    assert spark.sql("SELECT deep_sentiment_udf('a').p_pos").first()[0] is None
    assert tuple(spark.sql("SELECT inline(array(fast_sentiment_udf(cast(null AS string))))").first()) == (0.0, 0.0, 0.0, 1.0)
    assert spark.sql("SELECT weighted_sentiment_udf(-0.7677000164985657D, 0.5D, 4759D, 0.9700000286102295D)").first()[0] == pytest.approx(0.11609929862, abs=1e-9)
    assert spark.sql("SELECT fast_sentiment_udf('good good').compound").first()[0] == pytest.approx(4 / (16 + 15) ** 0.5)


def test_state_survives_restart(spark, tmp_path):
    closes = [100.0, 130.0, 131.0, 110.0, 135.0, 90.0, 88.0]
    day = dt.datetime(2024, 1, 1)
    for k, part in enumerate((range(3), range(3, 7))):
        spark.createDataFrame([("a", day + dt.timedelta(hours=i), closes[i], True) for i in part], "symbol string, bar_ts timestamp, close double, ok boolean").write.parquet(f"{tmp_path}/in/part={k}")
        rows = spark.readStream.schema("symbol string, bar_ts timestamp, close double, ok boolean, part int").parquet(f"{tmp_path}/in").drop("part")
        M.start(M.validate_bars_stream(rows), io._write_batch(f"{tmp_path}/out", None), f"{tmp_path}/check").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == 7
    assert sorted(r["close"] for r in got.where("accepted").collect()) == [88.0, 90.0, 100.0, 110.0]
