"""The engine's input shapes as views of the test tables, for Spark and, as SQL, for the comparison engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2024-01-31 00:00:00"
LEXICON = (("the", 1.9), ("and", -1.2), ("der", -2.0), ("la", 1.5))
NEGATIONS, BOOSTERS = ("not", "nicht", "of", "par"), ("very", "sehr", "in", "que")
WATCHLIST = ("the", "and", "der", "la")
TICKERS = ("A", "THE", "OF", "DE", "TO", "AND")
#: subreddit, scale, bias
CALIBRATION = (("src0", 1.2, 0.0), ("src1", 0.8, 0.05), ("src2", 1.0, -0.05), ("src3", 0.7, 0.1), ("src4", 1.5, 0.0))
MEME = (("con", 1.5), ("is", 1.0), ("und", -1.0))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark, sf_dir):
    return _read(spark, sf_dir, "events").selectExpr("event_id", "event_type AS symbol", "ts", "value AS price")


def bars(spark, sf_dir):
    """Hourly bars of the ticks."""
    t = ticks(spark, sf_dir).withColumn("o", F.struct("ts", "event_id"))
    return t.groupBy("symbol", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bar_ts")).agg(F.min_by("price", "o").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "o").alias("close"), F.count("*").alias("volume"))


def raw_bars(spark, sf_dir):
    """Bars with planted faults."""
    h = F.expr("unix_timestamp(cast(bar_ts as timestamp)) div 3600")
    close = F.when(h % 17 == 0, F.lit(None)).when(h % 29 == 0, F.col("close") * 1000).otherwise(F.col("close"))
    return bars(spark, sf_dir).select("symbol", "bar_ts", "open", "high", F.when(h % 19 == 0, F.col("high") + 1).otherwise(F.col("low")).alias("low"), close.alias("close"), F.when(h % 23 == 0, -1).otherwise(F.col("volume")).cast("long").alias("volume"))


def posts(spark, sf_dir):
    return _read(spark, sf_dir, "documents").selectExpr(
        "doc_id AS id", "source AS subreddit", "split_part(text, chr(10), 1) AS title", "substr(text, length(split_part(text, chr(10), 1)) + 2) AS selftext",
        "cast(n_chars % 5000 AS bigint) AS score", "cast(n_chars % 97 AS bigint) AS num_comments", "(doc_id % 101) / 100.0D AS upvote_ratio", "1704067200 + doc_id * 3600 AS created_utc", "lang",
        "CASE WHEN doc_id % 13 = 0 THEN '[deleted]' ELSE concat('user', doc_id % 50) END AS author",
    )


def comments(spark, sf_dir):
    return _read(spark, sf_dir, "conversations").where("turn > 0").selectExpr("conv_id * 1000 + turn AS id", "conv_id AS post_id", "conv_id * 1000 + turn - 1 AS parent_id", "text AS body", "role AS author", "turn AS depth", "1704067200 + conv_id * 3600 + turn * 60 AS created_utc")


def news(spark, sf_dir):
    return _read(spark, sf_dir, "documents").selectExpr("concat('https://news.example.com/', source, '/', doc_id) AS url", "split_part(text, chr(10), 1) AS title", "substr(text, 1, 200) AS description", "text AS content", "source", "lang", "1704067200 + doc_id * 3600 AS published_utc", "doc_id")


def frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def lexicon(spark):
    return frame(spark, LEXICON, "term string, valence double")


def words_table(spark, words, name="term"):
    return frame(spark, [(w,) for w in words], f"{name} string")


def calibration(spark):
    return frame(spark, CALIBRATION, "subreddit string, scale double, bias double")


def _values(rows) -> str:
    lit = lambda v: "'" + v + "'" if isinstance(v, str) else f"cast({v} as double)"
    return "(VALUES " + ", ".join("(" + ", ".join(map(lit, r if isinstance(r, tuple) else (r,))) + ")" for r in rows) + ")"


#: The same views in the comparison engine's SQL.
SQL = {
    "ticks": "SELECT event_id, event_type AS symbol, ts, value AS price FROM events",
    "bars": "SELECT event_type AS symbol, date_trunc('hour', ts) AS bar_ts, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY 1, 2",
    "raw_bars": "SELECT symbol, bar_ts, open, high, CASE WHEN h % 19 = 0 THEN high + 1 ELSE low END AS low, CASE WHEN h % 17 = 0 THEN NULL WHEN h % 29 = 0 THEN close * 1000 ELSE close END AS close, CASE WHEN h % 23 = 0 THEN -1 ELSE volume END AS volume FROM (SELECT *, epoch(bar_ts)::bigint // 3600 AS h FROM bars)",
    "posts": "SELECT doc_id AS id, source AS subreddit, split_part(text, chr(10), 1) AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS selftext, cast(n_chars % 5000 AS bigint) AS score, cast(n_chars % 97 AS bigint) AS num_comments, (doc_id % 101) / 100.0::double AS upvote_ratio, 1704067200 + doc_id * 3600 AS created_utc, lang, CASE WHEN doc_id % 13 = 0 THEN '[deleted]' ELSE concat('user', doc_id % 50) END AS author FROM documents",
    "comments": "SELECT conv_id * 1000 + turn AS id, conv_id AS post_id, conv_id * 1000 + turn - 1 AS parent_id, text AS body, role AS author, turn AS depth, 1704067200 + conv_id * 3600 + turn * 60 AS created_utc FROM conversations WHERE turn > 0",
    "news": "SELECT concat('https://news.example.com/', source, '/', doc_id) AS url, split_part(text, chr(10), 1) AS title, substr(text, 1, 200) AS description, text AS content, source, lang, 1704067200 + doc_id * 3600 AS published_utc, doc_id FROM documents",
    "lexicon": f"SELECT * FROM {_values(LEXICON)} t(term, valence)",
    "watchlist": f"SELECT * FROM {_values(WATCHLIST)} t(symbol)",
    "tickers": f"SELECT * FROM {_values(TICKERS)} t(ticker)",
    "calibration": f"SELECT * FROM {_values(CALIBRATION)} t(subreddit, scale, bias)",
    "meme": f"SELECT * FROM {_values(MEME)} t(term, valence)",
}
_NEEDS = {"raw_bars": ("bars",)}


def oracle(names: str, query: str) -> str:
    """The query with the named views in front; names may hold extra views as name=SQL."""
    out: dict[str, str] = {}
    for n in names.split():
        for k in (*_NEEDS.get(n, ()), n):
            out[k] = SQL[k]
    head = ", ".join(f"{k} AS ({v})" for k, v in out.items())
    q = query.strip()
    recursive = "RECURSIVE " if q.startswith("RECURSIVE ") else ""
    q = q.removeprefix("RECURSIVE ")
    return f"WITH {recursive}{head}, {q[5:]}" if q.startswith("WITH ") else f"WITH {recursive}{head} {q}"
