"""Joins, de-duplication, cut-offs and aggregates over posts, comments, news and bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.functions.text import bare_tickers, words
from tickertide.operators.folds import with_last_valid  # noqa: F401  (one of the joins)
from tickertide.operators.sentiment import words_of


def rank_within(keys: list[str], *order) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def first_n_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    return df.withColumn("_rn", rank_within(keys, *order)).where(F.col("_rn") <= n).drop("_rn")


def created_date(df: DataFrame, column: str = "created_utc") -> Column:
    return F.to_date(F.timestamp_seconds(column))


# joins


def valid_tickers_join(mentions: DataFrame, tickers: DataFrame) -> DataFrame:
    """mentions (…, ticker) whose ticker is known; repeats stay."""
    return mentions.join(tickers.select("ticker").distinct(), "ticker", "left_semi")


def valid_mentions(df: DataFrame, tickers: DataFrame, id_col: str, text: Column) -> DataFrame:
    """id, ticker: the words of capital letters that are known tickers (a vocabulary), repeats and all. They are looked up
    in the text, so only hits become rows."""
    known = words_of(tickers, "ticker")
    return df.select(id_col, F.explode(F.filter(bare_tickers(text), lambda t: known.valence(t).isNotNull())).alias("ticker"))


def unseen(df: DataFrame, processed: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key was not processed; null keys are new."""
    return df.join(processed.select(key).distinct(), key, "left_anti")


def active_posts(posts: DataFrame, min_score: int = 10, min_comments: int = 5) -> DataFrame:
    return posts.where((F.col("score") >= min_score) | (F.col("num_comments") >= min_comments))


def comments_of_active_posts(comments: DataFrame, posts: DataFrame, min_score: int = 10, min_comments: int = 5) -> DataFrame:
    return comments.join(active_posts(posts, min_score, min_comments).select(F.col("id").alias("post_id")), "post_id", "left_semi")


def watchlist_mentions(df: DataFrame, symbols: DataFrame, id_col: str, text: Column) -> DataFrame:
    """id, symbol (in the watchlist's spelling): distinct whole-word hits, whatever their case. Only hits become rows and are joined."""
    spelled = symbols.select(F.col("symbol"), F.upper("symbol").alias("_token")).distinct()
    known = words_of(spelled, "_token")
    hits = df.select(id_col, F.explode(F.array_distinct(F.filter(words(F.upper(text)), lambda w: known.valence(w).isNotNull()))).alias("_token"))
    return hits.join(spelled, "_token").select(id_col, "symbol").distinct()


def posts_for_symbol(posts: DataFrame, symbol: str, column: str = "symbols") -> DataFrame:
    return posts.where(F.array_contains(column, symbol))


def ticker_with_post(ticker_rows: DataFrame, posts: DataFrame) -> DataFrame:
    return ticker_rows.join(posts, "id")


# de-duplication and sets


def union_topics(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedup_cycle(df: DataFrame, order: list, key: str = "id") -> DataFrame:
    """The first row of each key."""
    return first_n_per_group(df, [key], order, 1)


def dedup_listings(listings: list[tuple[str, DataFrame]], key: str = "id") -> DataFrame:
    """Distinct rows over the listings; collection_method names the first listing that has a row."""
    named = [df.withColumn("collection_method", F.lit(name)).withColumn("_at", F.lit(i)) for i, (name, df) in enumerate(listings)]
    return dedup_cycle(union_topics(*named), ["_at"], key).drop("_at")


def fan_out_symbols(df: DataFrame, column: str = "symbols") -> DataFrame:
    rows = df.withColumn("symbol", F.explode(F.array_distinct(column)))
    return rows.withColumn("key", F.concat_ws("_", F.lit("reddit_symbol"), "symbol", F.col("id").cast("string")))


def route(df: DataFrame, valid: str, invalid: str, error: str) -> DataFrame:
    """topic by the columns is_error and errors."""
    return df.withColumn("topic", F.when(F.col("is_error"), error).when(F.size("errors") > 0, invalid).otherwise(valid))


def route_reddit(df: DataFrame) -> DataFrame:
    return df.withColumn("topic", F.when(F.coalesce(F.size("symbols"), F.lit(0)) > 0, "reddit-symbols").when(F.col("content_type") == "post", "reddit-posts").otherwise("reddit-comments"))


# aggregates: null keys go, empty sums are 0, ties go to the smaller key


def top(df: DataFrame, k: int, by: str, *keys: str) -> DataFrame:
    return df.orderBy(F.desc(by), *keys).limit(k)


def overview(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count("*").alias("n_posts"), F.round(F.avg("score"), 2).alias("mean_score"), F.coalesce(F.sum("num_comments"), F.lit(0)).alias("total_comments"), F.countDistinct("subreddit").alias("n_subreddits"))


def top_subreddits(posts: DataFrame, k: int = 10) -> DataFrame:
    return top(posts.where("subreddit is not null").groupBy("subreddit").agg(F.count("*").alias("n")), k, "n", "subreddit")


def subreddit_engagement(posts: DataFrame, k: int = 10) -> DataFrame:
    a = posts.where("subreddit is not null").groupBy("subreddit").agg(F.avg("score").alias("mean_score"), F.coalesce(F.sum("score"), F.lit(0)).alias("total_score"), F.avg("num_comments").alias("mean_comments"), F.coalesce(F.sum("num_comments"), F.lit(0)).alias("total_comments"))
    return top(a, k, "total_score", "subreddit")


def symbol_mentions(posts: DataFrame, k: int = 15, column: str = "symbols") -> DataFrame:
    return top(posts.select(F.explode(column).alias("symbol")).groupBy("symbol").agg(F.count("*").alias("n")), k, "n", "symbol")


def symbol_summary(posts: DataFrame, symbol: str) -> DataFrame:
    return posts_for_symbol(posts, symbol).agg(F.count("*").alias("n_posts"), F.round(F.avg("score"), 2).alias("mean_score"))


def posts_by_date(posts: DataFrame) -> DataFrame:
    return posts.groupBy(created_date(posts).alias("date")).agg(F.count("*").alias("n")).where("date is not null")


def symbol_mentions_by_date(posts: DataFrame, symbol: str) -> DataFrame:
    return posts_by_date(posts_for_symbol(posts, symbol))


def sentiment_by_date(scored: DataFrame) -> DataFrame:
    return scored.groupBy(created_date(scored).alias("date")).agg(F.avg("sentiment_score").alias("mean_sentiment"), F.count("*").alias("n")).where("date is not null")


def validation_stats(routed: DataFrame, ts: str = "ts", interval: str = "60 seconds") -> DataFrame:
    a = routed.groupBy(F.window(ts, interval).alias("w")).agg(F.count("*").alias("processed"), F.count_if(F.col("outcome") == "valid").alias("valid"), F.count_if(F.col("outcome") == "invalid").alias("invalid"), F.count_if(F.col("outcome") == "error").alias("errors"))
    return a.select(F.col("w.start").alias("start"), "processed", "valid", "invalid", "errors", *((F.col(c) * 100.0 / F.col("processed")).alias(p) for c, p in (("valid", "valid_percent"), ("invalid", "invalid_percent"), ("errors", "error_percent"))))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


# listings, ranges and searches


def age_hours(created: str, now: Column) -> Column:
    return (now.cast("long") - F.col(created)) / 3600.0


def top_posts(posts: DataFrame, method: str, n: int, now: Column, max_age_hours: float | None = None) -> DataFrame:
    """The n first posts of each community: hot, new, top or rising."""
    age = F.greatest(age_hours("created_utc", now), F.lit(0.0))
    value = {"new": F.col("created_utc").cast("double"), "top": F.col("score").cast("double"), "hot": F.col("score") / F.pow(age + 2, F.lit(1.5)), "rising": F.col("score") / F.greatest(age, F.lit(1.0))}[method]
    rows = posts if max_age_hours is None else posts.where(age_hours("created_utc", now).between(0, max_age_hours))
    return first_n_per_group(rows.withColumn("rank_value", value), ["subreddit"], [F.desc("rank_value"), "id"], n)


def first_comments(comments: DataFrame, n: int) -> DataFrame:
    return first_n_per_group(comments, ["post_id"], ["depth", "created_utc", "id"], n)


def date_filter(posts: DataFrame, start: str, end: str, column: str = "created_utc") -> DataFrame:
    """From the start date to the end date, both included."""
    day = F.timestamp_seconds(column)
    return posts.where((day >= F.lit(start).cast("timestamp")) & (day < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")))


#: Seconds of the periods that listings are named by.
PERIODS = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800, "month": 2592000, "year": 31536000}
#: Months of the longer units of bars.
MONTHS = {"month": 1, "quarter": 3, "year": 12}


def span_start(ts: Column, multiplier: int, timespan: str) -> Column:
    """The start of the span that a time without zone lies in. Months, quarters and years are those of the calendar, counted
    from 1970; weeks begin on Monday; shorter spans are counted from the epoch."""
    if timespan in MONTHS:
        n = multiplier * MONTHS[timespan]
        months = (F.year(ts) - 1970) * 12 + F.month(ts) - 1
        return F.add_months(F.lit("1970-01-01").cast("date"), (F.floor(months / n) * n).cast("int")).cast("timestamp_ntz")
    size, shift = multiplier * PERIODS[timespan], 345600 if timespan == "week" else 0  # the first Monday is the epoch's fifth day
    return F.timestamp_seconds(F.floor((F.unix_timestamp(ts.cast("timestamp")) - shift) / size) * size + shift).cast("timestamp_ntz")


def search_symbol_posts(posts: DataFrame, seen: DataFrame, n: int, now: Column, period: str = "all") -> DataFrame:
    """posts (id, symbols, score, created_utc) not yet seen, of the last period: the n best of each symbol."""
    rows = unseen(posts, seen, "id")
    if period != "all":
        rows = rows.where(F.col("created_utc").between(now.cast("long") - PERIODS[period], now.cast("long")))
    return first_n_per_group(rows.withColumn("symbol", F.explode(F.array_distinct("symbols"))), ["symbol"], [F.desc("score"), "id"], n)


def bar_range(bars: DataFrame, symbols: list[str], start: str, end: str, limit: int, descending: bool = False, multiplier: int = 1, timespan: str | None = None) -> DataFrame:
    """Bars of the symbols from start on and before end, first or last `limit` of each; with a timespan as bars of multiplier timespans (minute to year)."""
    rows = bars.where(F.col("symbol").isin(symbols) & (F.col("bar_ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("bar_ts") < F.lit(end).cast("timestamp_ntz")))
    if timespan:
        at = span_start(F.col("bar_ts"), multiplier, timespan)
        order = F.col("bar_ts")
        rows = rows.groupBy("symbol", at.alias("at")).agg(F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", order).alias("close"), F.sum("volume").alias("volume")).withColumnRenamed("at", "bar_ts")
    return first_n_per_group(rows, ["symbol"], [F.desc("bar_ts") if descending else F.asc("bar_ts")], limit)


def news_query(news: DataFrame, q: str | None, start: int, end: int, languages: list[str] = (), sources: list[str] = (), domains: list[str] = (), page_size: int = 100) -> DataFrame:
    """Newest first; the phrase may stand in title, description or content, in any case."""
    rows = news.where(F.col("published_utc").between(start, end))
    if q:
        rows = rows.where(F.contains(F.lower(F.concat_ws(" ", "title", "description", "content")), F.lit(q.lower())))
    for column, values in ((F.col("lang"), languages), (F.col("source"), sources), (F.parse_url("url", F.lit("HOST")), domains)):
        rows = rows.where(column.isin(list(values))) if values else rows
    return rows.orderBy(F.desc("published_utc"), "url").limit(page_size)


def news_queries(news: DataFrame, queries: list[dict], now: int, days: int = 7) -> DataFrame:
    """Several queries (arguments of news_query) at once, each article once. Without a start, a query looks at the last `days` days."""
    found = [news_query(news, **{"q": None, "start": now - days * 86400, "end": now} | q) for q in queries]
    return union_topics(*found).dropDuplicates(["url"])


def latest_valid_per_symbol(folded: DataFrame) -> DataFrame:
    return folded.where("accepted").groupBy("symbol").agg(F.max_by("close", "bar_ts").alias("close"), F.max("bar_ts").alias("bar_ts"))
