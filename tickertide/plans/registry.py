"""All registered queries of the library and the SQL that each must equal. Keys: the survey's row, then a name."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickertide.functions import rules as R
from tickertide.functions import sentiment as S
from tickertide.functions import text as X
from tickertide.functions.registration import register_functions
from tickertide.operators import bars as B
from tickertide.operators import copies as C
from tickertide.operators import correlation as K
from tickertide.operators import folds as L
from tickertide.operators import records as P
from tickertide.operators import search as I
from tickertide.operators import scores as Y
from tickertide.operators import sentiment as O
from tickertide.operators import signals as G
from tickertide.operators import tables as T
from tickertide.plans import fixtures as V
from tickertide.plans.fixtures import NOW, oracle
from tickertide.sources import io
from tickertide.streaming import stream as M
from tickertide.streaming import watch as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
NOW_S = 1706659200  # NOW in epoch seconds


def now():
    return F.lit(NOW).cast("timestamp")


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = oracle(views, sql) if views else sql
        return f

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["a8_sentiment_by_date"](spark, sf_dir)


def r6(c):
    return F.round(c, 6)


def scratch(spark: SparkSession) -> str:
    """A folder all executors share, for queries that write and read back."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tickertide-")
    return f"{root}/{uuid.uuid4().hex}"


def text_of(posts: DataFrame) -> DataFrame:
    return posts.withColumn("text", X.full_text(F.col("title"), F.col("selftext")))


def posts_with_symbols(spark, d):
    known = [F.lit(t) for t in V.TICKERS]
    return text_of(V.posts(spark, d)).withColumn("symbols", F.array_distinct(F.filter(X.bare_tickers(F.col("text")), lambda t: t.isin(*known))))


WORD = r"[^\p{L}\p{M}\p{N}_]+"
_TEXT = "coalesce(title,'') || ' ' || coalesce(selftext,'')"
_SYMS = f"SELECT *, list_distinct(list_filter(string_split_regex({_TEXT}, '{WORD}'), lambda t: t IN ('A','THE','OF','DE','TO','AND'))) AS symbols FROM posts"
_TOK = f"SELECT id, unnest(ws) AS token, unnest(range(1, len(ws) + 1)) AS pos, ws FROM (SELECT id, list_filter(string_split_regex(lower({_TEXT}), '{WORD}'), lambda w: w <> '') AS ws FROM posts)"
_in = lambda ws: ",".join(f"'{w}'" for w in ws)


def lex_sql(lexicon: str, prefix: str = "") -> str:
    """CTEs ending in {prefix}lex(id, compound, pos, neg, neu) over posts."""
    neg, boost = _in(V.NEGATIONS), _in(V.BOOSTERS)
    before = "list_slice(ws, greatest(pos - 3, 1), pos - 1)"
    return f"""{prefix}tok AS ({_TOK}),
{prefix}val AS (SELECT id, CASE WHEN coalesce(valence, 0.0) = 0 THEN 0.0::double ELSE (valence + CASE WHEN len(list_filter({before}, lambda b: b IN ({boost}))) > 0 AND pos > 1 THEN sign(valence) * 0.293::double ELSE 0 END) * CASE WHEN len(list_filter({before}, lambda b: b IN ({neg}))) > 0 AND pos > 1 THEN -0.74::double ELSE 1 END END AS v FROM {prefix}tok LEFT JOIN {lexicon} ON token = term),
{prefix}sums AS (SELECT id, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS p, sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS n, sum(CASE WHEN v = 0 THEN 1.0::double ELSE 0 END) AS z FROM {prefix}val GROUP BY id),
{prefix}lex AS (SELECT posts.id, coalesce(s / sqrt(s * s + 15), 0.0) AS compound, coalesce(p / (p + n + z), 0.0) AS pos, coalesce(n / (p + n + z), 0.0) AS neg, coalesce(z / (p + n + z), 1.0) AS neu FROM posts LEFT JOIN {prefix}sums USING (id))"""


_SCORED = f"""{lex_sql("lexicon")},
scored AS (SELECT *, least(0.5 + abs(sentiment_score), 0.99) AS confidence, CASE WHEN sentiment_score >= 0.4 THEN 'Very Bullish' WHEN sentiment_score >= 0.1 THEN 'Bullish' WHEN sentiment_score <= -0.4 THEN 'Very Bearish' WHEN sentiment_score <= -0.1 THEN 'Bearish' ELSE 'Neutral' END AS sentiment_label
FROM (SELECT posts.*, compound, compound * least(1.0, 0.5 + score / 1000.0::double) * upvote_ratio AS sentiment_score FROM posts JOIN lex USING (id)))"""
_IMPACT = "CASE WHEN confidence > 0.8 THEN CASE WHEN abs(sentiment_score) > 0.5 THEN 'high' ELSE 'moderate' END ELSE CASE WHEN abs(sentiment_score) > 0.3 THEN 'moderate' ELSE 'low' END END"


#: The chain with its cleaning switched off, as the SQL of most queries has it; t9_whole_chain switches all of it on.
PLAIN = O.TextConfig(remove_urls=False, remove_html=False, remove_mentions=False)


def scored(spark, d):
    return O.score_posts(V.posts(spark, d), V.lexicon(spark), negations=V.NEGATIONS, boosters=V.BOOSTERS, text_cfg=PLAIN)


# text


@query("x1_full_text", f"SELECT id, md5({_TEXT}) AS h FROM posts", "posts")
def _(s, d):
    return text_of(V.posts(s, d)).select("id", F.md5("text").alias("h"))


@query("x3_strip_html", "SELECT page_id, md5(regexp_replace(html, '<[^>]+>', '', 'g')) AS h FROM pages")
def _(s, d):
    return s.read.parquet(f"{d}/pages.parquet").select("page_id", F.md5(X.strip_html(F.col("html"))).alias("h"))


@query("x4_strip_mentions", r"SELECT doc_id, length(regexp_replace(text, '@[\p{L}\p{M}\p{N}_]+', '', 'g')) AS n FROM documents")
def _(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.length(X.strip_mentions(F.col("text"))).cast("long").alias("n"))


@query("x2_strip_urls", r"SELECT page_id, md5(regexp_replace(html, 'https?://\S+', '', 'g')) AS h FROM pages")
def _(s, d):
    return s.read.parquet(f"{d}/pages.parquet").select("page_id", F.md5(X.strip_urls(F.col("html"))).alias("h"))


@query("x6_clean_text", rf"SELECT id, md5(lower(regexp_replace(regexp_replace(regexp_replace({_TEXT}, 'https?://\S+', '', 'g'), '<[^>]+>', '', 'g'), '@[\p{{L}}\p{{M}}\p{{N}}_]+', '', 'g'))) AS h FROM posts", "posts")
def _(s, d):
    return text_of(V.posts(s, d)).select("id", F.md5(X.clean_text(F.col("text"))).alias("h"))


@query("x7_cashtags", r"SELECT doc_id, array_to_string(regexp_extract_all(replace(text, ' T', ' $T'), '\$([A-Z]{1,5})', 1), ',') AS tags FROM documents")
def _(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", X.join_tickers(X.cashtags(F.replace("text", F.lit(" T"), F.lit(" $T")))).alias("tags"))


@query("x8_bare_tickers", f"SELECT doc_id, unnest(list_filter(string_split_regex(text, '{WORD}'), lambda t: regexp_full_match(t, '[A-Z]{{1,5}}'))) AS ticker FROM documents")
def _(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.explode(X.bare_tickers(F.col("text"))).alias("ticker"))


@query("x9_text_stats", r"SELECT doc_id, length(text) AS length, len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) AS word_count FROM documents")
def _(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", X.text_stats(F.col("text")).alias("t")).select("doc_id", "t.*")


@query("x10_truncate", "SELECT doc_id, md5(substr(text, 1, 2048)) AS h FROM documents")
def _(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.md5(X.truncate(F.col("text"))).alias("h"))


@query("x11_ticker_strings", f"WITH syms AS ({_SYMS}) SELECT id, cast(len(symbols) AS bigint) AS n FROM syms", "posts")
def _(s, d):
    return posts_with_symbols(s, d).select("id", F.size(X.split_tickers(X.join_tickers(F.col("symbols")))).cast("long").alias("n"))


@query("x12_preprocess", f"SELECT id, md5(lower({_TEXT})) AS h, lower(subreddit) AS subreddit, coalesce(score, 0) AS score, coalesce(upvote_ratio, 0.5) AS upvote_ratio, coalesce(num_comments, 0) AS num_comments FROM posts", "posts")
def _(s, d):
    cfg = O.TextConfig(remove_urls=False, remove_html=False, remove_mentions=False)
    pre = X.preprocess(*(F.col(c) for c in ("title", "selftext", "subreddit", "score", "upvote_ratio", "num_comments")), cfg)
    return V.posts(s, d).select("id", pre.alias("p")).select("id", F.md5("p.cleaned_text").alias("h"), "p.subreddit", "p.score", "p.upvote_ratio", "p.num_comments")


@query("d16_hashtags", r"SELECT doc_id, array_to_string(regexp_extract_all(replace(text, ' t', ' #t'), '#([\p{L}\p{N}_]+)', 1), ',') AS tags FROM documents")
def _(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.array_join(X.hashtags(F.replace("text", F.lit(" t"), F.lit(" #t"))), ",").alias("tags"))


@query("d16_extra_cleaning", f"SELECT doc_id, md5(array_to_string(list_filter(string_split_regex(lower(text), '{WORD}'), lambda w: w <> '' AND w NOT IN ('the','and','of')), ' ')) AS h FROM documents")
def _(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.md5(F.array_join(X.drop_words(F.col("text"), ["the", "and", "of"]), " ")).alias("h"))


# sentiment


@query("t1_lexicon_sentiment", f"WITH {lex_sql('lexicon')} SELECT id, round(compound, 6) AS compound, round(pos, 6) AS pos, round(neg, 6) AS neg, round(neu, 6) AS neu FROM lex", "posts lexicon")
def _(s, d):
    r = O.lexicon_sentiment(text_of(V.posts(s, d)), V.lexicon(s), negations=V.NEGATIONS, boosters=V.BOOSTERS)
    return r.select("id", *(r6(c).alias(c) for c in ("compound", "pos", "neg", "neu")))


_WIDE = f"wide AS (SELECT term, ((length(term) % 7) - 3)::double AS valence FROM (SELECT unnest(list_filter(string_split_regex(lower(text), '{WORD}'), lambda w: w <> '')) AS term FROM documents) GROUP BY 1 HAVING count(*) >= 20)"


@query("t1_wide_lexicon", f"WITH {_WIDE}, {lex_sql('wide')} SELECT id, round(compound, 6) AS compound, round(pos, 6) AS pos, round(neg, 6) AS neg, round(neu, 6) AS neu FROM lex", "posts")
def _(s, d):
    # the corpus's frequent words, thousands of them, as a lexicon
    words = s.read.parquet(f"{d}/documents.parquet").select(F.explode(X.words(F.lower("text"))).alias("term")).groupBy("term").count().where("count >= 20")
    wide = words.select("term", (F.length("term") % 7 - 3).cast("double").alias("valence"))
    r = O.lexicon_sentiment(text_of(V.posts(s, d)), wide, negations=V.NEGATIONS, boosters=V.BOOSTERS)
    return r.select("id", *(r6(c).alias(c) for c in ("compound", "pos", "neg", "neu")))


@query("t2_label3", f"WITH {lex_sql('lexicon')} SELECT id, CASE WHEN compound >= 0.05 THEN 'Bullish' WHEN compound <= -0.05 THEN 'Bearish' ELSE 'Neutral' END AS label FROM lex", "posts lexicon")
def _(s, d):
    r = O.lexicon_sentiment(text_of(V.posts(s, d)), V.lexicon(s), negations=V.NEGATIONS, boosters=V.BOOSTERS)
    return r.select("id", S.label3(F.col("compound")).alias("label"))


@query("t3_label5_from_probs", "SELECT id, CASE WHEN b > 0.7 THEN 'Very Bullish' WHEN b > 0.5 THEN 'Bullish' WHEN a > 0.7 THEN 'Very Bearish' WHEN a > 0.5 THEN 'Bearish' ELSE 'Neutral' END AS label, CASE WHEN b > 0.7 THEN 0.75 WHEN b > 0.5 THEN 0.25 WHEN a > 0.7 THEN -0.75 WHEN a > 0.5 THEN -0.25 ELSE 0.0 END::double AS score, round(a * 0.7, 6) AS very_bearish FROM (SELECT id, (id % 11) / 10.0::double AS a, (1 - (id % 11) / 10.0::double) * (id % 7) / 6.0::double AS b FROM posts)", "posts")
def _(s, d):
    a = (F.col("id") % 11) / F.lit(10.0)
    b = (1 - a) * (F.col("id") % 7) / F.lit(6.0)
    return V.posts(s, d).select("id", S.label5_from_probs(a, 1 - a - b, b).alias("r")).select("id", "r.label", "r.score", r6("r.very_bearish").alias("very_bearish"))


@query("t4_ensemble_score", f"WITH {_SCORED} SELECT id, round(sentiment_score, 6) AS sentiment_score FROM scored", "posts lexicon")
def _(s, d):
    return scored(s, d).select("id", r6("sentiment_score").alias("sentiment_score"))


@query("t9_score_posts", f"WITH {_SCORED} SELECT id, sentiment_label, round(sentiment_score, 6) AS sentiment_score, round(confidence, 6) AS confidence, {_IMPACT} AS market_impact FROM scored", "posts lexicon")
def _(s, d):
    return scored(s, d).select("id", "sentiment_label", r6("sentiment_score").alias("sentiment_score"), r6("confidence").alias("confidence"), "market_impact")


_CLEANED = r"""SELECT * REPLACE (regexp_replace(regexp_replace(regexp_replace(title || ' ' || selftext, 'https?://\S+', '', 'g'), '<[^>]+>', '', 'g'), '@[\p{L}\p{M}\p{N}_]+', '', 'g') AS selftext, NULL AS title) FROM posts"""
_DEEP = "CASE WHEN id % 5 = 0 THEN NULL WHEN b > 0.7 THEN 0.75 WHEN b > 0.5 THEN 0.25 WHEN a > 0.7 THEN -0.75 WHEN a > 0.5 THEN -0.25 ELSE 0.0 END"


@query("t9_whole_chain", f"WITH raw AS (SELECT * FROM posts), cleaned AS ({_CLEANED}), {lex_sql('lexicon').replace('FROM posts', 'FROM cleaned AS posts')}, p AS (SELECT id, (id % 11) / 10.0::double AS a, (1 - (id % 11) / 10.0::double) * (id % 7) / 6.0::double AS b FROM posts), deep AS (SELECT id, cast({_DEEP} AS double) AS deep FROM p) SELECT id, round(CASE WHEN deep IS NULL THEN compound ELSE 0.3 * compound + 0.7 * deep END * least(1.0, 0.5 + score / 1000.0::double) * upvote_ratio, 6) AS sentiment_score FROM posts JOIN lex USING (id) JOIN deep USING (id)", "posts lexicon")
def _(s, d):
    posts = V.posts(s, d)
    a = (F.col("id") % 11) / F.lit(10.0)
    b = (1 - a) * (F.col("id") % 7) / F.lit(6.0)
    known = F.col("id") % 5 != 0
    deep = posts.select("id", *(F.when(known, c).alias(n) for c, n in ((a, "p_neg"), (1 - a - b, "p_neu"), (b, "p_pos"))))
    r = O.score_posts(posts, V.lexicon(s), deep, negations=V.NEGATIONS, boosters=V.BOOSTERS)
    return r.select("id", r6("sentiment_score").alias("sentiment_score"))


@query("t8_deep_scores")
def _(s, d):
    docs = s.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    labelled = docs.join(s.read.parquet(f"{d}/labels.parquet").select("doc_id", F.col("toxic").cast("double").alias("label")), "doc_id")
    model = O.fit_default_model(labelled)
    return O.score_distinct(docs, "text", lambda t: model.transform(t).select("_h", "text", F.col("prediction"))).select("doc_id", "prediction")


@query("t8_deep_tier", "SELECT doc_id, n % 10 = 0 AS failed, CASE WHEN n % 10 <> 0 THEN round((n % 7) / 7.0::double, 6) END AS p_pos, CASE WHEN n % 10 <> 0 THEN round(1 - (n % 7) / 7.0::double, 6) END AS p_neg FROM (SELECT doc_id, length(substr(text, 1, 2048)) AS n FROM documents)")
def _(s, d):
    def scorer(texts):
        # a model that cannot take some texts
        if any(len(t) % 10 == 0 for t in texts):
            raise ValueError("too odd")
        return [(1 - len(t) % 7 / 7, 0.0, len(t) % 7 / 7) for t in texts]

    r = O.deep_scores(s.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), scorer)
    return r.select("doc_id", F.col("deep_failed").alias("failed"), r6("p_pos").alias("p_pos"), r6("p_neg").alias("p_neg"))


@query("j7_score_distinct", f"SELECT doc_id, cast(len(list_filter(string_split_regex(text, '{WORD}'), lambda w: w <> '')) AS bigint) AS n FROM documents")
def _(s, d):
    docs = s.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    return O.score_distinct(docs, "text", lambda t: t.withColumn("n", F.size(X.words(F.col("text"))).cast("long"))).select("doc_id", "n")


@query("j7_kept_scores", "WITH t AS (SELECT md5(text) AS h, min(doc_id % 2) AS first FROM documents GROUP BY 1) SELECT cast(b AS bigint) AS batch, (SELECT count(*) FROM t WHERE (b = 0 AND first = 0) OR (b = 1 AND first = 1)) AS n_scored, (SELECT count(*) FROM documents WHERE b > 0 OR doc_id % 2 = 0) AS n_rows FROM (SELECT unnest([0, 1, 2]) AS b)")
def _(s, d):
    # the documents of even ids, then all, then all once more: each batch scores what is new
    path, docs, rows = f"{scratch(s)}/scores", s.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), []
    count = lambda t: t.withColumn("n", F.size(X.words(F.col("text"))).cast("long"))
    for k, some in enumerate((docs.where("doc_id % 2 = 0"), docs, docs)):
        n_rows = Y.get_or_compute(some, "text", count, path, "1", str(k)).count()
        rows.append((k, Y.kept_scores(s, path, "1").where(F.col("batch") == k).count(), n_rows))
    return s.createDataFrame(rows, "batch long, n_scored long, n_rows long")


@query("p6_flatten_sentiment", f"WITH {_SCORED} SELECT sentiment_label, count(*) AS n, round(avg(confidence), 6) AS mean_confidence FROM scored GROUP BY 1", "posts lexicon")
def _(s, d):
    return scored(s, d).groupBy("sentiment_label").agg(F.count("*").alias("n"), r6(F.avg("confidence")).alias("mean_confidence"))


@query("p7_market_impact", f"WITH {_SCORED} SELECT {_IMPACT} AS market_impact, count(*) AS n FROM scored GROUP BY 1", "posts lexicon")
def _(s, d):
    return scored(s, d).groupBy("market_impact").agg(F.count("*").alias("n"))


def ticker_facts(s, d):
    """id, ticker, score, confidence, ts, date, source of each post's known symbols."""
    r = scored(s, d).join(posts_with_symbols(s, d).select("id", "symbols"), "id")
    return r.select("id", F.explode("symbols").alias("ticker"), F.col("sentiment_score").alias("score"), "confidence", "sentiment_label", F.col("created_utc").alias("ts"), T.created_date(r).alias("date"), F.when(F.col("id") % 3 == 0, "reddit").when(F.col("id") % 3 == 1, "news").otherwise("twitter").alias("source"))


_FACTS = f"""{_SCORED}, syms AS ({_SYMS}), facts AS (SELECT scored.id, unnest(symbols) AS ticker, sentiment_score AS score, confidence, sentiment_label, scored.created_utc AS ts, cast(make_timestamp(scored.created_utc * 1000000) AS date) AS date, CASE WHEN scored.id % 3 = 0 THEN 'reddit' WHEN scored.id % 3 = 1 THEN 'news' ELSE 'twitter' END AS source FROM scored JOIN (SELECT id, symbols FROM syms) USING (id)),
daily AS (SELECT ticker, date, avg(score) AS sentiment, count(*) AS n FROM facts GROUP BY 1, 2)"""


def daily_sentiment(s, d):
    return ticker_facts(s, d).groupBy("ticker", "date").agg(F.avg("score").alias("sentiment"), F.count("*").alias("n"))


@query("p12_ticker_rows", f"WITH {_FACTS} SELECT id, ticker, sentiment_label AS sentiment, round(score, 6) AS score, round(confidence, 6) AS confidence FROM facts", "posts lexicon")
def _(s, d):
    r = scored(s, d).drop("ticker_sentiments").join(posts_with_symbols(s, d).select("id", "symbols"), "id")
    r = r.withColumn("ticker_sentiments", S.ticker_sentiments(F.col("symbols"), F.col("sentiment_label"), F.col("sentiment_score"), F.col("confidence")))
    return O.ticker_rows(r).select("id", "ticker", "sentiment", r6("score").alias("score"), r6("confidence").alias("confidence"))


@query("j8_ticker_with_post", f"WITH {_FACTS} SELECT subreddit, ticker, count(*) AS n, round(avg(facts.score), 6) AS mean_score FROM facts JOIN posts USING (id) GROUP BY 1, 2", "posts lexicon")
def _(s, d):
    r = T.ticker_with_post(ticker_facts(s, d), V.posts(s, d).select("id", "subreddit"))
    return r.groupBy("subreddit", "ticker").agg(F.count("*").alias("n"), r6(F.avg("score")).alias("mean_score"))


# joins


@query("j1_valid_tickers_join", f"SELECT doc_id, ticker FROM (SELECT doc_id, unnest(string_split_regex(text, '{WORD}')) AS ticker FROM documents) WHERE regexp_full_match(ticker, '[A-Z]{{1,5}}') AND ticker IN (SELECT ticker FROM tickers)", "tickers")
def _(s, d):
    mentions = s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.explode(X.bare_tickers(F.col("text"))).alias("ticker"))
    return T.valid_tickers_join(mentions, V.words_table(s, V.TICKERS, "ticker")).select("doc_id", "ticker")


@query("j1_valid_mentions", ORACLE_SQL["j1_valid_tickers_join"])
def _(s, d):
    return T.valid_mentions(s.read.parquet(f"{d}/documents.parquet"), V.words_table(s, V.TICKERS, "ticker"), "doc_id", F.col("text"))


@query("j2_unseen", "SELECT url FROM news WHERE doc_id % 3 <> 0", "news")
def _(s, d):
    news = V.news(s, d)
    return T.unseen(news, news.where("doc_id % 3 = 0")).select("url")


@query("j3_comments_of_active_posts", "SELECT id, post_id FROM comments WHERE post_id IN (SELECT id FROM posts WHERE score >= 4000 OR num_comments >= 60)", "posts comments")
def _(s, d):
    return T.comments_of_active_posts(V.comments(s, d), V.posts(s, d), 4000, 60).select("id", "post_id")


@query("j4_watchlist_mentions", f"SELECT DISTINCT doc_id, symbol FROM (SELECT doc_id, unnest(string_split_regex(upper(text), '{WORD}')) AS t FROM documents) JOIN watchlist ON t = upper(symbol)", "watchlist")
def _(s, d):
    return T.watchlist_mentions(s.read.parquet(f"{d}/documents.parquet"), V.words_table(s, V.WATCHLIST, "symbol"), "doc_id", F.col("text"))


_OK = "close IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND volume >= 0 AND high >= low AND high >= open AND high >= close AND low <= open AND low <= close"
_FOLD = f"""RECURSIVE WITH numbered AS (SELECT symbol, bar_ts, close, coalesce({_OK}, false) AS ok, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) AS k FROM raw_bars),
fold AS (SELECT symbol, bar_ts, close, ok, k, cast(NULL AS double) AS last_close, ok AS accepted FROM numbered WHERE k = 1 UNION ALL
SELECT n.symbol, n.bar_ts, n.close, n.ok, n.k, CASE WHEN f.accepted THEN f.close ELSE f.last_close END, n.ok AND ((CASE WHEN f.accepted THEN f.close ELSE f.last_close END) IS NULL OR NOT abs(n.close - (CASE WHEN f.accepted THEN f.close ELSE f.last_close END)) / (CASE WHEN f.accepted THEN f.close ELSE f.last_close END) * 100 > 20)
FROM fold f JOIN numbered n ON n.symbol = f.symbol AND n.k = f.k + 1)"""


def checked_bars(s, d):
    c = F.col
    ok = (c("volume") >= 0) & c("close").isNotNull() & R.rule_ohlc(c("open"), c("high"), c("low"), c("close")).isNull()
    return V.raw_bars(s, d).select("symbol", "bar_ts", "close", F.coalesce(ok, F.lit(False)).alias("ok"))


@query("j5_with_last_valid", f"{_FOLD} SELECT symbol, epoch(bar_ts)::bigint AS ts, round(last_close, 6) AS last_close, accepted FROM fold", "raw_bars")
def _(s, d):
    return L.with_last_valid(checked_bars(s, d)).select("symbol", F.unix_timestamp(F.col("bar_ts").cast("timestamp")).alias("ts"), r6("last_close").alias("last_close"), "accepted")


_ONE = _FOLD.replace("SELECT symbol, bar_ts, close, coalesce", "SELECT 'ALL' AS symbol, bar_ts, close, coalesce").replace("row_number() OVER (PARTITION BY symbol ORDER BY bar_ts)", "row_number() OVER (ORDER BY bar_ts, symbol)")


@query("j5_one_symbol_in_blocks", f"{_ONE} SELECT epoch(bar_ts)::bigint AS ts, round(last_close, 6) AS last_close, count(*) AS n, count(*) FILTER (accepted) AS n_accepted FROM fold GROUP BY 1, 2", "raw_bars")
def _(s, d):
    # all bars as one symbol's, whose order among bars of one time is that of their names
    first = F.unix_timestamp(F.col("bar_ts").cast("timestamp"))
    rows = checked_bars(s, d).select(F.lit("ALL").alias("symbol"), F.struct("bar_ts", "symbol").alias("bar_ts"), "close", "ok", first.alias("ts"))
    return L.with_last_valid(rows, blocks=16).groupBy("ts", r6("last_close").alias("last_close")).agg(F.count("*").alias("n"), F.count_if("accepted").alias("n_accepted"))


@query("v10_sudden_change", f"{_FOLD} SELECT symbol, count(*) AS n FROM fold WHERE ok AND NOT accepted GROUP BY 1", "raw_bars")
def _(s, d):
    return L.with_last_valid(checked_bars(s, d)).where("ok and not accepted").groupBy("symbol").agg(F.count("*").alias("n"))


@query("w2_latest_valid", f"{_FOLD} SELECT symbol, round(arg_max(close, bar_ts), 6) AS close, epoch(max(bar_ts))::bigint AS ts FROM fold WHERE accepted GROUP BY 1", "raw_bars")
def _(s, d):
    return T.latest_valid_per_symbol(L.with_last_valid(checked_bars(s, d))).select("symbol", r6("close").alias("close"), F.unix_timestamp(F.col("bar_ts").cast("timestamp")).alias("ts"))


@query("j6_posts_for_symbol", f"WITH syms AS ({_SYMS}) SELECT id FROM syms WHERE list_contains(symbols, 'THE')", "posts")
def _(s, d):
    return T.posts_for_symbol(posts_with_symbols(s, d), "THE").select("id")


# aggregates


@query("a1_overview", "SELECT count(*) AS n_posts, round(avg(score), 2) AS mean_score, cast(coalesce(sum(num_comments), 0) AS bigint) AS total_comments, count(DISTINCT subreddit) AS n_subreddits FROM posts", "posts")
def _(s, d):
    return T.overview(V.posts(s, d))


@query("a2_top_subreddits", "SELECT subreddit, count(*) AS n FROM posts GROUP BY 1 ORDER BY n DESC, subreddit LIMIT 10", "posts")
def _(s, d):
    return T.top_subreddits(V.posts(s, d))


@query("a3_subreddit_engagement", "SELECT subreddit, round(avg(score), 6) AS mean_score, cast(sum(score) AS bigint) AS total_score, round(avg(num_comments), 6) AS mean_comments, cast(sum(num_comments) AS bigint) AS total_comments FROM posts GROUP BY 1 ORDER BY total_score DESC, subreddit LIMIT 10", "posts")
def _(s, d):
    r = T.subreddit_engagement(V.posts(s, d))
    return r.withColumns({c: r6(c) for c in ("mean_score", "mean_comments")})


@query("a4_symbol_mentions", f"WITH syms AS ({_SYMS}) SELECT symbol, count(*) AS n FROM (SELECT unnest(symbols) AS symbol FROM syms) GROUP BY 1 ORDER BY n DESC, symbol LIMIT 15", "posts")
def _(s, d):
    return T.symbol_mentions(posts_with_symbols(s, d))


@query("a5_symbol_summary", f"WITH syms AS ({_SYMS}) SELECT count(*) AS n_posts, round(avg(score), 2) AS mean_score FROM syms WHERE list_contains(symbols, 'DE')", "posts")
def _(s, d):
    return T.symbol_summary(posts_with_symbols(s, d), "DE")


_DAY = "cast(cast(make_timestamp(created_utc * 1000000) AS date) AS varchar)"


@query("a6_symbol_mentions_by_date", f"WITH syms AS ({_SYMS}) SELECT {_DAY} AS date, count(*) AS n FROM syms WHERE list_contains(symbols, 'THE') GROUP BY 1", "posts")
def _(s, d):
    return T.symbol_mentions_by_date(posts_with_symbols(s, d), "THE").withColumn("date", F.col("date").cast("string"))


@query("a7_posts_by_date", f"SELECT {_DAY} AS date, count(*) AS n FROM posts GROUP BY 1", "posts")
def _(s, d):
    return T.posts_by_date(V.posts(s, d)).withColumn("date", F.col("date").cast("string"))


@query("a8_sentiment_by_date", f"WITH {_SCORED} SELECT {_DAY} AS date, round(avg(sentiment_score), 6) AS mean_sentiment, count(*) AS n FROM scored GROUP BY 1", "posts lexicon")
def _(s, d):
    return T.sentiment_by_date(scored(s, d)).select(F.col("date").cast("string").alias("date"), r6("mean_sentiment").alias("mean_sentiment"), "n")


_OUTCOME = "CASE WHEN id % 17 = 0 THEN 'error' WHEN length(title) < 10 THEN 'invalid' ELSE 'valid' END"


@query("a9_validation_stats", f"SELECT created_utc - created_utc % 86400 AS start, count(*) AS processed, count(*) FILTER (o = 'valid') AS valid, count(*) FILTER (o = 'invalid') AS invalid, count(*) FILTER (o = 'error') AS errors, round(count(*) FILTER (o = 'valid') * 100.0::double / count(*), 6) AS valid_percent, round(count(*) FILTER (o = 'invalid') * 100.0::double / count(*), 6) AS invalid_percent, round(count(*) FILTER (o = 'error') * 100.0::double / count(*), 6) AS error_percent FROM (SELECT *, {_OUTCOME} AS o FROM posts) GROUP BY 1", "posts")
def _(s, d):
    routed = V.posts(s, d).select(F.timestamp_seconds("created_utc").alias("ts"), F.expr(_OUTCOME).alias("outcome"))
    return T.validation_stats(routed, "ts", "1 day").select(F.unix_timestamp("start").alias("start"), "processed", "valid", "invalid", "errors", *(r6(c).alias(c) for c in ("valid_percent", "invalid_percent", "error_percent")))


@query("a10_collection_counts", "SELECT subreddit, m AS collection_method, count(*) AS n FROM (SELECT subreddit, CASE WHEN score >= 2500 THEN 'top/week' ELSE 'new' END AS m FROM posts WHERE score >= 2500 OR id % 2 = 0) GROUP BY 1, 2", "posts")
def _(s, d):
    p = V.posts(s, d)
    return T.count_by(T.dedup_listings([("top/week", p.where("score >= 2500")), ("new", p.where("id % 2 = 0"))]), "subreddit", "collection_method")


@query("a11_bars_per_symbol", "SELECT symbol, count(*) AS n FROM bars GROUP BY 1", "bars")
def _(s, d):
    return T.count_by(V.bars(s, d), "symbol")


@query("a12_comments_per_post", "SELECT post_id, count(*) AS n FROM comments GROUP BY 1", "comments")
def _(s, d):
    return T.count_by(V.comments(s, d), "post_id")


# listings and limits


@query("w1_first_n_per_group", "SELECT id, subreddit FROM (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, id) AS k FROM posts) WHERE k <= 3", "posts")
def _(s, d):
    return T.first_n_per_group(V.posts(s, d), ["subreddit"], [F.desc("score"), "id"], 3).select("id", "subreddit")


@query("l1_limit_scan", "SELECT least(count(*), 500) AS n FROM documents")
def _(s, d):
    return io.read_store(s, f"{d}/documents.parquet", limit=500).agg(F.count("*").alias("n"))


@query("l2_top_posts", f"SELECT method, subreddit, id FROM (SELECT 'hot' AS method, id, subreddit, row_number() OVER (PARTITION BY subreddit ORDER BY score / pow(greatest(({NOW_S} - created_utc) / 3600.0::double, 0) + 2, 1.5) DESC, id) AS k FROM posts UNION ALL SELECT 'new', id, subreddit, row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, id) FROM posts UNION ALL SELECT 'top', id, subreddit, row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, id) FROM posts UNION ALL SELECT 'rising', id, subreddit, row_number() OVER (PARTITION BY subreddit ORDER BY score / greatest(({NOW_S} - created_utc) / 3600.0::double, 1) DESC, id) FROM posts) WHERE k <= 2", "posts")
def _(s, d):
    p = V.posts(s, d)
    return T.union_topics(*(T.top_posts(p, m, 2, now()).select(F.lit(m).alias("method"), "subreddit", "id") for m in ("hot", "new", "top", "rising")))


@query("l2_top_posts_of_the_day", f"SELECT age, subreddit, id FROM (SELECT age, id, subreddit, row_number() OVER (PARTITION BY age, subreddit ORDER BY score DESC, id) AS k FROM posts, (SELECT unnest(['day', 'week']) AS age) WHERE created_utc BETWEEN {NOW_S} - CASE age WHEN 'day' THEN 86400 ELSE 7 * 86400 END AND {NOW_S}) WHERE k <= 3", "posts")
def _(s, d):
    p = V.posts(s, d)
    return T.union_topics(*(T.top_posts(p, "top", 3, now(), hours).select(F.lit(age).alias("age"), "subreddit", "id") for age, hours in (("day", 24), ("week", 168))))


@query("l3_first_comments", "SELECT id, post_id FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY depth, created_utc, id) AS k FROM comments) WHERE k <= 2", "comments")
def _(s, d):
    return T.first_comments(V.comments(s, d), 2).select("id", "post_id")


@query("l4_search_symbol_posts", f"WITH syms AS ({_SYMS}) SELECT symbol, id FROM (SELECT symbol, id, row_number() OVER (PARTITION BY symbol ORDER BY score DESC, id) AS k FROM (SELECT unnest(symbols) AS symbol, id, score FROM syms WHERE id % 5 <> 0 AND created_utc BETWEEN {NOW_S - 7 * 86400} AND {NOW_S})) WHERE k <= 5", "posts")
def _(s, d):
    p = posts_with_symbols(s, d)
    return T.search_symbol_posts(p, p.where("id % 5 = 0"), 5, now(), "week").select("symbol", "id")


@query("l5_bar_range_spans", "SELECT symbol, ts, open, high, low, close, volume FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS k FROM (SELECT symbol, epoch(bar_ts)::bigint // 14400 * 14400 AS ts, arg_min(open, bar_ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, bar_ts) AS close, cast(sum(volume) AS bigint) AS volume FROM bars WHERE symbol IN ('view', 'click') AND bar_ts >= TIMESTAMP '2024-01-02' GROUP BY 1, 2)) WHERE k <= 50", "bars")
def _(s, d):
    rows = T.bar_range(V.bars(s, d), ["view", "click"], "2024-01-02", "2100-01-01", 50, multiplier=4, timespan="hour")
    return rows.select("symbol", F.unix_timestamp(F.col("bar_ts").cast("timestamp")).alias("ts"), "open", "high", "low", "close", "volume")


@query("l6_news_queries", f"SELECT DISTINCT url FROM news WHERE (published_utc BETWEEN {NOW_S - 7 * 86400} AND {NOW_S} AND contains(lower(concat_ws(' ', title, description, content)), 'the')) OR (published_utc BETWEEN {NOW_S - 86400} AND {NOW_S} AND lang IN ('de'))", "news")
def _(s, d):
    return T.news_queries(V.news(s, d), [{"q": "the", "page_size": 1000}, {"languages": ["de"], "start": NOW_S - 86400, "page_size": 1000}], NOW_S).select("url")


@query("l5_bar_range", "SELECT symbol, epoch(bar_ts)::bigint AS ts FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts DESC) AS k FROM bars WHERE symbol IN ('view', 'click') AND bar_ts >= TIMESTAMP '2024-01-02' AND bar_ts < TIMESTAMP '2024-01-20') WHERE k <= 20", "bars")
def _(s, d):
    return T.bar_range(V.bars(s, d), ["view", "click"], "2024-01-02", "2024-01-20", 20, True).select("symbol", F.unix_timestamp(F.col("bar_ts").cast("timestamp")).alias("ts"))


@query("l6_news_query", f"SELECT url, published_utc FROM news WHERE published_utc BETWEEN {NOW_S - 30 * 86400} AND {NOW_S} AND contains(lower(concat_ws(' ', title, description, content)), 'the') AND lang IN ('en') AND regexp_extract(url, 'https?://([^/?#:]+)', 1) IN ('news.example.com') ORDER BY published_utc DESC, url LIMIT 50", "news")
def _(s, d):
    return T.news_query(V.news(s, d), "the", NOW_S - 30 * 86400, NOW_S, ["en"], domains=["news.example.com"], page_size=50).select("url", "published_utc")


@query("l7_date_filter", "SELECT id FROM posts WHERE make_timestamp(created_utc * 1000000) >= TIMESTAMP '2024-01-03' AND make_timestamp(created_utc * 1000000) < TIMESTAMP '2024-01-12'", "posts")
def _(s, d):
    return T.date_filter(V.posts(s, d), "2024-01-03", "2024-01-11").select("id")


@query("l7_dated_store", "SELECT id, cast(cast(make_timestamp(created_utc * 1000000) AS date) AS varchar) AS date FROM posts WHERE make_timestamp(created_utc * 1000000) >= TIMESTAMP '2024-01-03' AND make_timestamp(created_utc * 1000000) < TIMESTAMP '2024-01-12'", "posts")
def _(s, d):
    path = f"{scratch(s)}/posts"
    io.write_dated(V.posts(s, d).select("id", "created_utc"), path, "created_utc")
    return io.read_dated(s, path, "2024-01-03", "2024-01-11").select("id", F.col("date").cast("string").alias("date"))


_SPAN = lambda unit, start: f"SELECT '{unit}' AS unit, symbol, cast({start} AS varchar) AS day, max(high) AS high, cast(sum(volume) AS bigint) AS volume FROM bars GROUP BY 1, 2, 3"


@query("l5_calendar_spans", " UNION ALL ".join((_SPAN("week", "cast(date_trunc('week', bar_ts) AS date)"), _SPAN("month", "cast(date_trunc('month', bar_ts) AS date)"), _SPAN("quarter", "cast(date_trunc('quarter', bar_ts) AS date)"), _SPAN("year", "cast(date_trunc('year', bar_ts) AS date)"), _SPAN("day", "cast(bar_ts AS date)"))), "bars")
def _(s, d):
    bars = V.bars(s, d)
    symbols = [r["symbol"] for r in bars.select("symbol").distinct().collect()]
    spans = (T.bar_range(bars, symbols, "2000-01-01", "2100-01-01", 10**6, timespan=u).withColumn("unit", F.lit(u)) for u in ("week", "month", "quarter", "year", "day"))
    return T.union_topics(*spans).select("unit", "symbol", F.to_date("bar_ts").cast("string").alias("day"), "high", "volume")


# routing


@query("r2_route_reddit", f"WITH syms AS ({_SYMS}) SELECT CASE WHEN len(symbols) > 0 THEN 'reddit-symbols' ELSE 'reddit-posts' END AS topic, count(*) AS n FROM syms GROUP BY 1", "posts")
def _(s, d):
    return T.route_reddit(posts_with_symbols(s, d).withColumn("content_type", F.lit("post"))).groupBy("topic").agg(F.count("*").alias("n"))


@query("r3_union_topics", "SELECT kind, count(*) AS n, cast(sum(id) AS bigint) AS ids FROM (SELECT 'post' AS kind, id FROM posts UNION ALL SELECT 'comment', id FROM comments) GROUP BY 1", "posts comments")
def _(s, d):
    both = T.union_topics(V.posts(s, d).withColumn("kind", F.lit("post")), V.comments(s, d).withColumn("kind", F.lit("comment")))
    return both.groupBy("kind").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query("r4_fan_out_symbols", f"WITH syms AS ({_SYMS}) SELECT symbol, concat('reddit_symbol_', symbol, '_', id) AS key FROM (SELECT id, unnest(symbols) AS symbol FROM syms)", "posts")
def _(s, d):
    return T.fan_out_symbols(posts_with_symbols(s, d)).select("symbol", "key")


@query("r5_classify_payload", "SELECT CASE WHEN doc_id % 7 = 0 THEN 'skipped' WHEN doc_id % 5 = 0 THEN 'error' WHEN doc_id % 3 = 0 THEN 'error' ELSE 'object' END AS kind, count(*) AS n FROM documents GROUP BY 1")
def _(s, d):
    docs = s.read.parquet(f"{d}/documents.parquet")
    value = F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 5 == 0, F.concat(F.lit("{bad"), "lang")).when(F.col("doc_id") % 3 == 0, F.to_json(F.array("source"))).otherwise(F.to_json(F.struct("doc_id", "source")))
    return P.classify_payload(docs.select(value.alias("value"))).groupBy("kind").agg(F.count("*").alias("n"))


@query("r6_dedup_cycle", "SELECT h, min(doc_id) AS doc_id FROM (SELECT md5(text) AS h, doc_id FROM documents) GROUP BY 1")
def _(s, d):
    return T.dedup_cycle(s.read.parquet(f"{d}/documents.parquet").select(F.md5("text").alias("h"), "doc_id"), ["doc_id"], "h")


@query("r7_dedup_listings", "SELECT id, CASE WHEN num_comments > 50 THEN 'hot' WHEN created_utc % 7200 = 0 THEN 'new' ELSE 'top/day' END AS collection_method FROM posts WHERE num_comments > 50 OR created_utc % 7200 = 0 OR score > 3000", "posts")
def _(s, d):
    p = V.posts(s, d)
    return T.dedup_listings([("hot", p.where("num_comments > 50")), ("new", p.where("created_utc % 7200 = 0")), ("top/day", p.where("score > 3000"))]).select("id", "collection_method")


# validation


@query("v1_filter_bars", f"SELECT symbol, epoch(bar_ts)::bigint AS ts FROM raw_bars WHERE {_OK}", "raw_bars")
def _(s, d):
    return B.filter_bars(V.raw_bars(s, d)).select("symbol", F.unix_timestamp(F.col("bar_ts").cast("timestamp")).alias("ts"))


def bar_messages(s, d):
    """Bars as JSON, some with an unknown key or a wrong type."""
    rows = P.bar_record(V.raw_bars(s, d), F.lit("2024-01-31T00:00:00Z")).drop("key").withColumn("h", F.floor(F.col("timestamp") / 3600000))
    plain = F.to_json(F.struct(*[c for c in rows.columns if c != "h"]))
    value = F.when(F.col("h") % 31 == 0, F.regexp_replace(plain, r"\}$", ',"extra":1}')).when(F.col("h") % 37 == 0, F.regexp_replace(plain, r'"volume":(-?\d+)', '"volume":"many"')).otherwise(plain)
    return P.classify_payload(rows.select(value.alias("value")))


#: Prices are above 0 and a million at most, each field for itself.
_PRICES = ", ".join(f"CASE WHEN {n} <= 0 OR {n} > 1000000 THEN 'Schema error: Field ''{n}'': price_bounds' END" for n in ("open", "high", "low", "close"))
_BARERR = f"""WITH e AS (SELECT symbol, epoch(bar_ts)::bigint AS t, h % 31 = 0 AS extra, h % 31 <> 0 AND h % 37 = 0 AS typ, *
 FROM (SELECT *, epoch(bar_ts)::bigint // 3600 AS h FROM raw_bars)),
f AS (SELECT symbol, t, close, list_filter([CASE WHEN symbol IS NULL THEN 'Schema error: Field ''symbol'': missing' END, CASE WHEN close IS NULL THEN 'Schema error: Field ''close'': missing' END, CASE WHEN typ THEN 'Schema error: Field ''volume'': type' END, CASE WHEN extra THEN 'Schema error: Field ''extra'': extra_forbidden' END, CASE WHEN length(symbol) NOT BETWEEN 1 AND 10 THEN 'Schema error: Field ''symbol'': length' END, {_PRICES}, CASE WHEN (volume < 0 OR volume > 10000000000) AND NOT typ THEN 'Schema error: Field ''volume'': count_bounds' END], lambda x: x IS NOT NULL) AS se,
list_filter([CASE WHEN close IS NOT NULL AND (high < open OR high < low OR high < close OR low > open OR low > high OR low > close) THEN 'Business rule error: ' || array_to_string(list_filter([CASE WHEN high < open OR high < low OR high < close THEN 'High price is not the highest value' END, CASE WHEN low > open OR low > high OR low > close THEN 'Low price is not the lowest value' END], lambda x: x IS NOT NULL), '; ') END,
CASE WHEN t < {NOW_S} - 48 * 3600 THEN 'Business rule error: Data is too old (older than 48 hours)' WHEN t > {NOW_S} + 300 THEN 'Business rule error: Data timestamp is in the future' END, CASE WHEN close <= 0 THEN 'Business rule error: Price must be positive' WHEN NOT (close > 0.001 AND close < 10000) THEN 'Business rule error: Price ' || cast(close AS varchar) || ' is outside expected range for most stocks' END], lambda x: x IS NOT NULL) AS be FROM e)"""


@query("v26_validate_bars", f"{_BARERR} SELECT upper(symbol) AS symbol, t AS ts, array_to_string(CASE WHEN len(se) > 0 THEN se ELSE be END, '|') AS errors FROM f", "raw_bars")
def _(s, d):
    return P.validate_bars(bar_messages(s, d), now()).select("symbol", (F.col("timestamp") / 1000).cast("long").alias("ts"), F.array_join("errors", "|").alias("errors"))


_CHANGED = f"""{_BARERR.replace("WITH e AS", "RECURSIVE WITH e AS", 1)},
g AS (SELECT upper(symbol) AS symbol, t, se, be, len(se) = 0 AND len(be) = 0 AND close IS NOT NULL AS ok, close, row_number() OVER (PARTITION BY upper(symbol) ORDER BY t, close NULLS FIRST, len(se) = 0 AND len(be) = 0) AS k FROM f),
fold AS (SELECT symbol, t, se, be, ok, close, k, cast(NULL AS double) AS last, ok AS accepted FROM g WHERE k = 1 UNION ALL
SELECT g.symbol, g.t, g.se, g.be, g.ok, g.close, g.k, CASE WHEN fold.accepted THEN fold.close ELSE fold.last END, g.ok AND ((CASE WHEN fold.accepted THEN fold.close ELSE fold.last END) IS NULL OR NOT abs(g.close - (CASE WHEN fold.accepted THEN fold.close ELSE fold.last END)) / (CASE WHEN fold.accepted THEN fold.close ELSE fold.last END) * 100 > 20) FROM fold JOIN g ON g.symbol IS NOT DISTINCT FROM fold.symbol AND g.k = fold.k + 1)"""


@query("v26_validate_bars_in_order", f"{_CHANGED} SELECT symbol, t AS ts, array_to_string(CASE WHEN len(se) > 0 THEN se WHEN ok AND NOT accepted THEN ['Business rule error: Suspicious price change of ' || printf('%.2f', abs(close - last) / last * 100) || '%'] ELSE be END, '|') AS errors FROM fold", "raw_bars")
def _(s, d):
    # an hour after the last bar, so that most are recent enough to be judged by their change
    return P.validate_bars_in_order(bar_messages(s, d), now()).select("symbol", (F.col("timestamp") / 1000).cast("long").alias("ts"), F.array_join("errors", "|").alias("errors"))


@query("r1_route", f"{_BARERR} SELECT CASE WHEN len(se) > 0 OR len(be) > 0 THEN 'invalid' ELSE 'valid' END AS topic, count(*) AS n FROM f GROUP BY 1", "raw_bars")
def _(s, d):
    return T.route(P.validate_bars(bar_messages(s, d), now()).withColumn("is_error", F.lit(False)), "valid", "invalid", "error").groupBy("topic").agg(F.count("*").alias("n"))


@query("v7_rule_ohlc", "SELECT error, count(*) AS n FROM (SELECT CASE WHEN close IS NULL THEN NULL WHEN (high < open OR high < low OR high < close) AND (low > open OR low > high OR low > close) THEN 'High price is not the highest value; Low price is not the lowest value' WHEN high < open OR high < low OR high < close THEN 'High price is not the highest value' WHEN low > open OR low > high OR low > close THEN 'Low price is not the lowest value' END AS error FROM raw_bars) GROUP BY 1", "raw_bars")
def _(s, d):
    return V.raw_bars(s, d).select(R.rule_ohlc(*(F.col(c) for c in ("open", "high", "low", "close"))).alias("error")).groupBy("error").agg(F.count("*").alias("n"))


@query("v8_rule_bar_recency", f"SELECT error, count(*) AS n FROM (SELECT CASE WHEN epoch(bar_ts) < {NOW_S} - 48 * 3600 THEN 'Data is too old (older than 48 hours)' WHEN epoch(bar_ts) > {NOW_S} + 300 THEN 'Data timestamp is in the future' END AS error FROM bars) GROUP BY 1", "bars")
def _(s, d):
    return V.bars(s, d).select(R.rule_bar_recency(F.col("bar_ts").cast("timestamp"), now()).alias("error")).groupBy("error").agg(F.count("*").alias("n"))


@query("v9_rule_price_band", "SELECT symbol, epoch(bar_ts)::bigint AS ts, 'Price ' || cast(close AS varchar) || ' is outside expected range for most stocks' AS error FROM raw_bars WHERE NOT (close > 0.001 AND close < 10000)", "raw_bars")
def _(s, d):
    return V.raw_bars(s, d).withColumn("error", R.rule_price_band(F.col("close"))).where("error is not null").select("symbol", F.unix_timestamp(F.col("bar_ts").cast("timestamp")).alias("ts"), "error")


_UTC = lambda seconds: f"strftime(make_timestamp(({seconds}) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"
_TIMES = f"""WHEN created_utc > {NOW_S} + 600 THEN 'Business rule error: Creation timestamp ' || {_UTC("created_utc")} || ' is suspiciously far in the future' ELSE '' END AS errors"""
_AGED = f"""CASE WHEN created_utc + 60 < {NOW_S} - 7 * 86400 THEN 'Collection timestamp ' || {_UTC("created_utc + 60")} || ' is older than 7 days' END"""


def collected(rows):
    return rows.withColumn("collection_timestamp", P.iso(F.timestamp_seconds(F.col("created_utc") + 60)))


@query("v12_check_post", f"SELECT id, CASE WHEN id % 43 = 0 THEN 'Schema error: Invalid or missing ''content_type'': story' WHEN id % 41 = 0 THEN 'Schema error: Field ''collection_timestamp'': iso_utc|Schema error: Field ''score'': missing|Schema error: Field ''url'': missing' WHEN length(title) < 1 THEN 'Schema error: Field ''title'': min_length' WHEN id % 37 = 0 THEN 'Business rule error: Collection timestamp ' || {_UTC('created_utc - 301')} || ' is significantly before creation timestamp ' || {_UTC('created_utc')} {_TIMES}, CASE WHEN id % 43 = 0 OR id % 41 = 0 OR id % 37 = 0 THEN '' ELSE array_to_string(list_filter([CASE WHEN length(title) < 5 THEN 'Post has a very short title.' END, CASE WHEN id % 2 = 0 AND selftext = '' AND length(title) < 20 THEN 'Self-post with no body and short title.' END, {_AGED}], lambda x: x IS NOT NULL), '|') END AS warnings FROM posts", "posts")
def _(s, d):
    c = F.col("id")
    p = collected(P.post_record(V.posts(s, d))).withColumn("is_self", c % 2 == 0).withColumn("url", F.when(c % 41 != 0, F.col("permalink"))).withColumn("score", F.when(c % 41 != 0, F.col("score"))).withColumn("content_type", F.when(c % 43 == 0, "story").otherwise("post"))
    early = P.iso(F.timestamp_seconds(F.col("created_utc") - 301))
    p = p.withColumn("collection_timestamp", F.when(c % 41 == 0, "2024-01-01 00:00:00").when(c % 37 == 0, early).otherwise(F.col("collection_timestamp")))
    plain = (c % 43 != 0) & (c % 41 != 0) & (c % 37 != 0)
    return P.validate_posts(p, now()).select("id", F.array_join("errors", "|").alias("errors"), F.when(plain, F.array_join("warnings", "|")).otherwise("").alias("warnings"))


@query("v13_check_comment", f"SELECT id, CASE WHEN id % 41 = 0 THEN 'Schema error: Field ''author'': missing|Schema error: Field ''parent_id'': missing' WHEN length(body) < 1 THEN 'Schema error: Field ''body'': min_length' {_TIMES}, array_to_string(list_filter([CASE WHEN length(body) < 3 THEN 'Comment has a very short body.' END, {_AGED}], lambda x: x IS NOT NULL), '|') AS warnings FROM comments", "comments")
def _(s, d):
    c = collected(P.comment_record(V.comments(s, d))).withColumns({"score": F.lit(1), "subreddit": F.lit("talk"), "permalink": F.lit("/r/talk")})
    c = c.withColumns({n: F.when(F.col("id") % 41 != 0, F.col(n)) for n in ("author", "parent_id")})
    return P.validate_posts(c, now()).select("id", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"))


@query("v14_check_iso_utc", "SELECT id, id % 3 = 0 AS passed FROM posts", "posts")
def _(s, d):
    at = F.timestamp_seconds("created_utc")
    text = F.when(F.col("id") % 3 == 0, P.iso(at)).when(F.col("id") % 3 == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).otherwise("yesterdayZ")
    return V.posts(s, d).select("id", R.check_iso_utc("t", text).isNull().alias("passed"))


@query("v15_created_datetime", "SELECT id, created_utc AS ts FROM posts", "posts")
def _(s, d):
    return V.posts(s, d).select("id", F.unix_timestamp(R.created_datetime(F.when(F.col("id") % 2 == 0, F.col("created_utc").cast("double") + 0.5), P.iso(F.timestamp_seconds("created_utc")))).alias("ts"))


@query("v16_normalise_symbols", f"SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '{WORD}'), lambda t: regexp_full_match(t, '[A-Z]{{1,5}}')), ',') AS symbols FROM documents")
def _(s, d):
    docs = s.read.parquet(f"{d}/documents.parquet")
    marked = F.transform(F.split("text", WORD), lambda t: F.when(F.length(t) % 2 == 0, F.concat(F.lit("$"), t)).otherwise(t))
    return docs.select("doc_id", F.coalesce(F.array_join(R.normalise_symbols(marked), ","), F.lit("")).alias("symbols"))


_NEWSERR = f"""list_filter([CASE WHEN title = '' THEN 'Missing title' WHEN length(title) < 10 THEN 'Title too short (minimum 10 characters)' WHEN upper(title) = title AND lower(title) <> title THEN 'Title is all uppercase' END, CASE WHEN greatest(length(description), length(content)) = 0 THEN 'Both description and content are missing' WHEN greatest(length(description), length(content)) < 50 THEN 'Content too short (minimum 50 characters)' END, CASE WHEN published_utc > {NOW_S} + 3600 THEN 'Publication date is in the future: ' || strftime(make_timestamp(published_utc * 1000000), '%Y-%m-%dT%H:%M:%SZ') WHEN published_utc < {NOW_S} - 30 * 86400 THEN 'Article too old (> 30 days)' END], lambda x: x IS NOT NULL)"""


def dated_news(s, d):
    """News with what the collector adds; some without a collector."""
    return V.news(s, d).withColumns({"publishedAt": P.iso(F.timestamp_seconds("published_utc")), "collected_at": F.lit(NOW), "collector_id": F.when(F.col("doc_id") % 47 != 0, "c1")})


@query("v23_validate_news", f"SELECT url, CASE WHEN title = '' OR doc_id % 47 = 0 THEN array_to_string(list_filter([CASE WHEN title = '' THEN 'Schema error: Field ''title'': min_length' END, CASE WHEN doc_id % 47 = 0 THEN 'Schema error: Field ''collector_id'': missing' END], lambda x: x IS NOT NULL), '|') ELSE array_to_string(list_transform({_NEWSERR}, lambda x: 'Business rule error: ' || x), '|') END AS errors FROM news", "news")
def _(s, d):
    return P.validate_news(dated_news(s, d), now()).select("url", F.array_join("errors", "|").alias("errors"))


@query("v22_finalise_news", "SELECT CASE WHEN doc_id % 4 = 0 THEN url ELSE concat('a', doc_id) END AS article_id, '1.0.0' AS validation_version FROM news", "news")
def _(s, d):
    n = V.news(s, d).withColumn("article_id", F.when(F.col("doc_id") % 8 == 0, "").when(F.col("doc_id") % 4 == 0, None).otherwise(F.concat(F.lit("a"), "doc_id")))
    return P.finalise_news(n, now()).select("article_id", "validation_version")


@query("v23_rule_title", "SELECT error, count(*) AS n FROM (SELECT CASE WHEN title = '' THEN 'Missing title' WHEN length(title) < 10 THEN 'Title too short (minimum 10 characters)' WHEN upper(title) = title AND lower(title) <> title THEN 'Title is all uppercase' END AS error FROM news) GROUP BY 1", "news")
def _(s, d):
    return V.news(s, d).select(R.rule_title(F.col("title")).alias("error")).groupBy("error").agg(F.count("*").alias("n"))


@query("v24_rule_content", "SELECT error, count(*) AS n FROM (SELECT CASE WHEN greatest(length(description), length(content)) < 50 THEN 'Content too short (minimum 50 characters)' END AS error FROM news) GROUP BY 1", "news")
def _(s, d):
    return V.news(s, d).select(R.rule_content(F.col("description"), F.col("content")).alias("error")).groupBy("error").agg(F.count("*").alias("n"))


# records


@query("p1_parse_bars", "SELECT symbol, epoch(bar_ts)::bigint AS ts, close, volume FROM raw_bars", "raw_bars")
def _(s, d):
    raw = P.bar_record(V.raw_bars(s, d), F.lit("x"))
    half = F.when(F.col("timestamp") / 3600000 % 2 == 0, F.to_json(F.struct("symbol", "timestamp", "close", "volume"))).otherwise(F.to_json(F.struct(F.col("symbol").alias("Name"), F.timestamp_millis("timestamp").alias("date"), "close", "volume")))
    return P.parse_bars(raw.select(half.cast("binary").alias("value"))).select("symbol", F.unix_timestamp("ts").alias("ts"), "close", "volume")


@query("p2_parse_posts", "SELECT cast(id AS varchar) AS id, created_utc, score, cast(0 AS bigint) AS n_symbols FROM posts", "posts")
def _(s, d):
    raw = V.posts(s, d).withColumn("created_utc", F.col("created_utc").cast("double"))
    return P.parse_posts(raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))).select("id", "created_utc", "score", F.size("detected_symbols").cast("long").alias("n_symbols"))


@query("p8_bar_record", "SELECT symbol, epoch(bar_ts)::bigint * 1000 AS timestamp, concat(symbol, '_', epoch(bar_ts)::bigint * 1000) AS key FROM bars", "bars")
def _(s, d):
    return P.bar_record(V.bars(s, d), F.lit(NOW)).select("symbol", "timestamp", "key")


@query("p9_post_record", "SELECT id, author, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS post_created_datetime, concat('https://www.reddit.com/r/', subreddit, '/comments/', id) AS permalink FROM posts", "posts")
def _(s, d):
    p = V.posts(s, d).withColumn("author", F.nullif("author", F.lit("[deleted]")))
    return P.post_record(p).select("id", "author", "post_created_datetime", "permalink")


@query("p10_comment_record", "SELECT id, author, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS comment_created_datetime FROM comments", "comments")
def _(s, d):
    return P.comment_record(V.comments(s, d)).select("id", "author", "comment_created_datetime")


@query("p11_enrich_news", r"SELECT url, strftime(make_timestamp(published_utc * 1000000), '%Y-%m-%d') AS published_date, strftime(make_timestamp(published_utc * 1000000), '%H:%M:%S') AS published_time, length(content) AS length, len(list_filter(string_split_regex(content, '\s+'), lambda x: x <> '')) AS word_count FROM news", "news")
def _(s, d):
    return P.enrich_news(dated_news(s, d), now(), "c1").select("url", "published_date", "published_time", "content_stats.*")


@query("p11_unreadable_dates", "SELECT url, CASE WHEN doc_id % 9 = 0 THEN 'soon' ELSE strftime(make_timestamp(published_utc * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS published_at, CASE WHEN doc_id % 9 <> 0 THEN strftime(make_timestamp(published_utc * 1000000), '%Y-%m-%d') END AS published_date FROM news", "news")
def _(s, d):
    n = dated_news(s, d).withColumn("publishedAt", F.when(F.col("doc_id") % 9 == 0, "soon").otherwise(F.col("publishedAt")))
    return P.enrich_news(n, now(), "c1").select("url", "published_at", "published_date")


@query("p13_envelopes", """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '{"original_message":{"doc_id":' || doc_id || '},"validation_errors":["e"],"processing_timestamp":"' || '2024-01-31 00:00:00' || '","log_context":{"topic":"raw","offset":' || doc_id || ',"item_id":"UNKNOWN_ID"}}' WHEN 1 THEN '{"article":{"doc_id":' || doc_id || '},"errors":["e"],"timestamp":"2024-01-31 00:00:00"}' ELSE '{"original_message":{"doc_id":' || doc_id || '},"validation_errors":["e"],"processing_timestamp":"2024-01-31 00:00:00"}' END AS value FROM documents""")
def _(s, d):
    docs, one, errors = s.read.parquet(f"{d}/documents.parquet"), F.struct("doc_id"), F.array(F.lit("e"))
    context = P.log_context(F.lit("raw"), F.col("doc_id"), F.lit(None).cast("string"))
    value = F.when(F.col("doc_id") % 3 == 0, P.invalid_envelope(one, errors, F.lit(NOW), context)).when(F.col("doc_id") % 3 == 1, P.invalid_envelope(one, errors, F.lit(NOW), news=True)).otherwise(P.invalid_envelope(one, errors, F.lit(NOW)))
    return docs.select("doc_id", value.alias("value"))


@query("p14_error_envelopes", """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '{"original_payload":"' || lang || '","error":"Message value is not a dictionary","context":{"topic":"unknown","offset":-1,"item_id":"' || doc_id || '"}}' ELSE '{"error_type":"parse","error_message":"m","service_name":"svc","error_timestamp":"2024-01-31 00:00:00","original_payload":"' || lang || '","log_context":{"topic":"raw","offset":-1,"item_id":"' || doc_id || '"}}' END AS value FROM documents""")
def _(s, d):
    docs, ident, none = s.read.parquet(f"{d}/documents.parquet"), F.col("doc_id").cast("string"), F.lit(None)
    first = P.not_an_object_envelope(F.col("lang"), F.lit("Message value is not a dictionary"), P.log_context(none.cast("string"), none.cast("long"), ident))
    second = P.error_envelope(F.col("lang"), "parse", F.lit("m"), "svc", F.lit(NOW), P.log_context(F.lit("raw"), none.cast("long"), ident))
    return docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, first).otherwise(second).alias("value"))


@query("p15_message_key", "SELECT concat('validated_', coalesce(cast(CASE WHEN id % 9 = 0 THEN NULL ELSE id END AS varchar), 'UNKNOWN_ID')) AS key, subreddit AS market_key FROM posts", "posts")
def _(s, d):
    return V.posts(s, d).select(P.message_key("validated", F.when(F.col("id") % 9 != 0, F.col("id"))).alias("key"), P.message_key("market", F.col("subreddit")).alias("market_key"))


# bars and indicators

def _ts():
    return F.unix_timestamp(F.col("bar_ts").cast("timestamp"))

_ROWS = lambda n: f"(PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
_PREV = lambda n: f"(PARTITION BY symbol ORDER BY bar_ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


@query("d1_resample", "SELECT symbol, epoch(bar_ts)::bigint AS ts, open, high, low, close, volume FROM (SELECT symbol, date_trunc('day', bar_ts) AS bar_ts, arg_min(open, bar_ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, bar_ts) AS close, cast(sum(volume) AS bigint) AS volume FROM bars GROUP BY 1, 2)", "bars")
def _(s, d):
    return B.rebar(V.bars(s, d), "day").select("symbol", _ts().alias("ts"), "open", "high", "low", "close", "volume")


@query("d1_resample_ticks", "SELECT symbol, epoch(bar_ts)::bigint AS ts, open, high, low, close, volume FROM (SELECT symbol, date_trunc('minute', ts) AS bar_ts, arg_min(price, ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, ts) AS close, count(*) AS volume FROM ticks GROUP BY 1, 2)", "ticks")
def _(s, d):
    return B.resample(V.ticks(s, d), "minute").select("symbol", _ts().alias("ts"), "open", "high", "low", "close", "volume")


@query("d3_sma", f"SELECT symbol, epoch(bar_ts)::bigint AS ts, round(CASE WHEN count(*) OVER {_ROWS(10)} >= 10 THEN avg(close) OVER {_ROWS(10)} END, 6) AS sma FROM bars", "bars")
def _(s, d):
    return B.sma(V.bars(s, d), 10).select("symbol", _ts().alias("ts"), r6("sma").alias("sma"))


@query("d3_volatility", f"WITH r AS (SELECT symbol, bar_ts, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY bar_ts)) AS x FROM bars) SELECT symbol, epoch(bar_ts)::bigint AS ts, round(CASE WHEN count(x) OVER {_ROWS(20)} >= 20 THEN stddev_samp(x) OVER {_ROWS(20)} END, 6) AS volatility FROM r", "bars")
def _(s, d):
    return B.volatility(V.bars(s, d), 20).select("symbol", _ts().alias("ts"), r6("volatility").alias("volatility"))


@query("d4_ema", "SELECT symbol, round(list_reduce(list(close ORDER BY bar_ts), lambda a, y: a + (y - a) * 2 / 13), 6) AS ema FROM bars GROUP BY 1", "bars")
def _(s, d):
    return B.ema_columns(V.bars(s, d), {"ema": 12}).groupBy("symbol").agg(r6(F.max_by("ema", F.col("bar_ts"))).alias("ema"))


@query("d4_macd", "SELECT symbol, round(list_reduce(list(close ORDER BY bar_ts), lambda a, y: a + (y - a) * 2 / 13) - list_reduce(list(close ORDER BY bar_ts), lambda a, y: a + (y - a) * 2 / 27), 6) AS macd FROM bars GROUP BY 1", "bars")
def _(s, d):
    return B.macd(V.bars(s, d)).groupBy("symbol").agg(r6(F.max_by("macd", F.col("bar_ts"))).alias("macd"))


@query("d4_macd_signal", "RECURSIVE WITH r AS (SELECT symbol, bar_ts, close AS x, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) AS k FROM bars), e AS (SELECT symbol, bar_ts, k, x AS f, x AS s, cast(0 AS double) AS g FROM r WHERE k = 1 UNION ALL SELECT r.symbol, r.bar_ts, r.k, f + (x - f) * 2 / 13, s + (x - s) * 2 / 27, g + ((f + (x - f) * 2 / 13) - (s + (x - s) * 2 / 27) - g) * 2 / 10 FROM e JOIN r ON r.symbol = e.symbol AND r.k = e.k + 1) SELECT symbol, epoch(bar_ts)::bigint AS ts, round(f - s, 6) AS macd, round(g, 6) AS signal, round(f - s - g, 6) AS histogram FROM e", "bars")
def _(s, d):
    return B.macd(V.bars(s, d)).select("symbol", _ts().alias("ts"), *(r6(c).alias(c) for c in ("macd", "signal", "histogram")))


@query("d5_rsi", f"WITH c AS (SELECT symbol, bar_ts, close - lag(close) OVER (PARTITION BY symbol ORDER BY bar_ts) AS d FROM bars), g AS (SELECT symbol, bar_ts, count(d) OVER {_ROWS(14)} AS n, avg(greatest(d, 0.0)) OVER {_ROWS(14)} AS gain, avg(greatest(-d, 0.0)) OVER {_ROWS(14)} AS loss FROM c) SELECT symbol, epoch(bar_ts)::bigint AS ts, round(CASE WHEN n >= 14 THEN CASE WHEN loss = 0 THEN 100.0 ELSE 100 - 100 / (1 + gain / loss) END END, 6) AS rsi FROM g", "bars")
def _(s, d):
    rows = B.rsi(V.bars(s, d))
    return rows.select("symbol", _ts().alias("ts"), r6("rsi").alias("rsi"))


@query("d6_bollinger", f"SELECT symbol, epoch(bar_ts)::bigint AS ts, round(CASE WHEN count(*) OVER {_ROWS(20)} >= 20 THEN avg(close) OVER {_ROWS(20)} + 2 * stddev_pop(close) OVER {_ROWS(20)} END, 6) AS upper, round(CASE WHEN count(*) OVER {_ROWS(20)} >= 20 THEN avg(close) OVER {_ROWS(20)} - 2 * stddev_pop(close) OVER {_ROWS(20)} END, 6) AS lower FROM bars", "bars")
def _(s, d):
    return B.bollinger(V.bars(s, d)).select("symbol", _ts().alias("ts"), r6("upper").alias("upper"), r6("lower").alias("lower"))


@query("d7_vwap", "SELECT symbol, cast(cast(bar_ts AS date) AS varchar) AS date, round(sum(close * volume) / sum(volume), 6) AS vwap, cast(sum(volume) AS bigint) AS volume FROM bars GROUP BY 1, 2", "bars")
def _(s, d):
    return B.vwap(V.bars(s, d)).select("symbol", F.col("date").cast("string").alias("date"), r6("vwap").alias("vwap"), "volume")


@query("d7_volume_profile", "SELECT symbol, bin, cast(sum(volume) AS bigint) AS volume FROM (SELECT symbol, volume, CASE WHEN close < 0 THEN 0 WHEN close >= 200 THEN 11 ELSE cast(floor(close / 20) AS bigint) + 1 END AS bin FROM bars) GROUP BY 1, 2", "bars")
def _(s, d):
    return B.volume_profile(V.bars(s, d), 10, 0.0, 200.0)


@query("d8_minmax", f"SELECT symbol, epoch(bar_ts)::bigint AS ts, round(CASE WHEN max(close) OVER {_ROWS(10)} > min(close) OVER {_ROWS(10)} THEN (close - min(close) OVER {_ROWS(10)}) / (max(close) OVER {_ROWS(10)} - min(close) OVER {_ROWS(10)}) END, 6) AS minmax FROM bars", "bars")
def _(s, d):
    return B.minmax(V.bars(s, d), 10).select("symbol", _ts().alias("ts"), r6("minmax").alias("minmax"))


@query("d8_zscore", f"SELECT symbol, epoch(bar_ts)::bigint AS ts, round(CASE WHEN count(*) OVER {_ROWS(10)} >= 10 AND stddev_samp(close) OVER {_ROWS(10)} > 0 THEN (close - avg(close) OVER {_ROWS(10)}) / stddev_samp(close) OVER {_ROWS(10)} END, 6) AS zscore FROM bars", "bars")
def _(s, d):
    return B.zscore(V.bars(s, d), 10).select("symbol", _ts().alias("ts"), r6("zscore").alias("zscore"))


@query("d9_outliers", f"SELECT symbol, epoch(bar_ts)::bigint AS ts FROM (SELECT symbol, bar_ts, close, count(*) OVER {_PREV(20)} AS n, avg(close) OVER {_PREV(20)} AS m, stddev_samp(close) OVER {_PREV(20)} AS sd FROM bars) WHERE n >= 20 AND abs((close - m) / nullif(sd, 0)) > 2", "bars")
def _(s, d):
    return B.outliers(V.bars(s, d), 20, 2.0).where("outlier").select("symbol", _ts().alias("ts"))


@query("d9_spikes", f"SELECT symbol, epoch(bar_ts)::bigint AS ts FROM (SELECT symbol, bar_ts, volume, count(*) OVER {_PREV(20)} AS n, avg(volume) OVER {_PREV(20)} AS m FROM bars) WHERE n >= 20 AND volume > 2 * m", "bars")
def _(s, d):
    return B.spikes(V.bars(s, d), 20).where("spike").select("symbol", _ts().alias("ts"))


@query("d10_filled_calendar", "SELECT symbol, count(*) AS n, cast(sum(m) AS bigint) AS absent FROM (SELECT symbol, 0 AS m FROM bars UNION ALL SELECT symbol, 1 FROM (SELECT symbol, unnest(range(1, (epoch(bar_ts) - epoch(a))::bigint // 3600)) FROM (SELECT symbol, bar_ts, lag(bar_ts) OVER (PARTITION BY symbol ORDER BY bar_ts) AS a FROM bars) WHERE epoch(bar_ts) - epoch(a) > 3600)) GROUP BY 1", "bars")
def _(s, d):
    return B.filled_calendar(V.bars(s, d)).groupBy("symbol").agg(F.count("*").alias("n"), F.count_if("absent").alias("absent"))


@query("d10_gaps", "SELECT symbol, epoch(a)::bigint AS gap_from, epoch(bar_ts)::bigint AS gap_to, (epoch(bar_ts) - epoch(a))::bigint // 3600 - 1 AS missing FROM (SELECT symbol, bar_ts, lag(bar_ts) OVER (PARTITION BY symbol ORDER BY bar_ts) AS a FROM bars) WHERE epoch(bar_ts) - epoch(a) > 3600", "bars")
def _(s, d):
    g = B.gaps(V.bars(s, d))
    return g.select("symbol", *(F.unix_timestamp(F.col(c).cast("timestamp")).alias(c) for c in ("gap_from", "gap_to")), "missing")


@query("d38_regime", f"WITH r AS (SELECT symbol, bar_ts, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY bar_ts)) AS x FROM bars), v AS (SELECT symbol, bar_ts, CASE WHEN count(x) OVER {_ROWS(20)} >= 20 THEN stddev_samp(x) OVER {_ROWS(20)} END AS v FROM r), m AS (SELECT symbol, v, quantile_cont(v, 0.5) OVER {_PREV(100)} AS med FROM v) SELECT symbol, CASE WHEN v IS NULL OR med IS NULL THEN NULL WHEN v > med THEN 'high' ELSE 'low' END AS regime, count(*) AS n FROM m GROUP BY 1, 2", "bars")
def _(s, d):
    return B.regime(V.bars(s, d)).groupBy("symbol", "regime").agg(F.count("*").alias("n"))


# signals


@query("d11_relevance_score", f"WITH tok AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '{WORD}'), lambda w: w <> '')) AS w FROM documents), r AS (SELECT doc_id, least(1.0, 10.0::double * count(*) FILTER (w IN ('the','and','der','la')) / count(*)) AS r FROM tok GROUP BY 1) SELECT doc_id, round(coalesce(r, 0.0), 6) AS relevance FROM documents LEFT JOIN r USING (doc_id)")
def _(s, d):
    return G.term_share(s.read.parquet(f"{d}/documents.parquet"), V.words_table(s, V.WATCHLIST), "doc_id", F.col("text")).select("doc_id", r6("relevance").alias("relevance"))


@query("d12_calibrate", f"WITH {_SCORED} SELECT id, round(greatest(-1.0, least(1.0, sentiment_score * coalesce(scale, 1.0) + coalesce(bias, 0.0))), 6) AS calibrated FROM scored LEFT JOIN calibration USING (subreddit)", "posts lexicon calibration")
def _(s, d):
    return G.calibrate(scored(s, d), V.calibration(s)).select("id", r6("calibrated").alias("calibrated"))


@query("d13_confidence_factors", "SELECT id, round(greatest(0.0, least(1.0, score / 5.0::double)) * greatest(0.0, least(1.0, num_comments / 3.0::double)) * CASE WHEN upvote_ratio >= 0.6 THEN 1.0 ELSE upvote_ratio / 0.6 END, 6) AS factor FROM posts", "posts")
def _(s, d):
    return V.posts(s, d).select("id", r6(S.confidence_factors(F.col("score"), F.col("num_comments"), F.col("upvote_ratio"))).alias("factor"))


@query("d14_quality_score", "SELECT doc_id, round(greatest(0.0, least(1.0, greatest(0.0, least(1.0, (length(text) - 50) / 450.0::double)) + CASE WHEN regexp_matches(text, 'https?://') THEN 0.05 ELSE 0 END)), 6) AS quality FROM documents")
def _(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", r6(G.quality_score(F.col("text"))).alias("quality"))


@query("d14_quality_with_emoji", "WITH t AS (SELECT doc_id, text || repeat('\U0001f600', cast(doc_id % 7 AS int)) AS text FROM documents) SELECT doc_id, round(greatest(0.0, least(1.0, greatest(0.0, least(1.0, (length(text) - 50) / 450.0::double)) - CASE WHEN len(regexp_extract_all(text, '[\\x{1F300}-\\x{1FAFF}\\x{2600}-\\x{27BF}]')) > 3 THEN 0.1 ELSE 0 END + CASE WHEN regexp_matches(text, 'https?://') THEN 0.05 ELSE 0 END)), 6) AS quality FROM t")
def _(s, d):
    text = F.concat("text", F.repeat(F.lit("\U0001f600"), (F.col("doc_id") % 7).cast("int")))
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", r6(G.quality_score(text)).alias("quality"))


@query("d15_meme_adjust", f"WITH {lex_sql('lexicon')}, {lex_sql('meme', 'm')} SELECT lex.id, round(CASE WHEN mlex.neu < 1 THEN 0.7 * lex.compound + 0.3 * mlex.compound ELSE lex.compound END, 6) AS compound FROM lex JOIN mlex USING (id)", "posts lexicon meme")
def _(s, d):
    p = text_of(V.posts(s, d))
    a = O.lexicon_sentiment(p, V.lexicon(s), negations=V.NEGATIONS, boosters=V.BOOSTERS)
    m = O.lexicon_sentiment(p, V.frame(s, V.MEME, "term string, valence double"), negations=V.NEGATIONS, boosters=V.BOOSTERS)
    j = a.alias("a").join(m.alias("m"), "id")
    return j.select("id", r6(G.meme_adjust(F.col("a.compound"), F.col("m.compound"), F.col("m.neu") < 1)).alias("compound"))


@query("d17_exclude_common_words", f"WITH syms AS ({_SYMS}) SELECT id, ticker FROM (SELECT id, unnest(symbols) AS ticker FROM syms) WHERE ticker NOT IN ('THE', 'AND')", "posts")
def _(s, d):
    return G.exclude_common_words(posts_with_symbols(s, d).select("id", F.explode("symbols").alias("ticker")), V.words_table(s, ("THE", "AND"))).select("id", "ticker")


_AGE = f"(({NOW_S} - ts) / 3600.0::double)"


@query("d18_decayed_sentiment", f"WITH {_FACTS} SELECT ticker, round(sum(score * exp(-0.05 * {_AGE})) / sum(exp(-0.05 * {_AGE})), 6) AS sentiment, count(*) AS n FROM facts WHERE {_AGE} BETWEEN 0 AND 72 GROUP BY 1", "posts lexicon")
def _(s, d):
    return G.decayed_sentiment(ticker_facts(s, d), now()).withColumn("sentiment", r6("sentiment"))


_SRC = "means AS (SELECT ticker, source, avg(score) AS m, CASE source WHEN 'twitter' THEN 0.30 WHEN 'reddit' THEN 0.25 WHEN 'news' THEN 0.40 ELSE 0.05 END::double AS w FROM facts GROUP BY 1, 2)"


@query("d19_source_weighted", f"WITH {_FACTS}, {_SRC} SELECT ticker, round(sum(m * w) / sum(w), 6) AS sentiment, count(*) AS n_sources FROM means GROUP BY 1", "posts lexicon")
def _(s, d):
    return G.source_weighted(ticker_facts(s, d)).withColumn("sentiment", r6("sentiment"))


@query("d20_data_point_confidence", f"WITH {_FACTS} SELECT ticker, date::varchar AS date, round(least(1.0, n / 20.0::double), 6) AS confidence FROM daily", "posts lexicon")
def _(s, d):
    return daily_sentiment(s, d).select("ticker", F.col("date").cast("string").alias("date"), r6(S.data_point_confidence(F.col("n"))).alias("confidence"))


@query("d21_market_sentiment", f"WITH {_FACTS}, dec AS (SELECT ticker, sum(score * exp(-0.05 * {_AGE})) / sum(exp(-0.05 * {_AGE})) AS sentiment, count(*) AS n FROM facts WHERE {_AGE} BETWEEN 0 AND 72 GROUP BY 1 ORDER BY n DESC, ticker LIMIT 20) SELECT round(sum(sentiment * n) / sum(n), 6) AS market_sentiment, count(*) AS n_tickers FROM dec", "posts lexicon")
def _(s, d):
    return G.market_sentiment(G.decayed_sentiment(ticker_facts(s, d), now())).withColumn("market_sentiment", r6("market_sentiment"))


_CHG = "c AS (SELECT *, sentiment - lag(sentiment) OVER (PARTITION BY ticker ORDER BY date) AS velocity FROM daily), c2 AS (SELECT *, velocity - lag(velocity) OVER (PARTITION BY ticker ORDER BY date) AS acceleration, coalesce(sign(velocity) * sign(lag(velocity) OVER (PARTITION BY ticker ORDER BY date)) < 0, false) AS reversal FROM c)"


@query("d22_trend", f"WITH {_FACTS}, {_CHG} SELECT ticker, date::varchar AS date, CASE WHEN velocity >= 0.05 THEN 'up' WHEN velocity <= -0.05 THEN 'down' WHEN velocity IS NOT NULL THEN 'flat' END AS trend, coalesce(abs(velocity) >= 0.15, false) AS shift FROM c2", "posts lexicon")
def _(s, d):
    return G.changes(daily_sentiment(s, d)).select("ticker", F.col("date").cast("string").alias("date"), "trend", "shift")


@query("d23_velocity", f"WITH {_FACTS}, {_CHG} SELECT ticker, date::varchar AS date, round(velocity, 6) AS velocity, round(acceleration, 6) AS acceleration, reversal FROM c2", "posts lexicon")
def _(s, d):
    return G.changes(daily_sentiment(s, d)).select("ticker", F.col("date").cast("string").alias("date"), r6("velocity").alias("velocity"), r6("acceleration").alias("acceleration"), "reversal")


@query("d24_extremes", f"WITH {_FACTS}, e AS (SELECT ticker, date, sentiment, count(*) OVER w AS k, avg(sentiment) OVER w AS m, stddev_samp(sentiment) OVER w AS sd FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) SELECT ticker, date::varchar AS date, CASE WHEN k >= 20 AND (sentiment - m) / nullif(sd, 0) > 2 THEN 'euphoria' WHEN k >= 20 AND (sentiment - m) / nullif(sd, 0) < -2 THEN 'panic' ELSE 'none' END AS extreme FROM e", "posts lexicon")
def _(s, d):
    return G.extremes(daily_sentiment(s, d)).select("ticker", F.col("date").cast("string").alias("date"), "extreme")


@query("d25_consistency", f"WITH {_FACTS}, {_SRC} SELECT ticker, round(1 - least(1.0, stddev_pop(m)), 6) AS consistency FROM means GROUP BY 1", "posts lexicon")
def _(s, d):
    return G.consistency(ticker_facts(s, d)).withColumn("consistency", r6("consistency"))


@query("d26_volume_normalised", f"WITH {_FACTS} SELECT ticker, date::varchar AS date, round(n / avg(n) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS relative FROM daily", "posts lexicon")
def _(s, d):
    return G.volume_normalised(daily_sentiment(s, d)).select("ticker", F.col("date").cast("string").alias("date"), r6("relative").alias("relative"))


@query("d27_news_timeseries", f"WITH {_FACTS} SELECT ticker AS symbol, ts - ts % 86400 AS start, round(avg(score), 6) AS sentiment_score, round(avg(abs(score)), 6) AS sentiment_magnitude, count(*) AS article_count, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources, array_to_string(list_sort(list(id)), ',') AS article_ids FROM facts GROUP BY 1, 2", "posts lexicon")
def _(s, d):
    rows = ticker_facts(s, d).select(F.col("ticker").alias("symbol"), F.timestamp_seconds("ts").alias("ts"), "score", F.abs("score").alias("magnitude"), "source", F.col("id").alias("article_id"))
    return G.news_timeseries(rows).select("symbol", F.unix_timestamp("start").alias("start"), r6("sentiment_score").alias("sentiment_score"), r6("sentiment_magnitude").alias("sentiment_magnitude"), "article_count", F.array_join("sources", ",").alias("sources"), F.array_join(F.col("article_ids").cast("array<string>"), ",").alias("article_ids"))


@query("d28_news_document_check", "SELECT url, array_to_string(list_filter([CASE WHEN doc_id % 11 = 0 THEN 'Schema error: Field ''article_id'': required' END, CASE WHEN doc_id % 13 = 0 THEN 'Schema error: Field ''source_name'': required' END, 'Schema error: Field ''sentiment.magnitude'': type', CASE WHEN doc_id % 7 = 0 THEN 'Schema error: Field ''relevance_score'': range' END, CASE WHEN doc_id % 5 = 0 THEN 'Schema error: Field ''sentiment.label'': enum' END], lambda x: x IS NOT NULL), '|') AS errors FROM news", "news")
def _(s, d):
    docs = V.news(s, d).select("url", "title", F.when(F.col("doc_id") % 11 != 0, F.col("url")).alias("article_id"), F.timestamp_seconds("published_utc").alias("published_at"), now().alias("collection_timestamp"), F.when(F.col("doc_id") % 13 != 0, F.col("source")).alias("source_name"), F.when(F.col("doc_id") % 7 == 0, 1.5).otherwise(0.5).alias("relevance_score"), F.struct(F.when(F.col("doc_id") % 5 == 0, "odd").otherwise("mixed").alias("label"), F.lit("strong").alias("magnitude")).alias("sentiment"))
    return P.check_news_documents(docs).select("url", F.array_join("errors", "|").alias("errors"))


@query("d28_news_payload_types", "SELECT url, array_to_string(list_filter([CASE WHEN doc_id % 11 = 0 THEN 'Schema error: Field ''article_id'': required' END, CASE WHEN doc_id % 3 = 0 THEN 'Schema error: Field ''title'': type' END, CASE WHEN doc_id % 5 = 0 THEN 'Schema error: Field ''published_at'': type' END, CASE WHEN doc_id % 7 = 0 THEN 'Schema error: Field ''symbols'': type' END, CASE WHEN doc_id % 4 = 0 THEN 'Schema error: Field ''relevance_score'': range' END, CASE WHEN doc_id % 13 = 0 THEN 'Schema error: Field ''sentiment.label'': enum' END], lambda x: x IS NOT NULL), '|') AS errors FROM news", "news")
def _(s, d):
    every = lambda k: F.col("doc_id") % k == 0
    texts = {"article_id": F.when(~every(11), F.col("url")), "url": F.col("url"), "source_name": F.col("source"), "published_at": F.when(every(5), "yesterday").otherwise(P.iso(F.timestamp_seconds("published_utc"))), "collection_timestamp": P.iso(now())}
    plain = F.struct(*(v.alias(k) for k, v in texts.items()), F.when(every(4), 1.5).otherwise(0.5).alias("relevance_score"), F.when(~every(7), F.array("lang")).alias("symbols"), F.struct(F.when(every(13), "odd").otherwise("mixed").alias("label")).alias("sentiment"))
    value = F.regexp_replace(F.to_json(plain), r"^\{", F.concat(F.lit("{"), F.when(every(3), F.lit('"title":["x"],')).otherwise(F.lit('"title":"x",')), F.when(every(7), F.lit('"symbols":"x",')).otherwise(F.lit(""))))
    return P.check_news_payloads(V.news(s, d).select("url", F.parse_json(value).alias("payload"))).select("url", F.array_join("errors", "|").alias("errors"))


@query("d29_uniqueness_check", "SELECT md5(text) AS h, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def _(s, d):
    return G.duplicates(s.read.parquet(f"{d}/documents.parquet").select(F.md5("text").alias("h")), "h")


_HITS = lambda c, *terms: f"len(list_filter(string_split_regex(lower({c}), '{WORD}'), lambda w: w IN ({_in(terms or ('the', 'der'))})))"


@query("d30_news_search", f"SELECT url, cast(10 * {_HITS('title')} + 5 * {_HITS('description')} + {_HITS('content')} AS bigint) AS relevance FROM news ORDER BY relevance DESC, url LIMIT 10", "news")
def _(s, d):
    return G.news_search(V.news(s, d), ["the", "der"]).select("url", "relevance")


@query("d30_news_index", f"SELECT q, url, relevance FROM (SELECT q, url, relevance, row_number() OVER (PARTITION BY q ORDER BY relevance DESC, url) AS k FROM (SELECT 1 AS q, url, cast(10 * {_HITS('title')} + 5 * {_HITS('description')} + {_HITS('content')} AS bigint) AS relevance FROM news UNION ALL SELECT 2, url, cast(10 * {_HITS('title', 'und')} + 5 * {_HITS('description', 'und')} + {_HITS('content', 'und')} AS bigint) FROM news) WHERE relevance > 0) WHERE k <= 10", "news")
def _(s, d):
    path = f"{scratch(s)}/index"
    I.write_index(V.news(s, d), path)
    found = (I.search_index(s, path, terms).select(F.lit(q).alias("q"), F.col("id").alias("url"), "relevance") for q, terms in ((1, ["the", "DER"]), (2, ["und"])))
    return T.union_topics(*found)


@query("d31_articles_by_symbol", f"WITH syms AS ({_SYMS}) SELECT id, created_utc FROM syms WHERE list_contains(symbols, 'THE') AND {NOW_S} - created_utc BETWEEN 0 AND 20 * 86400 ORDER BY created_utc DESC, id LIMIT 25", "posts")
def _(s, d):
    n = posts_with_symbols(s, d).select("id", "created_utc", "symbols", F.col("created_utc").alias("published_utc"), F.lpad(F.col("id").cast("string"), 12, "0").alias("url"))
    return G.articles_by_symbol(n, "THE", now(), 20, 25).select("id", "created_utc")


@query("d32_recent_ticker_sentiment", f"WITH {_FACTS} SELECT ticker, id FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts DESC, id) AS k FROM facts) WHERE k <= 5", "posts lexicon")
def _(s, d):
    return G.recent_ticker_sentiment(ticker_facts(s, d), 5).select("ticker", "id")


@query("d32_sentiment_by", f"WITH {_SCORED} SELECT subreddit, epoch(date_trunc('week', make_timestamp(created_utc * 1000000)))::bigint AS start, round(avg(sentiment_score), 6) AS mean_sentiment, round(stddev_pop(sentiment_score), 6) AS deviation, count(*) AS n FROM scored GROUP BY 1, 2", "posts lexicon")
def _(s, d):
    r = G.sentiment_by(scored(s, d), "subreddit", "week")
    return r.select("subreddit", F.unix_timestamp("start").alias("start"), r6("mean_sentiment").alias("mean_sentiment"), r6("deviation").alias("deviation"), "n")


@query("d32_strong_signals", f"WITH {_FACTS} SELECT ticker, id FROM facts WHERE abs(score) >= 0.4 AND confidence >= 0.8", "posts lexicon")
def _(s, d):
    return G.strong_signals(ticker_facts(s, d)).select("ticker", "id")


def symbol_posts(s, d):
    """Scores placed on the bars' symbols."""
    names = F.array(*map(F.lit, ("click", "error", "purchase", "signup", "view")))
    return scored(s, d).select(F.get(names, (F.col("id") % 5).cast("int")).alias("symbol"), F.timestamp_seconds("created_utc").cast("timestamp_ntz").alias("ts"), "id", F.col("sentiment_score").alias("score"))


_SP = "sp AS (SELECT (['click','error','purchase','signup','view'])[(id % 5)::int + 1] AS symbol, make_timestamp(created_utc * 1000000) AS ts, id, sentiment_score AS score FROM scored)"


@query("d33_asof_price", f"WITH {_SCORED}, {_SP} SELECT sp.id, round(b.close, 6) AS price, epoch(b.bar_ts)::bigint AS price_ts FROM sp ASOF LEFT JOIN bars b ON sp.symbol = b.symbol AND sp.ts >= b.bar_ts", "posts lexicon bars")
def _(s, d):
    return G.asof_price(symbol_posts(s, d), V.bars(s, d)).select("id", r6("price").alias("price"), F.unix_timestamp(F.col("price_ts").cast("timestamp")).alias("price_ts"))


def hourly_returns(s, d):
    rows = B.log_returns(V.bars(s, d)).withColumnRenamed("log_return", "ret").where("ret is not null")
    return rows.select("symbol", "bar_ts", F.floor(F.unix_timestamp(F.col("bar_ts").cast("timestamp")) / 3600).alias("hour"), "ret")


_RET = "ret AS (SELECT * FROM (SELECT symbol, bar_ts, epoch(bar_ts)::bigint // 3600 AS hour, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY bar_ts)) AS ret FROM bars) WHERE ret IS NOT NULL)"


@query("d34_lead_lag_corr", f"WITH {_SCORED}, {_SP}, {_RET} SELECT cast(k AS bigint) AS lag, round(corr(score, ret), 6) AS correlation, count(*) AS n FROM (SELECT symbol, epoch(ts)::bigint // 3600 AS h, score, unnest([1, 2, 3]) AS k FROM sp) q JOIN ret ON ret.symbol = q.symbol AND ret.hour = h + k GROUP BY 1", "posts lexicon bars")
def _(s, d):
    sent = symbol_posts(s, d).select("symbol", F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600).alias("hour"), "score")
    return G.lead_lag_corr(sent, hourly_returns(s, d).drop("bar_ts"), [1, 2, 3]).select(F.col("lag").cast("long").alias("lag"), r6("correlation").alias("correlation"), "n")


@query("d35_fuse", f"WITH {_SCORED} SELECT id, round((CASE WHEN p IS NOT NULL THEN 0.6 * p ELSE 0 END + 0.4 * q) / (CASE WHEN p IS NOT NULL THEN 0.6 ELSE 0 END + 0.4), 6) AS signal, coalesce(sign(p) <> sign(q) AND abs(p) >= 0.1 AND abs(q) >= 0.1, false) AS conflict FROM (SELECT id, CASE WHEN id % 4 <> 0 THEN (id % 21 - 10) / 10.0::double END AS p, sentiment_score AS q FROM scored)", "posts lexicon")
def _(s, d):
    p = F.when(F.col("id") % 4 != 0, (F.col("id") % 21 - 10) / F.lit(10.0))
    return scored(s, d).select("id", S.fuse(p, F.col("sentiment_score")).alias("f")).select("id", r6("f.signal").alias("signal"), "f.conflict")


def outcomes(s, d):
    """Each bar's direction, predicted by the one before."""
    r = hourly_returns(s, d)
    way = F.when(F.col("ret") > 0, "up").otherwise("down")
    return B.lagged(r.select("symbol", "bar_ts", way.alias("actual")), "actual", "predicted").where("predicted is not null")


_OUTC = f"{_RET}, way AS (SELECT symbol, bar_ts, CASE WHEN ret > 0 THEN 'up' ELSE 'down' END AS actual FROM ret), outc AS (SELECT * FROM (SELECT *, lag(actual) OVER (PARTITION BY symbol ORDER BY bar_ts) AS predicted FROM way) WHERE predicted IS NOT NULL)"


@query("d36_accuracy", f"WITH {_OUTC} SELECT symbol, round(avg((predicted = actual)::int), 6) AS accuracy, round(count(*) FILTER (predicted = 'up' AND actual = 'up') / count(*) FILTER (predicted = 'up'), 6) AS precision, round(count(*) FILTER (predicted = 'up' AND actual = 'up') / count(*) FILTER (actual = 'up'), 6) AS recall, count(*) AS n FROM outc GROUP BY 1", "bars")
def _(s, d):
    return G.accuracy(outcomes(s, d), "symbol").select("symbol", r6("accuracy").alias("accuracy"), r6("precision").alias("precision"), r6("recall").alias("recall"), "n")


@query("d37_dynamic_weights", f"WITH {_OUTC}, acc AS (SELECT symbol AS source, cast(bar_ts AS date) AS period, avg((predicted = actual)::int) AS accuracy FROM outc GROUP BY 1, 2), w AS (SELECT *, greatest(coalesce(avg(accuracy) OVER (PARTITION BY source ORDER BY period ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 0.05), 0.05) AS raw FROM acc) SELECT source, period::varchar AS period, round(raw / sum(raw) OVER (PARTITION BY period), 6) AS weight FROM w", "bars")
def _(s, d):
    a = G.accuracy(outcomes(s, d).withColumn("period", F.to_date("bar_ts")).withColumnRenamed("symbol", "source"), "source", "period")
    return G.dynamic_weights(a.select("source", "period", "accuracy")).select("source", F.col("period").cast("string").alias("period"), r6("weight").alias("weight"))


@query("d39_drift", "WITH a AS (SELECT close FROM bars WHERE symbol = 'view'), b AS (SELECT close FROM bars WHERE symbol = 'click'), e AS (SELECT quantile_cont(close, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM a), x AS (SELECT len(list_filter(edges, lambda q: q < close)) AS bin, 1 AS na, 0 AS nb FROM a, e UNION ALL SELECT len(list_filter(edges, lambda q: q < close)), 0, 1 FROM b, e), c AS (SELECT bin, sum(na) AS na, sum(nb) AS nb FROM x GROUP BY 1), p AS (SELECT greatest(na / sum(na) OVER (), 1e-6) AS pa, greatest(nb / sum(nb) OVER (), 1e-6) AS pb FROM c) SELECT round(sum((pa - pb) * ln(pa / pb)), 6) AS psi FROM p", "bars")
def _(s, d):
    b = V.bars(s, d)
    return G.drift(b.where("symbol = 'view'"), b.where("symbol = 'click'"), "close").select(r6("psi").alias("psi"))


@query("d40_near_duplicates", r"WITH k AS (SELECT doc_id, md5(trim(regexp_replace(lower(text), '[ \t\n]+', ' ', 'g'))) AS h FROM documents), g AS (SELECT h, min(doc_id) AS group_id, count(*) AS n FROM k GROUP BY 1 HAVING count(*) > 1) SELECT doc_id, group_id, n FROM k JOIN g USING (h)")
def _(s, d):
    return G.normalised_copies(s.read.parquet(f"{d}/documents.parquet"), "doc_id", F.col("text"))


@query("d39_sketched_quantiles", "WITH b AS (SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY close) / count(*) OVER (PARTITION BY symbol)::double AS r FROM bars), n AS (SELECT symbol, count(*) AS n, count(DISTINCT cast(bar_ts AS date)) AS n_days FROM bars GROUP BY 1) SELECT n.symbol, cast(k AS bigint) AS k, n, n_days, true AS near FROM n, (SELECT unnest(range(1, 10)) AS k) WHERE EXISTS (SELECT 1 FROM b WHERE b.symbol = n.symbol)", "bars")
def _(s, d):
    # deciles from sketches kept by day and merged: the share of rows up to each is right to a hundredth
    bars = V.bars(s, d).select("symbol", "bar_ts", "close")
    daily = G.daily_sketches(bars, "close", "bar_ts", "symbol")
    days = daily.groupBy("symbol").agg(F.count("*").alias("n_days"))
    edges = G.merged(daily, "symbol").select("symbol", F.kll_sketch_get_n_double("sketch").alias("n"), F.posexplode(G.quantiles(F.col("sketch"))).alias("k", "edge"))
    upto = edges.join(bars.select("symbol", "close"), "symbol").groupBy("symbol", "k", "n").agg(F.avg((F.col("close") <= F.col("edge")).cast("double")).alias("upto"), F.avg((F.col("close") < F.col("edge")).cast("double")).alias("below"))
    share = (F.col("k") + 1) / 10
    return upto.join(days, "symbol").select("symbol", (F.col("k") + 1).cast("long").alias("k"), "n", "n_days", ((F.col("upto") >= share - 0.01) & (F.col("below") <= share + 0.01)).alias("near"))


@query("d39_sketched_drift", f"WITH d AS ({ORACLE_SQL['d39_drift'].replace('round(sum((pa - pb) * ln(pa / pb)), 6) AS psi', 'sum((pa - pb) * ln(pa / pb)) AS psi')}) SELECT psi >= 0 AS found, true AS near FROM d")
def _(s, d):
    b = V.bars(s, d)
    view, click = b.where("symbol = 'view'"), b.where("symbol = 'click'")
    sketched = G.sketched_drift(*(G.daily_sketches(x, "close", "bar_ts") for x in (view, click))).select(F.col("psi").alias("s"))
    return sketched.crossJoin(G.drift(view, click, "close")).select((F.col("s") >= 0).alias("found"), (F.abs(F.col("s") - F.col("psi")) <= 0.05).alias("near"))


_SHINGLES = f"""RECURSIVE words AS (SELECT doc_id, coalesce(list_filter(string_split_regex(lower(text), '{WORD}'), lambda w: w <> ''), []) AS ws FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM words WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
near AS (SELECT a, b FROM met JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE k >= 0.8 * (p.n + q.n - k) - 1e-9 UNION ALL SELECT min(doc_id) OVER (), doc_id FROM words WHERE len(ws) = 0),
links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reached AS (SELECT a AS doc_id, a AS r FROM links UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.r),
groups AS (SELECT doc_id, min(r) AS group_id FROM reached GROUP BY 1)"""


@query("d40_near_copies", f"WITH {_SHINGLES} SELECT doc_id, group_id, n_group FROM groups JOIN (SELECT group_id, count(*) AS n_group FROM groups GROUP BY 1) USING (group_id) WHERE n_group > 1")
def _(s, d):
    return C.near_copies(s.read.parquet(f"{d}/documents.parquet"), "doc_id", F.col("text"))


@query("d41_corr_matrix", f"WITH {_RET} SELECT x.symbol AS symbol_a, y.symbol AS symbol_b, round(corr(x.ret, y.ret), 6) AS correlation, count(*) AS n FROM ret x JOIN ret y ON x.bar_ts = y.bar_ts AND x.symbol < y.symbol GROUP BY 1, 2", "bars")
def _(s, d):
    return G.corr_matrix(hourly_returns(s, d)).withColumn("correlation", r6("correlation"))


@query("d41_gram", f"WITH {_RET}, many AS (SELECT symbol || '/' || (hour // 24) % 40 AS symbol, hour % 24 AS at, avg(ret) AS ret FROM ret GROUP BY 1, 2) SELECT x.symbol AS symbol_a, y.symbol AS symbol_b, round(corr(x.ret, y.ret), 5) AS correlation, count(*) AS n FROM many x JOIN many y ON x.at = y.at AND x.symbol < y.symbol GROUP BY 1, 2 HAVING count(*) >= 5", "bars")
def _(s, d):
    # a symbol and a day are a symbol of their own here, so that there are many
    r = hourly_returns(s, d).select(F.concat("symbol", F.lit("/"), F.expr("(hour div 24) % 40").cast("string")).alias("symbol"), F.timestamp_seconds(F.col("hour") % 24).alias("bar_ts"), "ret")
    many = r.groupBy("symbol", "bar_ts").agg(F.avg("ret").alias("ret"))
    return K.gram_correlations(many, width=32, stripes=4).where("n >= 5").withColumn("correlation", F.round("correlation", 5))


@query("d42_faceted_counts", f"WITH {_FACTS} SELECT facet, value, count(*) AS n FROM (SELECT 'ticker' AS facet, ticker AS value FROM facts UNION ALL SELECT 'sentiment_label', sentiment_label FROM facts UNION ALL SELECT 'source', source FROM facts) GROUP BY 1, 2", "posts lexicon")
def _(s, d):
    return G.faceted_counts(ticker_facts(s, d), "ticker", "sentiment_label", "source")


# SQL functions


@query("u1_register_functions", f"WITH {_SCORED} SELECT id, round((0.3 * compound + 0.7 * 0.5) * least(1.0, 0.5 + score / 1000.0::double) * upvote_ratio, 6) AS w FROM scored", "posts lexicon")
def _(s, d):
    register_functions(s)
    return scored(s, d).select("id", r6(F.expr("weighted_sentiment_udf(compound, 0.5D, cast(score as double), upvote_ratio)")).alias("w"))


_LOWERED = r"lower(regexp_replace(regexp_replace(regexp_replace(" + _TEXT + r", 'https?://\S+', '', 'g'), '<[^>]+>', '', 'g'), '@[\p{L}\p{M}\p{N}_]+', '', 'g'))"


@query("u1_five_functions", f"WITH {lex_sql('lexicon')}, p AS (SELECT *, (length({_TEXT}) % 11) / 10.0::double AS up FROM posts) SELECT p.id, md5({_LOWERED}) AS h, len(regexp_extract_all({_TEXT}, '\\$([A-Z]{{1,5}})', 1))::bigint AS n_tickers, round(compound, 6) AS compound, round(pos, 6) AS pos, round(neg, 6) AS neg, round(neu, 6) AS neu, round(up, 6) AS p_pos, round((1 - up) / 2, 6) AS p_neg, round((0.3 * compound + 0.7 * up) * least(1.0, 0.5 + score / 1000.0::double) * upvote_ratio, 6) AS weighted FROM p JOIN lex USING (id)", "posts lexicon")
def _(s, d):
    def scorer(texts):
        up = texts.str.len() % 11 / 10.0
        return texts.to_frame().assign(p_pos=up, p_neg=(1 - up) / 2, p_neu=(1 - up) / 2)

    register_functions(s, dict(V.LEXICON), scorer, V.NEGATIONS, V.BOOSTERS)
    text_of(V.posts(s, d)).createOrReplaceTempView("u1_posts")
    called = s.sql("SELECT id, score, upvote_ratio, preprocess_udf(title, selftext) AS pre, fast_sentiment_udf(text) AS fast, deep_sentiment_udf(text) AS deep FROM u1_posts")
    rows = called.selectExpr("id", "md5(pre.cleaned_text) AS h", "cast(size(explode_ticker_sentiment_udf(pre.tickers, 'x', 0D, 0D)) AS bigint) AS n_tickers", "fast.*", "deep.p_pos", "deep.p_neg", "weighted_sentiment_udf(fast.compound, deep.p_pos, cast(score AS double), upvote_ratio) AS weighted")
    return rows.select("id", "h", "n_tickers", *(r6(c).alias(c) for c in ("compound", "pos", "neg", "neu", "p_pos", "p_neg", "weighted")))


@query("u2_ticker_table_function", f"WITH {_FACTS} SELECT id, ticker, sentiment_label AS sentiment FROM facts", "posts lexicon")
def _(s, d):
    register_functions(s)
    r = scored(s, d).drop("ticker_sentiments").join(posts_with_symbols(s, d).select("id", "symbols"), "id")
    return r.selectExpr("id", "explode_ticker_sentiment_udf(symbols, sentiment_label, sentiment_score, confidence) AS rows").selectExpr("id", "inline(rows)").select("id", "ticker", "sentiment")


# sources, sinks and streams, through files in the shared folder


@query("d16_drop_special", r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[^\p{L}\p{M}\p{N}_\s\x0B]', '', 'g'), '\p{N}+', '', 'g')) AS h FROM documents")
def _(s, d):
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", F.md5(X.drop_special(F.col("text"), numbers=True)).alias("h"))


@query("x_stamp_and_names", "SELECT symbol AS name, epoch(bar_ts)::bigint AS ts, true AS stamped FROM raw_bars", "raw_bars")
def _(s, d):
    rows = P.normalise_symbol_column(V.raw_bars(s, d).withColumnRenamed("symbol", "Name"))
    rows = P.stamp_processing_time(rows)
    return rows.select("name", F.unix_timestamp(F.col("bar_ts").cast("timestamp")).alias("ts"), F.col("processing_timestamp").isNotNull().alias("stamped"))


@query("s2_read_jsonl", "SELECT count(*) AS n FROM documents WHERE doc_id % 4 = 3")
def _(s, d):
    path = f"{scratch(s)}/lines"
    docs = s.read.parquet(f"{d}/documents.parquet")
    docs.select(F.when(F.col("doc_id") % 4 == 0, "").when(F.col("doc_id") % 4 == 1, "{bad").when(F.col("doc_id") % 4 == 2, "[1]").otherwise(F.to_json(F.struct("doc_id", "lang"))).alias("value")).write.text(path)
    return io.read_jsonl(s, path).agg(F.count("*").alias("n"))


_KINDS = "CASE doc_id % 5 WHEN 0 THEN 'blank' WHEN 1 THEN 'bad' WHEN 2 THEN 'other' ELSE 'read' END"


def mixed_lines(docs):
    """Blank, broken, other and good lines, by the document's id."""
    k = F.col("doc_id") % 5
    return docs.select(F.when(k == 0, " ").when(k == 1, F.concat(F.lit("{bad"), "lang")).when(k == 2, F.to_json(F.array("source"))).otherwise(F.to_json(F.struct("doc_id", "lang"))).alias("value"))


@query("s2_line_counts", f"SELECT 'observed' AS part, k AS kind, (SELECT count(*) FROM documents WHERE {_KINDS} = k) AS n FROM (SELECT unnest(['blank', 'bad', 'other', 'read']) AS k) UNION ALL SELECT 'rows', 'read', count(*) FROM documents WHERE {_KINDS} = 'read'")
def _(s, d):
    path, counts = f"{scratch(s)}/lines", Observation()
    mixed_lines(s.read.parquet(f"{d}/documents.parquet")).write.text(path)
    n = io.read_jsonl(s.newSession(), path, counts).select("value").groupBy().agg(F.count("*").alias("n")).first()["n"]
    return s.createDataFrame([("observed", k, v) for k, v in counts.get.items()] + [("rows", "read", n)], "part string, kind string, n long")


@query("a9_live_counters", f"SELECT cast(batch AS bigint) AS batch, count(*) AS processed, count(*) FILTER (o = 'valid') AS valid, count(*) FILTER (o = 'invalid') AS invalid, count(*) FILTER (o = 'error') AS errors FROM (SELECT id % 3 AS batch, {_OUTCOME} AS o FROM posts) GROUP BY 1", "posts")
def _(s, d):
    base, seen = scratch(s), []
    posts = V.posts(s, d).select("id", F.expr(_OUTCOME).alias("outcome"))
    for k in range(3):  # a run, and so a micro-batch, for each part; the query goes on from its checkpoint
        posts.where(F.col("id") % 3 == k).write.parquet(f"{base}/in/part={k}")
        rows = s.readStream.schema("id long, outcome string, part int").parquet(f"{base}/in").drop("part")
        run = M.start(M.live_counts(rows), io._write_batch(f"{base}/out", None), f"{base}/check")
        run.awaitTermination()
        seen += [(p.batchId, *p.observedMetrics["outcomes"]) for p in run.recentProgress if "outcomes" in p.observedMetrics]
    return s.createDataFrame(seen, "batch long, processed long, valid long, invalid long, errors long").where("processed > 0")


@query("m7_fresh_counts_stream", f"SELECT start, count(*) AS processed, count(*) FILTER (o = 'valid') AS valid, count(*) FILTER (o = 'invalid') AS invalid, count(*) FILTER (o = 'error') AS error FROM (SELECT DISTINCT id, created_utc - created_utc % 21600 AS start, {_OUTCOME} AS o FROM posts WHERE created_utc BETWEEN {NOW_S} - 29 * 86400 AND {NOW_S} + 300) WHERE start + 21600 <= (SELECT max(created_utc) FROM posts WHERE created_utc <= {NOW_S} + 300) - 3600 GROUP BY 1", "posts")
def _(s, d):
    # late and future rows go, each id counts once though all come twice, periods close with the watermark
    base = scratch(s)
    rows = V.posts(s, d).select("id", F.timestamp_seconds("created_utc").alias("ts"), F.expr(_OUTCOME).alias("outcome"))
    rows.unionByName(rows).write.parquet(f"{base}/in")
    stream = s.readStream.schema("id long, ts timestamp, outcome string").parquet(f"{base}/in")
    counted = M.fresh_counts(stream, "id", now(), every="6 hours", late="1 hour", max_age_hours=29 * 24)
    M.start(counted, io._write_batch(f"{base}/out", None), f"{base}/check").awaitTermination()
    return s.read.schema("start timestamp, processed long, valid long, invalid long, error long").parquet(f"{base}/out").select(F.unix_timestamp("start").alias("start"), "processed", "valid", "invalid", "error")


@query("s3_read_reference_set", "SELECT DISTINCT source AS value FROM documents")
def _(s, d):
    path = f"{scratch(s)}/set"
    s.read.parquet(f"{d}/documents.parquet").select(F.concat(F.lit("  "), "source", F.lit(" ")).alias("value")).write.text(path)
    return io.read_reference_set(s, path)


@query("s4_read_store", "SELECT doc_id FROM documents WHERE lang = 'en'")
def _(s, d):
    return io.read_store(s, f"{d}/documents.parquet", F.col("lang") == "en", None).select("doc_id")


@query("s9_processed_ids", "SELECT url FROM news WHERE doc_id % 2 = 1", "news")
def _(s, d):
    path, news = f"{scratch(s)}/seen", V.news(s, d)
    io.save_processed(news.where("doc_id % 4 = 0"), path)
    io.save_processed(news.where("doc_id % 4 = 2"), path)
    return T.unseen(news, io.load_processed(s, path)).select("url")


@query("s8_topics_round_trip", "SELECT topic, count(*) AS n FROM (SELECT CASE WHEN id % 3 = 0 THEN 'invalid' ELSE 'valid' END AS topic FROM posts) GROUP BY 1", "posts")
def _(s, d):
    base = scratch(s)
    posts = V.posts(s, d).select("id", "subreddit", "score").withColumn("topic", F.when(F.col("id") % 3 == 0, "invalid").otherwise("valid"))
    io.write_topics(io.to_messages(posts, "topic", "id"), root=f"{base}/topics")
    rows = io.read_topics(s, ["valid", "invalid"], root=f"{base}/topics")
    io.write_documents(rows, f"{base}/out", f"{base}/check").awaitTermination()
    return s.read.parquet(f"{base}/out").groupBy("topic").agg(F.count("*").alias("n"))


@query("m3_dual_write", "SELECT kind, count(*) AS n FROM (SELECT 'post' AS kind FROM posts UNION ALL SELECT 'strong' FROM posts WHERE score > 2500) GROUP BY 1", "posts")
def _(s, d):
    base = scratch(s)
    V.posts(s, d).select("id", "score").write.parquet(f"{base}/in")
    rows = s.readStream.schema("id long, score long").parquet(f"{base}/in")
    M.dual_write(rows, io._write_batch(f"{base}/posts", None), lambda b, i: io._write_batch(f"{base}/strong", None)(b.where("score > 2500"), i), f"{base}/check").awaitTermination()
    return T.union_topics(*(s.read.parquet(f"{base}/{p}").select(F.lit(k).alias("kind")) for p, k in (("posts", "post"), ("strong", "strong")))).groupBy("kind").agg(F.count("*").alias("n"))


_TAGGED = "replace(coalesce(title,''), ' T', ' $T') || ' ' || replace(coalesce(selftext,''), ' T', ' $T')"


@query("m1_sentiment_job", f"WITH {_SCORED.replace('* upvote_ratio', '* cast(cast(upvote_ratio AS float) AS double)')} SELECT 'post' AS store, cast(id AS varchar) AS id, NULL AS ticker, sentiment_label AS label, round(sentiment_score, 6) AS score FROM scored UNION ALL SELECT 'ticker', cast(id AS varchar), unnest(regexp_extract_all({_TAGGED}, '\\$([A-Z]{{1,5}})', 1)), sentiment_label, round(sentiment_score, 6) FROM scored", "posts lexicon")
def _(s, d):
    base = scratch(s)
    posts = V.posts(s, d).withColumn("created_utc", F.col("created_utc").cast("double"))
    posts = posts.withColumns({c: F.replace(c, F.lit(" T"), F.lit(" $T")) for c in ("title", "selftext")})
    posts.select(F.to_json(F.struct(*posts.columns)).alias("value")).write.text(f"{base}/in")
    terms = O.terms_of(V.lexicon(s))
    score = lambda rows: O.score_posts(rows, terms, negations=V.NEGATIONS, boosters=V.BOOSTERS, text_cfg=PLAIN)
    kept = lambda rows: rows.select("id", F.col("sentiment_label").alias("label"), F.col("sentiment_score").alias("score"), "ticker_sentiments")
    M.sentiment_job(s.readStream.schema("value string").text(f"{base}/in"), lambda rows: kept(score(rows)), io._write_batch(f"{base}/posts", None), io._write_batch(f"{base}/tickers", None), f"{base}/check").awaitTermination()
    stored = s.read.parquet(f"{base}/posts").select(F.lit("post").alias("store"), "id", F.lit(None).cast("string").alias("ticker"), "label", r6("score").alias("score"))
    return stored.unionByName(s.read.schema("id string, ticker string, sentiment string, score double").parquet(f"{base}/tickers").select(F.lit("ticker").alias("store"), "id", "ticker", F.col("sentiment").alias("label"), r6("score").alias("score")))


@query("r1_route_stream", f"{_BARERR} SELECT CASE WHEN len(se) > 0 OR len(be) > 0 THEN 'invalid' ELSE 'valid' END AS topic, count(*) AS n FROM f GROUP BY 1 UNION ALL SELECT 'error', count(*) FROM f WHERE t % 7200 = 0", "raw_bars")
def _(s, d):
    base = scratch(s)
    good = bar_messages(s, d).select("value")
    bad = good.where(F.try_variant_get(F.parse_json("value"), "$.timestamp", "long") % 7200000 == 0).select(F.lit("[1]").alias("value"))
    good.unionByName(bad).write.text(f"{base}/in")
    checked = P.validate_bars(P.classify_payload(s.readStream.schema("value string").text(f"{base}/in")), now()).withColumn("is_error", F.col("kind") == "error")
    topics = ("valid", "invalid", "error")
    routed = T.route(checked, *topics).select("topic", "value")
    M.write_routed(routed, {t: io._write_batch(f"{base}/{t}", None) for t in topics}, f"{base}/check").awaitTermination()
    return T.union_topics(*(s.read.parquet(f"{base}/{t}") for t in topics)).groupBy("topic").agg(F.count("*").alias("n"))


@query("m4_validate_bars_stream", f"{_FOLD} SELECT symbol, epoch(bar_ts)::bigint AS ts, round(last_close, 6) AS last_close, accepted FROM fold", "raw_bars")
def _(s, d):
    base = scratch(s)
    bars = checked_bars(s, d).withColumn("bar_ts", F.col("bar_ts").cast("timestamp"))
    split = F.lit("2024-01-15").cast("timestamp")
    for k, part in enumerate((bars.where(F.col("bar_ts") < split), bars.where(F.col("bar_ts") >= split))):
        part.write.parquet(f"{base}/in/part={k}")
        rows = s.readStream.schema("symbol string, bar_ts timestamp, close double, ok boolean, part int").parquet(f"{base}/in").drop("part")
        M.start(M.validate_bars_stream(rows), io._write_batch(f"{base}/out", None), f"{base}/check").awaitTermination()
    return s.read.parquet(f"{base}/out").select("symbol", F.unix_timestamp("bar_ts").alias("ts"), r6("last_close").alias("last_close"), "accepted")


_SEEN = "raw_bars WHERE symbol <> 'view' OR bar_ts < TIMESTAMP '2024-01-15'"


@query("m4_watched_bars", f"{_FOLD.replace('FROM raw_bars)', f'FROM {_SEEN})')} SELECT symbol, epoch(bar_ts)::bigint AS ts, accepted, false AS absent FROM fold UNION ALL SELECT symbol, newest + 3600 * k, false, true FROM (SELECT symbol, max(epoch(bar_ts)::bigint) AS newest, (SELECT max(epoch(bar_ts)::bigint) FROM {_SEEN}) AS latest FROM {_SEEN} GROUP BY 1), (SELECT unnest(range(1, 13)) AS k) WHERE newest + 3600 * k <= latest - 7200", "raw_bars")
def _(s, d):
    # one symbol falls silent in the middle: its next twelve bars are missed, then it is forgotten
    base, before = scratch(s), s.conf.get(W.STATE_STORE[0])
    bars = checked_bars(s, d).withColumn("bar_ts", F.col("bar_ts").cast("timestamp"))
    bars.where("symbol <> 'view' OR bar_ts < TIMESTAMP '2024-01-15'").write.parquet(f"{base}/in")
    s.conf.set(*W.STATE_STORE)
    try:
        rows = s.readStream.schema("symbol string, bar_ts timestamp, close double, ok boolean").parquet(f"{base}/in")
        M.start(W.watch_bars(rows, 3600, 12 * 3600), io._write_batch(f"{base}/out", None), f"{base}/check").awaitTermination()
    finally:
        s.conf.set(W.STATE_STORE[0], before)
    return s.read.parquet(f"{base}/out").select("symbol", F.unix_timestamp("bar_ts").alias("ts"), "accepted", "absent")


@query("d2_stream_bars", "SELECT symbol, b AS ts, close, volume FROM (SELECT symbol, epoch_us(ts) // 300000000 * 300 AS b, arg_max(price, ts) AS close, count(*) AS volume FROM ticks GROUP BY 1, 2) WHERE b + 300 <= (SELECT epoch_us(max(ts)) / 1e6 - 600 FROM ticks)", "ticks")
def _(s, d):
    base = scratch(s)
    V.ticks(s, d).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{base}/in")
    rows = s.readStream.schema("event_id long, symbol string, ts timestamp, price double").parquet(f"{base}/in")
    io.write_bars(M.stream_bars(rows), f"{base}/out", f"{base}/check").awaitTermination()
    return s.read.parquet(f"{base}/out").select("symbol", F.unix_timestamp("bar_ts").alias("ts"), "close", "volume")


@query("m6_stream_stats", f"SELECT start, processed, valid FROM (SELECT created_utc - created_utc % 86400 AS start, count(*) AS processed, count(*) FILTER (o = 'valid') AS valid FROM (SELECT *, {_OUTCOME} AS o FROM posts) GROUP BY 1) WHERE start + 86400 <= (SELECT max(created_utc) - 120 FROM posts)", "posts")
def _(s, d):
    base = scratch(s)
    V.posts(s, d).select(F.timestamp_seconds("created_utc").alias("ts"), F.expr(_OUTCOME).alias("outcome")).write.parquet(f"{base}/in")
    rows = s.readStream.schema("ts timestamp, outcome string").parquet(f"{base}/in")
    M.start(M.stream_stats(rows, "1 day"), io._write_batch(f"{base}/out", None), f"{base}/check").awaitTermination()
    return s.read.parquet(f"{base}/out").select(F.unix_timestamp("start").alias("start"), "processed", "valid")


@query("m7_drop_late", f"SELECT id FROM posts WHERE created_utc BETWEEN {NOW_S} - 172800 AND {NOW_S} + 300", "posts")
def _(s, d):
    return M.drop_late(V.posts(s, d).withColumn("ts", F.timestamp_seconds("created_utc")), "ts", now()).select("id")


@query("m8_stream_dedup", "SELECT count(DISTINCT md5(text)) AS n FROM documents")
def _(s, d):
    base = scratch(s)
    s.read.parquet(f"{d}/documents.parquet").select(F.md5("text").alias("h"), F.lit(NOW).cast("timestamp").alias("ts")).write.parquet(f"{base}/in")
    rows = s.readStream.schema("h string, ts timestamp").parquet(f"{base}/in")
    M.start(M.stream_dedup(rows, "h"), io._write_batch(f"{base}/out", None), f"{base}/check").awaitTermination()
    return s.read.parquet(f"{base}/out").agg(F.count("*").alias("n"))
