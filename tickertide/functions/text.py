"""Text functions: column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickertide.config import TextConfig

#: What separates words: anything but letters, marks, digits and the underscore, in any script.
NON_WORD = r"[^\p{L}\p{M}\p{N}_]+"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"
_CFG = TextConfig()


def full_text(title: Column, body: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, r"https?://\S+", "")


def strip_html(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", "")


def strip_mentions(c: Column) -> Column:
    return F.regexp_replace(c, r"@[\p{L}\p{M}\p{N}_]+", "")


def clean_text(c: Column, cfg: TextConfig = _CFG) -> Column:
    for on, step in ((cfg.remove_urls, strip_urls), (cfg.remove_html, strip_html), (cfg.remove_mentions, strip_mentions), (cfg.lowercase, F.lower)):
        c = step(c) if on else c
    return c


def cashtags(c: Column, least: int = _CFG.ticker_min, most: int = _CFG.ticker_max) -> Column:
    """All $TICKERs, repeats kept; no right boundary, so $GOOGLE gives GOOGL."""
    return F.regexp_extract_all(c, F.lit(rf"\$([A-Z]{{{least},{most}}})"), F.lit(1))


def words(c: Column) -> Column:
    return F.array_remove(F.split(c, NON_WORD), "")


def bare_tickers(c: Column, least: int = _CFG.ticker_min, most: int = _CFG.ticker_max) -> Column:
    """Whole words of capital letters."""
    return F.filter(F.split(c, NON_WORD), lambda w: w.rlike(rf"^[A-Z]{{{least},{most}}}$"))


def hashtags(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"#([\p{L}\p{N}_]+)"), F.lit(1))


def text_stats(c: Column) -> Column:
    return F.struct(F.length(c).cast("long").alias("length"), F.size(F.filter(F.split(c, r"\s+"), lambda w: w != "")).cast("long").alias("word_count"))


def truncate(c: Column, most: int = _CFG.max_deep_chars) -> Column:
    return F.left(c, F.lit(most))


def join_tickers(c: Column) -> Column:
    return F.array_join(c, ",")


def split_tickers(c: Column) -> Column:
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))


def is_upper(c: Column) -> Column:
    """Cased letters there are, and none of them small."""
    return (F.upper(c) == c) & (F.lower(c) != c)


def count_of(c: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0))


def drop_special(c: Column, numbers: bool = False) -> Column:
    """Without anything but letters, marks, digits, the underscore and white space; without digits as well if numbers go."""
    c = F.regexp_replace(c, r"[^\p{L}\p{M}\p{N}_\s]", "")
    return F.regexp_replace(c, r"\p{N}+", "") if numbers else c


def drop_words(c: Column, stop: list[str]) -> Column:
    return F.filter(words(F.lower(c)), lambda w: ~w.isin(stop))


def preprocess(title: Column, body: Column, subreddit: Column, score: Column, upvote_ratio: Column, num_comments: Column, cfg: TextConfig = _CFG) -> Column:
    text = full_text(title, body)
    return F.struct(
        clean_text(text, cfg).alias("cleaned_text"), cashtags(text, cfg.ticker_min, cfg.ticker_max).alias("tickers"), F.lower(subreddit).alias("subreddit"),
        F.coalesce(score, F.lit(0)).alias("score"), F.coalesce(upvote_ratio, F.lit(0.5)).alias("upvote_ratio"), F.coalesce(num_comments, F.lit(0)).alias("num_comments"),
    )
