"""Validation rules: each is a column that holds an error text, or null if the row passes. The texts of business rules are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickertide.config import RuleConfig
from tickertide.functions.text import is_upper

_CFG = RuleConfig()
col = F.col


def _error(broken: Column, text: str | Column) -> Column:
    return F.when(broken, F.lit(text) if isinstance(text, str) else text)


def field_error(name: str, broken: Column, code: str) -> Column:
    return _error(broken, f"Schema error: Field '{name}': {code}")


def check_symbol(c: Column) -> Column:
    return field_error("symbol", c.isNull() | ~F.length(c).between(1, 10), "length")


def check_price(name: str, c: Column) -> Column:
    return field_error(name, F.coalesce((c <= 0) | (c > 1_000_000), F.lit(False)), "price_bounds")


def check_count(name: str, c: Column) -> Column:
    return field_error(name, F.coalesce((c < 0) | (c > 10_000_000_000), F.lit(False)), "count_bounds")


def check_iso(name: str, c: Column) -> Column:
    return field_error(name, F.try_to_timestamp(c).isNull(), "iso_time")


def check_iso_utc(name: str, c: Column) -> Column:
    return field_error(name, ~F.coalesce(F.endswith(c, F.lit("Z")) & F.try_to_timestamp(c).isNotNull(), F.lit(False)), "iso_utc")


def epoch_ms(c: Column) -> Column:
    return F.timestamp_millis(c.cast("long"))


def rule_ohlc(open_: Column, high: Column, low: Column, close: Column) -> Column:
    known = open_.isNotNull() & high.isNotNull() & low.isNotNull() & close.isNotNull()
    top = _error((high < open_) | (high < low) | (high < close), "High price is not the highest value")
    bottom = _error((low > open_) | (low > high) | (low > close), "Low price is not the lowest value")
    text = F.concat_ws("; ", top, bottom)
    return F.when(known & (text != ""), text)


def rule_bar_recency(ts: Column, now: Column, cfg: RuleConfig = _CFG) -> Column:
    hours = F.expr(f"INTERVAL {cfg.bar_max_age_hours} HOURS")
    skew = F.expr(f"INTERVAL {cfg.bar_skew_minutes} MINUTES")
    return F.when(ts.isNull(), "Invalid timestamp format").when(ts < now - hours, f"Data is too old (older than {cfg.bar_max_age_hours} hours)").when(ts > now + skew, "Data timestamp is in the future")


def rule_price_band(close: Column) -> Column:
    outside = F.concat(F.lit("Price "), price_text(close), F.lit(" is outside expected range for most stocks"))
    return F.when(close <= 0, "Price must be positive").when(~((close > 0.001) & (close < 10000)), outside)


def rule_sudden_change(close: Column, before: Column, cfg: RuleConfig = _CFG) -> Column:
    percent = change_percent(close, before)
    return _error(percent > cfg.max_change_percent, F.concat(F.lit("Suspicious price change of "), F.format_string("%.2f", percent), F.lit("%")))


def price_text(c: Column) -> Column:
    """A double as the shortest decimal text: no exponent from 0.0001 up to 10 ** 16."""
    plain = c.cast("string")
    mantissa = F.regexp_replace(F.regexp_replace(plain, r"E.*$", ""), r"\.0$", "")
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    small = F.when(c >= 0.0001, F.concat(F.lit("0.000"), digits)).otherwise(F.concat(mantissa, F.lit("e-"), F.lpad(F.regexp_extract(plain, r"E-(\d+)$", 1), 2, "0")))
    return F.when(c >= 1e16, F.regexp_replace(plain, r"(\.0)?E", "e+")).when(c >= 1e7, F.concat(F.regexp_replace(c.cast("decimal(38,9)").cast("string"), r"\.?0+$", ""), F.when(c == F.floor(c), ".0").otherwise(""))).when((c > 0) & (c < 0.001), small).otherwise(plain)


def change_percent(close: Column, before: Column) -> Column:
    """Null where there is nothing above 0 to compare with."""
    return F.when(before > 0, F.abs(close - before) / before * 100)


def created_datetime(created_utc: Column, *texts: Column) -> Column:
    return F.coalesce(F.timestamp_seconds(created_utc.cast("double").cast("long")), *(F.try_to_timestamp(t) for t in texts))


def normalise_symbols(c: Column) -> Column:
    """Well-formed symbols without their $, or null if none is left."""
    kept = F.transform(F.filter(c, lambda s: s.rlike(r"^\$?[A-Z]{1,5}$")), lambda s: F.regexp_replace(s, r"^\$", ""))
    return F.when(F.size(kept) > 0, kept)


def rule_reddit_time(created: Column, collected: Column, now: Column, created_text: Column, collected_text: Column) -> Column:
    early = collected < created - F.expr("INTERVAL 5 MINUTES")
    ahead = created > now + F.expr("INTERVAL 10 MINUTES")
    before = F.concat(F.lit("Collection timestamp "), collected_text, F.lit(" is significantly before creation timestamp "), created_text)
    return F.when(early, before).when(ahead, F.concat(F.lit("Creation timestamp "), created_text, F.lit(" is suspiciously far in the future")))


def warn_reddit_age(collected: Column, now: Column, collected_text: Column) -> Column:
    return _error(collected < now - F.expr("INTERVAL 7 DAYS"), F.concat(F.lit("Collection timestamp "), collected_text, F.lit(" is older than 7 days")))


def _kept(*found: Column) -> Column:
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def warn_post_quality(author: Column, title: Column, body: Column, is_self: Column) -> Column:
    return _kept(_error((author == "[deleted]") & (title == "[deleted]"), "Post appears to be deleted (author and title)."), _error(F.length(title) < 5, "Post has a very short title."), _error(is_self & (F.coalesce(body, F.lit("")) == "") & (F.length(title) < 20), "Self-post with no body and short title."))


def warn_comment_quality(author: Column, body: Column) -> Column:
    return _kept(_error((author == "[deleted]") & (body == "[deleted]"), "Comment appears to be fully deleted."), _error(F.length(body) < 3, "Comment has a very short body."))


def rule_title(title: Column, least: int = _CFG.title_min) -> Column:
    return F.when(F.coalesce(title, F.lit("")) == "", "Missing title").when(F.length(title) < least, f"Title too short (minimum {least} characters)").when(is_upper(title), "Title is all uppercase")


def rule_content(description: Column, content: Column, least: int = _CFG.content_min) -> Column:
    longest = F.greatest(F.length(F.coalesce(description, F.lit(""))), F.length(F.coalesce(content, F.lit(""))))
    return F.when(longest == 0, "Both description and content are missing").when(longest < least, f"Content too short (minimum {least} characters)")


def rule_news_recency(published: Column, now: Column, cfg: RuleConfig = _CFG) -> Column:
    """published: the text of the article's date."""
    at = F.try_to_timestamp(published)
    ahead = F.concat(F.lit("Publication date is in the future: "), published)
    found = F.when(F.coalesce(published, F.lit("")) == "", "Missing publication timestamp").when(at.isNull(), F.concat(F.lit("Invalid publication timestamp format: "), published))
    return found.when(at > now + F.expr("INTERVAL 1 HOUR"), ahead).when(at < now - F.expr(f"INTERVAL {cfg.news_max_days} DAYS"), f"Article too old (> {cfg.news_max_days} days)")


def article_id(given: Column, url: Column) -> Column:
    return F.coalesce(F.nullif(given, F.lit("")), url)


def all_errors(schema: list[Column], business: list[Column]) -> Column:
    """Schema errors if there are any, else all business errors, prefixed."""
    first = _kept(*schema)
    then = _kept(*(F.concat(F.lit("Business rule error: "), b) for b in business))
    return F.when(F.size(first) > 0, first).otherwise(then)
