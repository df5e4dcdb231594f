"""Parsing, record building, validation and routing of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickertide.functions import rules as R
from tickertide.operators.folds import with_last_valid

BAR_FIELDS = {"symbol": "string", "open": "double", "high": "double", "low": "double", "close": "double", "volume": "bigint", "vwap": "double", "timestamp": "double", "collection_timestamp": "string", "transactions": "bigint"}
BAR_REQUIRED = ("symbol", "close", "timestamp", "collection_timestamp")
BAR_JOB_SCHEMA = "date timestamp, open double, high double, low double, close double, volume bigint, Name string, symbol string, timestamp bigint"
POST_SCHEMA = (
    "id string, source string, content_type string, collection_timestamp string, created_utc double, author string, score bigint, subreddit string, permalink string, detected_symbols array<string>, created_datetime string, "
    "title string, selftext string, url string, is_self boolean, upvote_ratio float, num_comments bigint, collection_method string, post_id string, body string, parent_id string, is_submitter boolean"
)


def parse_json(raw: DataFrame, schema: str, column: str = "value") -> DataFrame:
    return raw.select(F.from_json(F.col(column).cast("string"), schema).alias("d")).select("d.*")


def parse_bars(raw: DataFrame, column: str = "value") -> DataFrame:
    """Both spellings of a bar: date/Name and timestamp/symbol."""
    rows = parse_json(raw, BAR_JOB_SCHEMA, column)
    return rows.select(F.coalesce("symbol", "Name").alias("symbol"), F.coalesce(F.col("date"), F.timestamp_millis("timestamp")).alias("ts"), "open", "high", "low", "close", "volume")


def parse_posts(raw: DataFrame, column: str = "value") -> DataFrame:
    return default_symbols(parse_json(raw, POST_SCHEMA, column).withColumn("created_utc", F.col("created_utc").cast("long")))


def default_symbols(df: DataFrame, column: str = "detected_symbols") -> DataFrame:
    return df.withColumn(column, F.coalesce(column, F.array().cast("array<string>")))


def stamp_processing_time(df: DataFrame, now: Column | None = None) -> DataFrame:
    return df.withColumn("processing_timestamp", F.current_timestamp() if now is None else now)


def normalise_symbol_column(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("Name", "name")


def classify_payload(raw: DataFrame, column: str = "value") -> DataFrame:
    """kind: skipped (no value), error (no JSON or no object) or object; payload is the parsed variant."""
    parsed = raw.withColumn("payload", F.try_parse_json(F.col(column).cast("string")))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("payload"), F.lit("OBJECT")), F.lit(False))
    kind = F.when(F.col(column).isNull(), "skipped").when(F.col("payload").isNull() | ~is_object, "error").otherwise("object")
    text = F.when(F.col("payload").isNull(), "Invalid JSON").otherwise("Message value is not a dictionary")
    return parsed.withColumn("kind", kind).withColumn("error", F.when(F.col("kind") == "error", text))


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def bar_record(bars: DataFrame, collected: Column) -> DataFrame:
    ms = F.unix_timestamp(F.col("bar_ts").cast("timestamp")) * 1000
    return bars.select("symbol", "open", "high", "low", "close", "volume", F.lit(None).cast("double").alias("vwap"), ms.alias("timestamp"), F.lit(None).cast("bigint").alias("transactions"), collected.alias("collection_timestamp"), F.concat_ws("_", "symbol", ms.cast("string")).alias("key"))


def post_record(posts: DataFrame) -> DataFrame:
    return posts.withColumn("author", F.coalesce("author", F.lit("[deleted]"))).withColumn("post_created_datetime", iso(F.timestamp_seconds("created_utc"))).withColumn("permalink", F.concat(F.lit("https://www.reddit.com/r/"), "subreddit", F.lit("/comments/"), F.col("id").cast("string"))).withColumn("source", F.lit("reddit")).withColumn("content_type", F.lit("post"))


def comment_record(comments: DataFrame) -> DataFrame:
    return comments.withColumn("author", F.coalesce("author", F.lit("[deleted]"))).withColumn("comment_created_datetime", iso(F.timestamp_seconds("created_utc"))).withColumn("source", F.lit("reddit")).withColumn("content_type", F.lit("comment"))


def enrich_news(news: DataFrame, collected_at: Column, collector_id: str) -> DataFrame:
    """news with publishedAt (a text): the parts of the date, which are null where it cannot be read (published_at is then as it came), and counts of the content."""
    from tickertide.functions.text import text_stats

    day = F.try_to_timestamp("publishedAt")
    stats = F.when(F.coalesce("content", F.lit("")) != "", text_stats(F.col("content")))
    return news.withColumn("collected_at", collected_at).withColumn("collector_id", F.lit(collector_id)).withColumn("source_type", F.lit("newsapi")).withColumn("published_at", F.coalesce(iso(day), F.col("publishedAt"))).withColumn("published_date", F.date_format(day, "yyyy-MM-dd")).withColumn("published_time", F.date_format(day, "HH:mm:ss")).withColumn("published_timezone", F.lit("UTC")).withColumn("content_stats", stats)


def message_key(kind: str, ident: Column) -> Column:
    named = F.coalesce(ident.cast("string"), F.lit("UNKNOWN_ID"))
    return named if kind == "market" else F.concat(F.lit(f"{kind}_"), named)


def log_context(topic: Column, offset: Column, item_id: Column) -> Column:
    return F.struct(F.coalesce(topic, F.lit("unknown")).alias("topic"), F.coalesce(offset, F.lit(-1)).alias("offset"), F.coalesce(item_id, F.lit("UNKNOWN_ID")).alias("item_id"))


def invalid_envelope(payload: Column, errors: Column, now: Column, context: Column | None = None, news: bool = False) -> Column:
    """What goes to the invalid topic; the news service names its parts otherwise."""
    names = ("article", "errors", "timestamp") if news else ("original_message", "validation_errors", "processing_timestamp")
    parts = [c.alias(n) for c, n in zip((payload, errors, now), names, strict=True)]
    return F.to_json(F.struct(*parts, *([] if context is None else [context.alias("log_context")])))


def not_an_object_envelope(payload: Column, message: Column, context: Column) -> Column:
    """What goes to the error topic for a value that is no object."""
    return F.to_json(F.struct(payload.alias("original_payload"), message.alias("error"), context.alias("context")))


def error_envelope(payload: Column, kind: str, message: Column, service: str, now: Column, context: Column | None = None) -> Column:
    parts = [F.lit(kind).alias("error_type"), message.alias("error_message"), F.lit(service).alias("service_name"), now.alias("error_timestamp"), payload.alias("original_payload")]
    return F.to_json(F.struct(*parts, *([] if context is None else [context.alias("log_context")])))


def bar_schema_errors(payload: Column) -> list[Column]:
    """One column for each field that can be wrong, from the parsed variant: wrong type, missing, or not known at all."""
    found = []
    for name, kind in BAR_FIELDS.items():
        here = F.variant_get(payload, f"$.{name}", "variant")
        value = F.try_variant_get(payload, f"$.{name}", kind)
        bad = here.isNotNull() & ~F.is_variant_null(here) & value.isNull()
        missing = here.isNull() | F.coalesce(F.is_variant_null(here), F.lit(False))
        found.append(R.field_error(name, missing, "missing") if name in BAR_REQUIRED else F.lit(None).cast("string"))
        found.append(R.field_error(name, F.coalesce(bad, F.lit(False)), "type"))
    keys = F.json_object_keys(F.to_json(payload))
    extra = F.array_sort(F.array_except(keys, F.array(*map(F.lit, BAR_FIELDS))))
    found.append(F.when(F.size(extra) > 0, F.concat(F.lit("Schema error: Field '"), F.array_join(extra, ","), F.lit("': extra_forbidden"))))
    return found


def validate_bars(classified: DataFrame, now: Column, previous: Column | None = None) -> DataFrame:
    """classify_payload's rows of kind object -> typed fields, errors (array), in one narrow stage. previous: the symbol's last accepted close, if known."""
    typed = classified.select("*", *(F.try_variant_get("payload", f"$.{n}", k).alias(n) for n, k in BAR_FIELDS.items()))
    c = F.col
    schema = bar_schema_errors(c("payload"))
    schema += [F.when(c("symbol").isNotNull(), R.check_symbol(c("symbol")))]
    schema += [R.check_price(n, c(n)) for n in ("open", "high", "low", "close", "vwap")] + [R.check_count(n, c(n)) for n in ("volume", "transactions")]
    schema += [F.when(c("collection_timestamp").isNotNull(), R.check_iso("collection_timestamp", c("collection_timestamp")))]
    business = [R.rule_ohlc(c("open"), c("high"), c("low"), c("close")), R.rule_bar_recency(R.epoch_ms(c("timestamp")), now), R.rule_price_band(c("close"))]
    if previous is not None:
        business.append(R.rule_sudden_change(c("close"), previous))
    return typed.withColumn("errors", R.all_errors(schema, business)).withColumn("symbol", F.upper("symbol"))


def validate_bars_in_order(classified: DataFrame, now: Column, blocks: int | None = None) -> DataFrame:
    """validate_bars() with the rule of sudden changes: a bar that passes all others is held against the symbol's last accepted close.

    Bars are judged in order of their timestamps. A change of more than the limit is a business error of its own, and
    the bar does not become the next one's base.
    """
    judged = validate_bars(classified, now)
    rows = judged.select("symbol", R.epoch_ms(F.col("timestamp")).alias("bar_ts"), "close", (F.size("errors") == 0).alias("ok"), F.struct(*judged.columns).alias("row"))
    folded = with_last_valid(rows, blocks=blocks)
    sudden = F.when(F.col("ok") & ~F.col("accepted"), F.concat(F.lit("Business rule error: "), R.rule_sudden_change(F.col("close"), F.col("last_close"))))
    errors = F.when(sudden.isNotNull(), F.array(sudden)).otherwise(F.col("row.errors"))
    return folded.select(*(errors.alias(c) if c == "errors" else F.col("row")[c].alias(c) for c in judged.columns))


#: What every post and comment must have, in the order in which it is checked.
REDDIT_REQUIRED = ("id", "source", "content_type", "collection_timestamp", "created_utc", "author", "score", "subreddit", "permalink")
POST_REQUIRED, COMMENT_REQUIRED = ("url", "is_self"), ("post_id", "parent_id")


def validate_posts(posts: DataFrame, now: Column) -> DataFrame:
    """Typed posts or comments of POST_SCHEMA -> errors and warnings. Columns that posts do not have count as null."""
    missing = {f.split()[0]: f.split()[1] for f in POST_SCHEMA.split(", ")}
    names = [*REDDIT_REQUIRED, "title", "selftext", "url", "is_self", "upvote_ratio", "num_comments", "post_id", "body", "parent_id"]
    c = lambda n: F.col(n) if n in posts.columns else F.lit(None).cast(missing[n])
    texts = [F.col(n) for n in ("created_datetime", "post_created_datetime", "comment_created_datetime") if n in posts.columns]
    texts = [F.when(R.check_iso_utc("", t).isNull(), t) for t in texts]
    created, got = R.created_datetime(c("created_utc"), *texts), F.try_to_timestamp(c("collection_timestamp"))
    is_post, is_comment = F.coalesce(c("content_type") == "post", F.lit(False)), F.coalesce(c("content_type") == "comment", F.lit(False))
    absent = lambda n: R.field_error(n, c(n).isNull(), "missing")
    schema = [absent(n) for n in names[:2]] + [R.field_error("source", c("source") != "reddit", "literal")]
    schema += [absent("collection_timestamp"), F.when(c("collection_timestamp").isNotNull(), R.check_iso_utc("collection_timestamp", c("collection_timestamp")))]
    schema += [absent(n) for n in REDDIT_REQUIRED[4:]] + [R.field_error("created_datetime", created.isNull(), "missing")]
    schema += [F.when(is_post, x) for x in (R.field_error("title", F.coalesce(F.length(c("title")) < 1, F.lit(True)), "min_length"), *map(absent, POST_REQUIRED), R.field_error("upvote_ratio", ~F.coalesce(c("upvote_ratio").between(0, 1), F.lit(False)), "range"), R.field_error("num_comments", F.coalesce(c("num_comments") < 0, F.lit(True)), "min"))]
    empty = lambda n: R.field_error(n, F.coalesce(c(n).cast("string") == "", F.lit(True)), "missing")
    schema += [F.when(is_comment, x) for x in (empty("post_id"), R.field_error("body", F.coalesce(F.length(c("body")) < 1, F.lit(True)), "min_length"), empty("parent_id"))]
    unknown = F.concat(F.lit("Schema error: Invalid or missing 'content_type': "), F.coalesce(c("content_type"), F.lit("None")))
    time = R.rule_reddit_time(created, got, now, iso(created), c("collection_timestamp"))
    errors = F.when(is_post | is_comment, R.all_errors(schema, [time])).otherwise(F.array(unknown))
    quality = F.when(is_post, R.warn_post_quality(c("author"), c("title"), c("selftext"), c("is_self"))).otherwise(R.warn_comment_quality(c("author"), c("body")))
    warnings = F.concat(quality, F.filter(F.array(R.warn_reddit_age(got, now, c("collection_timestamp"))), lambda x: x.isNotNull()))
    return posts.withColumn("errors", errors).withColumn("warnings", warnings)


NEWS_REQUIRED = ("publishedAt", "source", "collected_at", "collector_id")


def validate_news(news: DataFrame, now: Column) -> DataFrame:
    c = F.col
    schema = [R.field_error("title", F.coalesce(F.length("title") < 1, F.lit(True)), "min_length"), R.field_error("url", F.coalesce(F.length("url") < 10, F.lit(True)), "min_length")]
    schema += [R.field_error(n, c(n).isNull(), "missing") for n in NEWS_REQUIRED]
    business = [R.rule_title(c("title")), R.rule_content(c("description"), c("content")), R.rule_news_recency(c("publishedAt"), now)]
    return news.withColumn("errors", R.all_errors(schema, business))


def finalise_news(valid: DataFrame, now: Column) -> DataFrame:
    given = F.col("article_id") if "article_id" in valid.columns else F.lit(None).cast("string")
    return valid.withColumn("article_id", R.article_id(given, F.col("url"))).withColumn("validated_at", now).withColumn("validation_version", F.lit("1.0.0"))


#: The news store's fields and their types (fixed values); a dot leads into a struct.
NEWS_STORE = {
    "article_id": "string", "source_id": "string", "source_name": "string", "author": "string", "title": "string", "description": "string", "url": "string", "image_url": "string", "published_at": "timestamp", "content": "string",
    "symbols": "array<string>", "categories": "array<string>", "relevance_score": "double", "collection_timestamp": "timestamp", "processed": "boolean", "sentiment.score": "double", "sentiment.magnitude": "double", "sentiment.label": "string", "sentiment.processed_at": "timestamp",
}
NEWS_STORE_REQUIRED = ("article_id", "source_name", "title", "url", "published_at", "collection_timestamp")
NEWS_LABELS = ("positive", "negative", "neutral", "mixed")


def check_news_documents(docs: DataFrame) -> DataFrame:
    """The store's own check: required fields, types, a score in 0 .. 1, a label of NEWS_LABELS. Fields that docs do not have are absent."""
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    found = {n: kinds[n] for n in kinds} | {f"sentiment.{f.name}": f.dataType for f in getattr(kinds.get("sentiment"), "fields", [])}
    value = lambda n: F.col(n) if n in found else F.lit(None)
    schema = [R.field_error(n, value(n).isNull(), "required") for n in NEWS_STORE_REQUIRED]
    schema += [R.field_error(n, F.col(n).isNotNull(), "type") for n, kind in NEWS_STORE.items() if n in found and found[n].simpleString() != kind]
    if "relevance_score" in found:
        schema.append(R.field_error("relevance_score", ~F.coalesce(F.col("relevance_score").between(0, 1), F.lit(True)), "range"))
    if "sentiment.label" in found:
        schema.append(R.field_error("sentiment.label", ~F.coalesce(F.col("sentiment.label").isin(*NEWS_LABELS), F.lit(True)), "enum"))
    return docs.withColumn("errors", R.all_errors(schema, []))


#: What schema_of_variant says of a value of each type of the store; dates come as texts.
_VARIANT_KINDS = {"string": "^STRING$", "double": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$", "array<string>": r"^ARRAY<(STRING|VOID)>$", "timestamp": r"^(STRING|TIMESTAMP.*|DATE)$"}


def check_news_payloads(docs: DataFrame, payload: str = "payload") -> DataFrame:
    """docs (payload: variant) with errors: check_news_documents() document by document, so that one of a wrong type fails alone.
    Null fields count as absent; a field that is required and of another type has one error."""
    errors = []
    for name, kind in NEWS_STORE.items():
        here = F.variant_get(payload, f"$.{name}", "variant")
        there = here.isNotNull() & ~F.coalesce(F.is_variant_null(here), F.lit(False))
        right = F.schema_of_variant(here).rlike(_VARIANT_KINDS[kind])
        if kind == "timestamp":
            right = right & F.try_to_timestamp(F.try_variant_get(payload, f"$.{name}", "string")).isNotNull()
        if name in NEWS_STORE_REQUIRED:
            errors.append(R.field_error(name, ~there, "required"))
        errors.append(R.field_error(name, there & ~F.coalesce(right, F.lit(False)), "type"))
    score, label = F.try_variant_get(payload, "$.relevance_score", "double"), F.try_variant_get(payload, "$.sentiment.label", "string")
    errors.append(R.field_error("relevance_score", ~F.coalesce(score.between(0, 1), F.lit(True)), "range"))
    errors.append(R.field_error("sentiment.label", ~F.coalesce(label.isin(*NEWS_LABELS), F.lit(True)), "enum"))
    return docs.withColumn("errors", R.all_errors(errors, []))
