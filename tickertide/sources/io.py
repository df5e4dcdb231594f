"""Sources and sinks: message topics, JSON lines, reference sets, document and bar stores."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_topics(spark: SparkSession, topics: list[str], servers: str | None = None, root: str | None = None, starting: str = "earliest", fail_on_data_loss: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of (topic, key, value, timestamp). With servers it subscribes to Kafka; with root it reads text files below root/topic=NAME/."""
    if servers:
        rows = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_data_loss).lower()).load()
        return rows.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp")
    reader = spark.readStream.schema("value string, topic string").format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(root).where(F.col("topic").isin(topics)).select("topic", F.lit(None).cast("string").alias("key"), "value", F.current_timestamp().alias("timestamp"))


#: What becomes of a line of a JSON-lines file.
LINE_KINDS = ("blank", "bad", "other", "read")


def read_jsonl(spark: SparkSession, path: str, counts: Observation | None = None) -> DataFrame:
    """value, payload (variant): the lines that hold a JSON object; blank lines, other values and bad JSON are left out.

    counts: an observation that tells, once the rows have been read, how many lines were blank, bad JSON, other values
    and objects (LINE_KINDS): in the same pass, without another action. Read with spark.newSession() where the session also
    fits models: Spark's tasks cannot carry a session that has had an observation.
    """
    return of_lines(spark.read.text(path), counts)


def of_lines(lines: DataFrame, counts: Observation | str | None = None) -> DataFrame:
    """read_jsonl() of lines (value) that are there or come as a stream; a stream's observation is a name."""
    lines = lines.withColumn("payload", F.try_parse_json("value"))
    is_object = F.startswith(F.schema_of_variant("payload"), F.lit("OBJECT"))
    kind = F.when(F.trim(F.coalesce("value", F.lit(""))) == "", "blank").when(F.col("payload").isNull(), "bad").when(F.coalesce(is_object, F.lit(False)), "read").otherwise("other")
    lines = lines.withColumn("kind", kind)
    if counts is not None:
        lines = lines.observe(counts, *(F.count_if(F.col("kind") == k).alias(k) for k in LINE_KINDS))
    return lines.where(F.col("kind") == "read").drop("kind")


def read_reference_set(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Distinct stripped lines, without blank ones; nothing at the path means an empty set."""
    try:
        lines = spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], f"{name} string")
    return lines.select(F.trim("value").alias(name)).where(F.col(name) != "").distinct()


def read_store(spark: SparkSession, path: str, where: Column | str | None = None, limit: int | None = 10_000) -> DataFrame:
    """A stored collection under a predicate; the cap is the feature, None takes it off."""
    rows = spark.read.parquet(path)
    rows = rows if where is None else rows.where(where)
    return rows if limit is None else rows.limit(limit)


def _write_batch(target: str, partition: str | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        # a batch that is run again overwrites its own folder, so no row is there twice
        writer = batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id", *([partition] if partition else [])).parquet(target)

    return write


def write_documents(df: DataFrame, target: str, checkpoint: str, partition: str | None = None, once: bool = True):
    """Append a stream to a document table, each batch once."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(_write_batch(target, partition))
    return (writer.trigger(availableNow=True) if once else writer).start()


def write_bars(df: DataFrame, target: str, checkpoint: str, once: bool = True):
    """The same for bars, partitioned by day."""
    return write_documents(df.withColumn("date", F.to_date("bar_ts")), target, checkpoint, "date", once)


def write_console(df: DataFrame, rows: int = 10, truncate: bool = False):
    return df.writeStream.format("console").option("numRows", rows).option("truncate", truncate).outputMode("append").start()


def to_messages(df: DataFrame, topic: Column | str, key: Column | str) -> DataFrame:
    """topic, key, value (JSON of all columns)."""
    named = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(named(topic).alias("topic"), named(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def write_topics(messages: DataFrame, servers: str | None = None, root: str | None = None) -> None:
    """Messages to Kafka, or as text files below root/topic=NAME/."""
    if servers:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        messages.select("value", "topic").write.mode("append").partitionBy("topic").text(root)


def write_dated(df: DataFrame, path: str, ts: str, spread: int = 8, mode: str = "append") -> None:
    """df in folders by the date of ts (a timestamp or epoch seconds), in order of ts.
    Mode "overwrite" replaces the dates that df has, and leaves the others.

    Each task writes neighbouring dates, so that most dates are one file however many there are; a date of very many rows
    is dealt to up to `spread` tasks. The number of tasks is Spark's for shuffles, as small rows make many files."""
    at = F.col(ts) if dict(df.dtypes)[ts].startswith("timestamp") else F.timestamp_seconds(ts)
    rows = df.withColumn("date", F.to_date(at)).withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(tasks, "date", "_part").sortWithinPartitions("date", ts).drop("_part")
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


#: Months up to which a store's folders are found by a pattern.
_LISTED_MONTHS = 240


def _months(date: str) -> int:
    return int(date[:4]) * 12 + int(date[5:7]) - 1


def read_dated(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The rows of write_dated() from the start date to the end date, both included: only their folders are listed and read."""
    rows = None
    if start is not None and end is not None and 0 <= _months(end) - _months(start) < _LISTED_MONTHS:
        # the months' folders by a pattern, so that the others are not listed; a store may have none of them
        months = ",".join(f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(_months(start), _months(end) + 1))
        try:
            rows = spark.read.option("basePath", path).parquet(f"{path}/date={{{months}}}-*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    rows = spark.read.parquet(path) if rows is None else rows
    for bound, keep in ((start, lambda d: F.col("date") >= d), (end, lambda d: F.col("date") <= d)):
        rows = rows if bound is None else rows.where(keep(F.lit(bound).cast("date")))
    return rows


def load_processed(spark: SparkSession, path: str, key: str = "url") -> DataFrame:
    try:
        return spark.read.parquet(path).select(key).distinct()
    except AnalysisException:
        return spark.createDataFrame([], f"{key} string")


def save_processed(df: DataFrame, path: str, key: str = "url") -> None:
    df.select(key).distinct().write.mode("append").parquet(path)
