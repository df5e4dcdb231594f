"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters the records uniformly into buckets: a seeded hash of a record's id and place gives its bucket, one
task a bucket, and buckets have about bucket_bytes. There each bucket is shuffled (Spark's shuffle() is the inside-out
Fisher-Yates), with a generator seeded by the seed and the bucket, and is written to the shared folder. Pass two lays
the buckets end to end and cuts their line into shards whose counts differ by one at most (law `rows`), so that a shard
is a run of whole buckets but for its ends. Only the counts of buckets are summed along a window, never rows.

The hash takes a record's place in the files beside its id, so that records that share an id, or are alike in every
column, scatter too, and no id can fill a bucket. The same files and settings give the same shards; docs that are
themselves the outcome of a shuffle are to be written first. A record has text_bytes, the UTF-8 bytes of its text, plus
one; null texts have none. Null ids and repeated rows are records like any other; there are no ties. A bucket is
bounded by bucket_bytes and the longest record it holds, whatever the lengths of texts. An empty table gives an empty
table. Other columns stay, whatever their names; columns shard and slot that are there already are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.llm.common import few, packed, park

SHARDS, SEED = 16, 11
#: Bytes of the texts in a bucket, about, and what each record adds for its other columns.
BUCKET_BYTES, RECORD_BYTES = 48 << 20, 200


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def scattered(docs: DataFrame, buckets: int, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Pass one: bucket, place (from 0, in the bucket's shuffled order), packed (the record)."""
    rows = packed(docs).withColumn("at", F.monotonically_increasing_id())
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), F.col("packed")[id_col], "at"))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    # sorted, so that what is shuffled comes in one order however the blocks arrive
    rows = rows.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "h", "at")
    gathered = rows.groupBy("bucket").agg(F.collect_list("packed").alias("records"))
    return gathered.select("bucket", F.posexplode(F.shuffle("records", seed)).alias("place", "packed"))


def shards(docs: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """docs in random order: its columns, shard (from 0) and slot (from 0 in each shard, without gaps)."""
    size = text_size(F.col(text_col).cast("string"))
    total = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(size + RECORD_BYTES), F.lit(0)).alias("bytes")).first()
    buckets = max(n_shards, -(-total["bytes"] // bucket_bytes))
    rows = park(scattered(docs, buckets, id_col, seed), "buckets")
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = park(counts.select("bucket", before.alias("base")), "bases")
    n, k = max(total["n"], 1), n_shards
    at = rows.join(few(base), "bucket").select("packed", (F.col("base") + F.col("place")).alias("at")).withColumn("shard", F.expr(f"cast(at * {k} div {n} as int)"))
    # a shard begins at the first place that is its own
    slot = F.expr(f"at - (cast(shard as bigint) * {n} + {k - 1}) div {k}")
    return at.select(*(F.col("packed")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")), "shard", slot.alias("slot"))


def write(sharded: DataFrame, path: str) -> None:
    """Pass two: a folder for each shard, its files in order of their slots. Records stay with their bucket's task: no shuffle."""
    sharded.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
