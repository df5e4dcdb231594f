"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame functions only.

Sizes are word counts. Sources in order of code points (null last) take the weights in turn, and share `share` times
all words; a source is given `most` times its own words at most and what is above goes to the others by weight. That
has a closed form: with sources sorted by cap / weight, those below the water level get their cap.

The schedule: slot i stands at frac(i * golden ratio), which falls into one source's stretch of the cumulative
weights. A source's slots are ranked, and rank k takes block k of that source: its documents, shuffled by a hash and
laid end to end, cut into blocks of equally many words; a second pass goes over them again. Slots beyond a source's
last block fall away, and where the sequence gave a source too few (by its discrepancy, a few slots), the missing
ones follow at the end. So a source's words in the mix equal its target, rounded.

Nothing ranks or sums over one source in one task: hot sources are cut by hash bucket (documents) and by stretch
(slots), and only counts a bucket or stretch are summed along a window.

Null text has size 0, as has text without words: such rows are never taken. Null sources form one source. Repeated
rows are rows of their own, ties in the shuffle go by id and size. Texts may have any length: a document may span many
blocks. Other columns, whatever their names, are not looked at. An empty table gives an empty table; reruns give the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickertide.llm.common import packed, park, word_count

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Words in a block, and the fractional part of the golden ratio.
BLOCK, GOLDEN = 4096, 0.6180339887498949
#: Rows in a hash bucket of documents and slots in a stretch, about.
BUCKET_ROWS, STRETCH = 2000, 8192


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7) -> DataFrame:
    """id, row (hash of id and text), source, size and the place in the shuffle."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col).cast("string")).alias("row"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(F.lit(seed), id_col).alias("h"))


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: source, source_size, target (double), and n_rows. One small row for each source goes through a single window."""
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), turn.cast("int") + 1)).withColumn("cap", most * F.col("source_size"))
    level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    per = per.withColumn("capped", F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)))
    per = per.withColumn("open", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
    per = per.withColumn("goal", F.least(F.lit(share), F.lit(most)) * F.sum("source_size").over(Window.partitionBy()))
    # the level if this source and all after it stay below their caps; the least source that fits has the true one
    per = per.withColumn("level", (F.col("goal") - F.coalesce("capped", F.lit(0.0))) / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    first = F.first(fits, ignorenulls=True).over(level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per.select("source", "source_size", "n_rows", "weight", F.least("cap", F.coalesce(first * F.col("weight"), "cap")).alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def streams(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Each row of size > 0 with start, its first word's place in its source's shuffled stream."""
    buckets = per_source.select(F.col("source").alias("s"), F.ceil(F.col("n_rows") / BUCKET_ROWS).alias("n_buckets"))
    # the hash's high bits give the bucket, so buckets follow each other in the order of the hash
    spread = F.shiftrightunsigned("h", 33).cast("long")
    dealt = rows.where("size > 0").join(buckets, _same(F.col("source"), F.col("s"))).withColumn("bucket", F.floor(spread * F.col("n_buckets") / F.lit(float(1 << 31)))).drop("s", "n_buckets")
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(along), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "bucket").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return dealt.join(base, _same(F.col("source"), F.col("s")) & (F.col("bucket") == F.col("b"))).select("id", "row", "source", "size", (F.col("base") + F.col("inner")).alias("start"))


def schedule(per_source: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix in slots: slot, source, block_no (from 0), first and last word (end exclusive) of the source's stream, passes one after another."""
    spark = per_source.sparkSession
    order = Window.orderBy(F.col("source").asc_nulls_last())
    goal = F.round("target").cast("long")
    arcs = per_source.where("source_size > 0").select("source", "source_size", goal.alias("words"), F.sum("target").over(order).alias("upto"), F.sum("target").over(Window.partitionBy()).alias("all"))
    arcs = arcs.withColumn("needs", F.ceil(F.col("words") / block))
    # one row: the ends of all sources' stretches, as many numbers as there are sources
    ends = arcs.agg(F.array_sort(F.collect_list(F.struct((F.col("upto") / F.col("all")).alias("upto"), "source"))).alias("arcs"), F.sum("needs").alias("n"))
    n = ends.first()["n"] or 0
    slots = spark.range(n).withColumn("k", F.lit(1)).join(F.broadcast(ends.select("arcs", F.lit(1).alias("k"))), "k")  # a single row
    point = (F.col("id") * F.lit(GOLDEN)) % F.lit(1.0)
    slots = slots.withColumn("p", point).withColumn("hit", F.coalesce(F.get(F.filter("arcs", lambda a: a["upto"] > F.col("p")), F.lit(0)), F.element_at("arcs", -1)))
    slots = slots.select("id", F.col("hit.source").alias("source"), F.floor(F.col("id") / STRETCH).alias("stretch"))
    counts = slots.groupBy("source", "stretch").agg(F.count("*").alias("n"))
    along = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("source").alias("s"), F.col("stretch").alias("t"), F.coalesce(F.sum("n").over(along), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("source", "stretch").orderBy("id")) - 1
    ranked = slots.withColumn("r", rank).join(base, _same(F.col("source"), F.col("s")) & (F.col("stretch") == F.col("t"))).select("id", "source", (F.col("base") + F.col("r")).alias("block_no"))
    got = counts.groupBy("source").agg(F.sum("n").alias("got"))
    late = arcs.alias("a").join(got.alias("g"), _same(F.col("a.source"), F.col("g.source")), "left").withColumn("from", F.coalesce("got", F.lit(0))).where("from < needs")
    late = late.select((F.lit(n) + F.monotonically_increasing_id()).alias("id"), F.col("a.source").alias("source"), F.explode(F.sequence("from", F.col("needs") - 1)).alias("block_no"))
    every = ranked.unionByName(late)
    limits = arcs.select(F.col("source").alias("s"), "words", "needs")
    first = F.col("block_no") * block
    return every.join(limits, _same(F.col("source"), F.col("s"))).where("block_no < needs").select(F.col("id").alias("slot"), "source", "block_no", first.alias("first"), F.least(first + block, F.col("words")).alias("last"))


def pieces(placed: DataFrame, plan: DataFrame, per_source: DataFrame, block: int = BLOCK, most: float = MOST) -> DataFrame:
    """The mix: a row for each stretch of a document in a slot: slot, id, source, size, start, from_word, n_words."""
    sizes = per_source.select(F.col("source").alias("s"), "source_size")
    passes = F.explode(F.sequence(F.lit(0), F.lit(int(-(-most // 1)) - 1)))
    at = placed.join(sizes, _same(F.col("source"), F.col("s"))).withColumn("pass", passes).withColumn("begin", F.col("start") + F.col("pass") * F.col("source_size"))
    end = F.col("begin") + F.col("size")
    cut = at.select("id", "row", F.col("source").alias("src"), "size", "start", "begin", end.alias("end"), F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((end - 1) / block))).alias("no"))
    lo, hi = F.greatest("begin", "first"), F.least("end", "last")
    return cut.join(plan, _same(F.col("src"), F.col("source")) & (F.col("no") == F.col("block_no"))).where(hi > lo).select("slot", "id", "row", "source", "size", "start", (lo - F.col("begin")).alias("from_word"), (hi - lo).alias("n_words"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(all rows with sizes, targets by source, placed rows, pieces of the mix)."""
    rows = park(sized(docs, id_col, text_col, source_col), "sizes")
    per_source = park(targets(rows, weights, share, most), "targets")
    placed = park(streams(rows, per_source), "placed")
    return rows, per_source, placed, pieces(placed, schedule(per_source, block), per_source, block, most)


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **params) -> DataFrame:
    """Per row: id, size, source_size, target, taken (its words in the mix, repeats counted)."""
    return _taken(*mix(docs, id_col, text_col, source_col, **params)).select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def _taken(rows: DataFrame, per_source: DataFrame, placed: DataFrame, parts: DataFrame) -> DataFrame:
    # a row's place in its stream is its own, so equal rows stay apart; rows without words take nothing
    keys = ("id", "row", "source", "size", "start")
    none = placed.select(*keys, F.lit(0).cast("long").alias("taken"))
    totals = none.unionByName(parts.select(*keys, F.col("n_words").alias("taken"))).groupBy(*keys).agg(F.sum("taken").alias("taken")).drop("start")
    empty = rows.where("size = 0").select(*keys[:4], F.lit(0).cast("long").alias("taken"))
    per = per_source.select(F.col("source").alias("s"), "source_size", "target")
    return totals.unionByName(empty).join(per, _same(F.col("source"), F.col("s"))).select("id", "row", "size", "source_size", "target", "taken")


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **params) -> DataFrame:
    """docs as the mix takes them: each row as many times as its words are taken, rounded; rows equal in id and text alike
    as often as the one taken most. Rows without an id take part; columns may have any names."""
    done = _taken(*mix(docs, id_col, text_col, source_col, **params)).where("size > 0")
    copies = done.groupBy("row").agg(F.max(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int").alias("n")).where("n > 0")
    rows = packed(docs).withColumn("own", F.xxhash64(F.col("packed")[id_col], F.col("packed")[text_col].cast("string")))
    return rows.join(copies, F.col("own") == F.col("row")).select("packed", F.explode(F.sequence(F.lit(1), F.col("n")))).select("packed.*")
