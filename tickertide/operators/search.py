"""News search by an inverted index, kept as a table of postings.

A posting says what a term weighs in an article: its hits times the weights of the fields they are in. Postings lie in
folders by a hash of the term, and there in order of term and falling weight, so that a search opens the folders of its
terms only, and the reader's statistics (least and greatest weight of each stretch of a file) skip what weighs too
little. The search is exact: articles that reach the k-th best have at least one term of a fair share of its weight,
so light postings need not be looked at to find them, only to complete those that were found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickertide.functions.text import words

#: Weights of hits by field.
FIELDS = {"title": 10, "description": 5, "content": 1}
#: Folders of an index, and files that a frequent term's postings are spread over.
BUCKETS, SPREAD = 64, 8


def postings(news: DataFrame, id_col: str = "url", fields: dict[str, int] = FIELDS) -> DataFrame:
    """term, id, weight. Repeated articles add up; null fields have no words."""
    # texts are dealt to rows by field and then by word, which needs no step for each word before rows are made
    every = F.inline(F.array(*(F.struct(words(F.lower(F.col(f))).alias("terms"), F.lit(w).cast("long").alias("weight")) for f, w in fields.items())))
    hits = news.select(F.col(id_col).alias("id"), every).select("id", "weight", F.explode("terms").alias("term"))
    # an article's hits lie in one task, so they are summed before anything is sent
    return hits.groupBy("term", "id").agg(F.sum("weight").alias("weight"))


def write_index(news: DataFrame, path: str, id_col: str = "url", fields: dict[str, int] = FIELDS, buckets: int = BUCKETS, spread: int = SPREAD) -> None:
    """The index of all articles, over what is at the path."""
    rows = postings(news, id_col, fields).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(spread))).repartition("bucket", "part").sortWithinPartitions("bucket", "term", F.desc("weight"), "id").drop("part")
    rows.write.mode("overwrite").option("parquet.block.size", 16 << 20).partitionBy("bucket").parquet(path)


def index_terms(spark: SparkSession, path: str, terms: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The postings of the terms: their folders and stretches only."""
    found = spark.read.schema("term string, id string, weight long, bucket int").parquet(path)
    if not terms:
        return found.where("false")
    return found.where(F.col("bucket").isin(sorted({xxh64_intdigest(t.encode(), 42) % buckets for t in terms})) & F.col("term").isin(terms))


def search_index(spark: SparkSession, path: str, terms: list[str], k: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """id, relevance of the k best articles; ties go to the smaller id. buckets: as the index was written; a power of two."""
    terms = sorted({t.lower() for t in terms})
    rows = index_terms(spark, path, terms, buckets)
    if not terms:
        return rows.select("id", F.col("weight").alias("relevance"))
    # the best k of each term give a bound that the k-th best of all reaches
    heads = reduce(DataFrame.unionByName, (rows.where(F.col("term") == t).orderBy(F.desc("weight"), "id").limit(k) for t in terms))
    sums = [r["s"] for r in heads.groupBy("id").agg(F.sum("weight").alias("s")).orderBy(F.desc("s")).limit(k).collect()]
    bound = sums[-1] if len(sums) == k else 1
    heavy = rows.where(F.col("weight") >= -(-bound // len(terms))).select("id").distinct()
    return rows.join(heavy, "id", "left_semi").groupBy("id").agg(F.sum("weight").alias("relevance")).orderBy(F.desc("relevance"), "id").limit(k)
