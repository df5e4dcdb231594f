"""Scores that are kept: texts seen before are looked up, only new ones are scored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Scorer = Callable[[DataFrame], DataFrame]


def _hash(text_col: str):
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)


def kept_scores(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """text_hash, batch and the scores that a version of the scorer has given; None if it has given none yet."""
    try:
        return spark.read.parquet(f"{path}/version={version}")
    except AnalysisException:
        return None


def get_or_compute(df: DataFrame, text_col: str, scorer: Scorer, path: str, version: str, batch: str) -> DataFrame:
    """df with the columns that scorer adds to texts (text_hash, text), each different text scored once, ever.

    Scores lie under the path by version of the scorer and by batch. A batch scores what no other batch has, and writes
    it over what it wrote itself, so a batch that is run again, or was stopped half way, leaves the same scores; a new
    version starts anew. Two batches at once may both score a text: one of the scores counts. Null and empty texts are
    one text. The store is joined by hash, so texts themselves are sent only if they are new.
    """
    spark = df.sparkSession
    keyed = df.withColumn("text_hash", _hash(text_col))
    known = kept_scores(spark, path, version)
    new = keyed.select("text_hash", F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if known is not None:
        others = known.where(F.col("batch").cast("string") != batch).select(F.col("text_hash").alias("_known"))
        new = new.join(others, F.col("text_hash") == F.col("_known"), "left_anti")
    scored = scorer(new.dropDuplicates(["text_hash"]))
    scored.drop("text").write.mode("overwrite").parquet(f"{path}/version={version}/batch={batch}")
    store = kept_scores(spark, path, version).drop("batch").dropDuplicates(["text_hash"])
    return keyed.join(store.withColumnRenamed("text_hash", "_known"), F.col("text_hash") == F.col("_known")).drop("text_hash", "_known")
