"""Shared-folder tables and small column helpers of the llm operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where it is unset and all runs on one machine (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="tickertide-"))
        path = _own[0]
    return path


#: Spark's setting to delete a query's shuffle files when it has ended.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def park(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df once to the shared folder, with the writer's options, and read it back: lineage is cut and a lost executor loses nothing.

    What is written needs its shuffle files no more, so they go at once and not when the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_TIDY, "false")
    spark.conf.set(_TIDY, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def unpark(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete parked tables that no later step reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


#: Rows of a parked table up to which it is sent to all executors; beyond, it is joined by shuffle.
FEW = 1_000_000


def few(parked: DataFrame, most: int = FEW) -> DataFrame:
    """A parked table, marked for broadcast if it has few rows."""
    return F.broadcast(parked) if parked.count() <= most else parked


def packed(df: DataFrame, text_col: str | None = None) -> DataFrame:
    """df's rows as one column `packed`, so that none of its names can clash with ours; a text column stands beside it, as `text`."""
    rest = F.struct(*(F.col(f"`{c}`") for c in df.columns if c != text_col)).alias("packed")
    return df.select(rest) if text_col is None else df.select(rest, F.col(f"`{text_col}`").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, mod 5, is 0; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
