"""Tables between the steps of a job, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a folder of our own where it is unset and all runs on one machine (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="tickertide-"))
        path = _own[0]
    return path


def park(df: DataFrame, name: str) -> DataFrame:
    """Write df once and read it back: lineage is cut and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unpark(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete parked tables that no later step reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
