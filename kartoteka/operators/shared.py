"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of our own on a local master (tests), and an error on a cluster, whose machines share none by default."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="kartoteka-"))
        base = spark.sparkContext.getCheckpointDir()
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: it is computed once, and lineage stays short."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def versions(spark: SparkSession, base: str) -> list[str]:
    """Names of the finished versions below base/v=<name>, in order; a folder without its success mark is none."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    path = Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in files.listStatus(path)] if files.exists(path) else []
    return sorted(p.getName()[2:] for p in found if p.getName().startswith("v=") and files.exists(Path(p, "_SUCCESS")))
