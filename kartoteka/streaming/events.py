"""Extension: the catalog has no streams; these run event counts as Structured Streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.operators.shared import versions


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Counts and sums by window and type; also works on a batch table."""
    source = events.withWatermark("ts", late) if events.isStreaming else events
    return source.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 10).parquet(folder)


def upsert_latest(batch: DataFrame, batch_id: int, state_path: str) -> None:
    """For foreachBatch: the latest event of each user, merged with the version before, as a new version in state_path/v=<batch id>.

    A batch that is run again starts from the same version and replaces its own, so nothing counts twice.
    """
    spark, own = batch.sparkSession, f"{batch_id:012d}"
    rows = batch.select("user_id", "event_id", "ts", "event_type")
    before = [v for v in versions(spark, state_path) if v < own]
    if before:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{state_path}/v={before[-1]}"))
    latest = rows.groupBy("user_id").agg(F.max_by(F.struct("event_id", "ts", "event_type"), F.struct("ts", "event_id")).alias("e"))
    latest.select("user_id", "e.*").write.mode("overwrite").parquet(f"{state_path}/v={own}")
