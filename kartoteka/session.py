"""Sessions and table loading."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "kartoteka", cores: str | None = None, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
