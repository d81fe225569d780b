"""Stratified samples and audit reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kartoteka.operators.shared import stored


def rescaled(sizes: dict, total: int) -> dict:
    """Sizes of strata in the given proportions for a sample of about `total`: half to even, none below one."""
    whole = sum(sizes.values())
    return {k: max(1, round(n * total / whole)) for k, n in sizes.items()}


def stratified_sample(df: DataFrame, stratum: str, sizes: dict, order: Column) -> DataFrame:
    """Up to sizes[s] rows of each stratum by a hashed order (a random generator's picks cannot be expressed in SQL).

    The limit of the largest stratum is a constant, so each task passes on no more than so many rows of a stratum and
    none ranks a whole one; the strata's own limits are applied to these.
    """
    wanted = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(n))])
    ranked = df.filter(F.col(stratum).isin(*sizes)).withColumn("place", F.row_number().over(Window.partitionBy(stratum).orderBy(order)))
    return ranked.filter(F.col("place") <= max(sizes.values())).filter(F.col("place") <= F.try_element_at(wanted, F.col(stratum)))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """Add _place, from 0 in the order. Ranges of the order are numbered apart; one row per range, its size, gives where each starts."""
    ranged = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_start"))  # a row per task
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("_place", place).join(F.broadcast(starts), "_range").withColumn("_place", F.col("_start") + F.col("_place")).drop("_range", "_start")


def with_batches(sample: DataFrame, n: int, *order: Column) -> DataFrame:
    """Round robin: row i of the order goes to batch i mod n."""
    return numbered(sample, *order).withColumn("batch", F.pmod(F.col("_place"), F.lit(n)).cast("int")).drop("_place")


def dimension_means(scored: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, n, pct): mean of non-null scores, in per cent."""
    long = scored.unpivot([], [F.col(d).cast("double").alias(d) for d in dimensions], "dimension", "score")
    return long.groupBy("dimension").agg(F.count("score").alias("n"), F.round(F.avg("score") * 100, 6).alias("pct"))


def fill_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, filled, n) by one pass over the table."""
    counts = df.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in columns])
    return counts.unpivot(["n"], columns, "column", "filled").select("column", "filled", "n")


def gate(df: DataFrame, **rules: Column) -> DataFrame:
    """Add kept and reason: the names of failed rules, or ok. A rule that is null fails."""
    holds = {k: F.coalesce(c, F.lit(False)) for k, c in rules.items()}
    failed = F.concat_ws("; ", *[F.when(~c, k) for k, c in holds.items()])
    return df.withColumns({"kept": failed == "", "reason": F.when(failed == "", "ok").otherwise(failed)})
