"""Coverage statistics, listings and top rows."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Measures of documents joined with labels.
DOCUMENTS = {
    "labelled": "quality is not null",
    "good": "quality = 1",
    "toxic": "toxic = 1",
    "long_texts": "n_chars >= 1000",
}


def measures(**conditions: str) -> list[Column]:
    """A row count and one conditional count per name, for one pass."""
    return [F.count("*").alias("n"), *[F.count_if(F.expr(c)).alias(name) for name, c in conditions.items()]]


def counts(df: DataFrame, **conditions: str) -> DataFrame:
    return df.agg(*measures(**conditions))


def buckets(df: DataFrame, **conditions: Column) -> DataFrame:
    """(bucket, n) of predicates that may overlap."""
    return df.agg(*[F.count_if(c).alias(k) for k, c in conditions.items()]).unpivot([], list(conditions), "bucket", "n")


def top_k(df: DataFrame, keys: list[str], k: int, *order) -> DataFrame:
    """The first k rows of each key; Spark keeps k per key before it shuffles."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rn") <= k).drop("_rn")


def exact_sum(c: str) -> Column:
    """The sum of a column of doubles as decimals, the same in any order of rows; null where a value has more than nine decimal places or nineteen digits before them."""
    d = F.expr(f"try_cast(`{c}` as decimal(28, 9))")
    return F.when(F.bool_and(F.coalesce(d.cast("double") == F.col(c), F.col(c).isNull())), F.try_sum(d))


def clear_winner(totals: DataFrame, key: str, name: str, margin: float) -> DataFrame:
    """(key, name) of totals (key, name, s, exact) where the largest s of a key is alone or beats the second by `margin`: by exact sums where both are known, so that no order of additions decides on the border."""
    w = Window.partitionBy(key).orderBy(F.desc("s"), F.asc_nulls_last(name))
    r = totals.withColumns({"_k": F.row_number().over(w), "_n": F.lead(F.struct("s", "exact")).over(w)}).filter("_k = 1")
    ahead = F.when(F.col("exact").isNotNull() & F.col("_n.exact").isNotNull(), (F.col("exact") - F.col("_n.exact")).cast("double")).otherwise(F.col("s") - F.col("_n.s"))
    return r.filter(F.col("_n.s").isNull() | (ahead >= margin)).select(key, name)


def listing(customers: DataFrame, minimum: float | None = None, segments: list[str] | None = None, not_nation: int | None = None, least_score: int | None = None) -> DataFrame:
    """Optional filters folded into one conjunction; all of it reaches the scan that can."""
    conditions = []
    if minimum is not None:
        conditions.append(F.col("c_acctbal") > minimum)
    if segments:
        conditions.append(F.col("c_mktsegment").isin(*segments))
    if not_nation is not None:
        conditions.append(F.col("c_nationkey").isNull() | (F.col("c_nationkey") != not_nation))
    if least_score is not None:
        flags = [F.col("c_acctbal") > 100, F.col("c_nationkey") > 5, F.col("c_name").contains("1")]
        conditions.append(reduce(add, [F.when(f, 1).otherwise(0) for f in flags]) >= least_score)
    return customers.filter(reduce(and_, conditions)) if conditions else customers


def profile(df: DataFrame, name: str) -> DataFrame:
    """(table, place, column, filled): the columns of a table in their order, from 1, and how many rows have a value there, in one pass."""
    some = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("place"), F.lit(c).alias("column"), F.col(f"n{i}").alias("filled")) for i, c in enumerate(df.columns)]))
    return some.select(F.lit(name).alias("table"), rows.alias("r")).select("table", "r.*")
