"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Each source has a target share of the mixture; the rate of its documents is share * total / size. A document's
count is drawn by inverting a Poisson distribution with that mean at a uniform number hashed from (seed, id), so
counts do not depend on partitioning, order or retries. Rows are repeated by their count and dealt over all
partitions in the order of a hash of (seed, id, copy): a global shuffle without sampling the input.

The rates are one row per source. They are broadcast where counting them shows at most BROADCAST_SOURCES; beyond that
rows and rates meet by (source, salt), so a source of a third of all rows is dealt over SALTS tasks.

Defined cases: a null source is a source of its own; sources without a weight get rate 0 where weights are given;
a null id hashes as the empty text; rows that repeat an id draw the same count, and their copies are dealt apart by
the partition they were read in; an empty table gives an empty result; texts (null, empty or very long) are carried
whole and never looked at; other columns stay, whatever their names: where the input has a column `copy` or
`shuffle_key`, that stays and the new one is called `copy_` or `shuffle_key_`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.llm.common import free_names, stored

#: Without given weights the share of a source is its size to this power: smaller sources gain, larger ones lose.
TEMPERATURE = 0.5
SEED = 17
#: Means over this are drawn as a sum of equal parts, each inverted with a term bound that leaves less than 1e-15.
PART_MEAN = 8.0
TERMS = 48
#: Sources whose rates are broadcast (some 100 bytes each), and tasks a source is dealt over where there are more.
BROADCAST_SOURCES, SALTS = 100_000, 64


def _uniform(*keys: Column) -> Column:
    """In [0, 1), from 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *keys).cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def poisson(rate: Column, id_text: Column, seed: int) -> Column:
    """The count of one row: the least n with CDF(n) > u, summed over parts of a large mean."""
    parts = F.greatest(F.lit(1), F.ceil(rate / PART_MEAN).cast("int"))
    mean = rate / parts

    def draw(part: Column) -> Column:
        start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).alias("n"), _uniform(F.lit(seed), id_text, part).alias("u"))
        step = lambda a, k: F.when(
            a["u"] < a["cdf"], a
        ).otherwise(F.struct((a["p"] * mean / k).alias("p"), (a["cdf"] + a["p"] * mean / k).alias("cdf"), k.alias("n"), a["u"].alias("u")))
        return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda a: a["n"])

    return F.aggregate(F.transform(F.sequence(F.lit(1), parts), draw), F.lit(0), lambda a, x: a + x)


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """One row per source: its size and rate. Sizes are pre-aggregated in each partition, so a hot source costs nothing."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("_n"))
    if weights is None:
        sizes = sizes.withColumn("_w", F.pow(F.col("_n").cast("double"), F.lit(float(temperature))))
    else:
        spark = docs.sparkSession
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "_s string, _w double")
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").fillna(0.0, ["_w"])
    sizes = stored(sizes, "sizes")
    whole = sizes.agg(F.sum("_w").alias("w"), F.sum("_n").alias("n")).first()
    return sizes.select("source", "_n", F.coalesce(F.try_divide("_w", F.lit(whole.w)) * F.lit(whole.n) / F.col("_n"), F.lit(0.0)).alias("rate"))


def _rated(docs: DataFrame, of: DataFrame, most: int) -> DataFrame:
    """docs with the rate of their source."""
    source = F.col("source").eqNullSafe(F.col("_source"))
    if of.count() <= most:
        return docs.join(F.broadcast(of), source)
    dealt = docs.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    every = of.withColumn("_deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return dealt.join(every, source & (F.col("_salt") == F.col("_deal")))


def mix(
    docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, seed: int = SEED, shuffled: bool = True, broadcast_sources: int = BROADCAST_SOURCES
) -> DataFrame:
    """Rows of docs repeated to the target weights: all columns, `copy` (from 0) and `shuffle_key`."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names).select(F.col(names[docs.columns.index("doc_id")]).alias("doc_id"), F.col(names[docs.columns.index("source")]).alias("source"), F.struct(*names).alias("_row"))
    of = rates(docs.select("source"), weights, temperature).select(F.col("source").alias("_source"), F.round("rate", 12).alias("_rate"))
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    counted = _rated(own, of, broadcast_sources).select("_row", text_id.alias("_id"), poisson(F.col("_rate"), text_id, seed).alias("_count"))
    copies = counted.filter("_count > 0").withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)))
    keyed = copies.select("_row", "_copy", F.md5(F.concat_ws(":", F.lit(seed + 1), "_id", F.col("_copy")).cast("binary")).alias("_key"))
    if shuffled:  # rows of one id and copy have one key: the partition they come from deals them apart
        keyed = keyed.withColumn("_from", F.spark_partition_id()).repartition("_key", "_from").sortWithinPartitions("_key")
    out = [*docs.columns, *free_names(["copy", "shuffle_key"], docs.columns)]
    return keyed.select(*[F.col(f"_row.{n}") for n in names], "_copy", "_key").toDF(*out)


def report(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "lang", "source", "n_chars"))


def oracle(docs: str = "documents", temperature: float = TEMPERATURE, seed: int = SEED) -> str:
    """DuckDB SQL of the same rows (order aside)."""
    return f"""
with sizes as (select source, count(*) as n, pow(count(*)::double, {temperature}) as w from {docs} group by source),
whole as (select sum(n) as total, sum(w) as weight from sizes),
rate as (select source, round(w / weight * total / n, 12) as rate from sizes, whole),
r as (
  select d.*, row_number() over () as r, coalesce(d.doc_id::varchar, '') as k, rate, greatest(1, ceil(rate / {PART_MEAN}))::int as parts
  from {docs} d join rate on d.source is not distinct from rate.source),
part as (select *, unnest(range(1, parts + 1)) as part, rate / parts as mean from r),
u as (select *, ('0x' || substr(md5('{seed}:' || k || ':' || part), 1, 13))::bigint / {2.0**52} as u from part),
n as (
  select *, list_sum(list_transform(range(1, {TERMS} + 1), lambda t: case when u >= list_sum(list_transform(range(0, t),
     lambda j: exp(-mean) * pow(mean, j) / gamma(j + 1))) then 1 else 0 end))::int as n from u),
c as (select r, doc_id, text, lang, source, n_chars, k, sum(n)::int as n from n group by all)
select doc_id, text, lang, source, n_chars, copy, md5('{seed + 1}:' || k || ':' || copy) as shuffle_key
from (select *, unnest(range(0, n))::int as copy from c)
"""


ORACLE_SQL = oracle()
assert math.exp(-PART_MEAN) * PART_MEAN**TERMS / math.factorial(TERMS) < 1e-15
