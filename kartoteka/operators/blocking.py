"""Pairs of rows that may match, found through keys: q-grams, contained names, sets of shared words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.functions import fuzzy
from kartoteka.operators.resolve import _blocks


def grams(c: Column) -> Column:
    """Distinct pairs of neighbouring characters."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(2)))
    return F.array_distinct(F.filter(pairs, lambda g: F.length(g) == 2))


def partial_pairs(left: DataFrame, right: DataFrame, least: int = 80) -> DataFrame:
    """(l_id, r_id, score) of rows (id, name) whose partial ratio is at least `least`: an index of q-grams, then the exact score.

    A window of the longer name that scores r percent with a shorter name of m characters misses at most a share 1 - r / 100
    of both, and a missed character touches at most two of the name's grams. So at most `lost` grams of the
    shorter name are not in the longer one, and any lost + 1 of them hold one that is; the rarest are taken. Of
    the pairs that meet, those with enough grams in common are scored. Names so short that all grams may be lost
    meet by their characters. Ties and repeated rows are pairs of their own; null and empty names have no partner.
    """
    share = 1 - least / 100
    # Most grams lost, for windows of the name's length and for the shortest windows at an end.
    lost = F.floor(F.length("name") * max(3 * share, 4 * share / (1 + share)) + 1e-9).cast("int")
    side = lambda d: d.select("id", "name").filter("name <> ''").withColumns({"grams": grams(F.col("name")), "chars": F.array_distinct(F.split("name", "")), "size": F.length("name")})
    a, b = side(left), side(right)
    common = a.select(F.explode("grams").alias("g")).unionAll(b.select(F.explode("grams").alias("g"))).groupBy("g").agg(F.count("*").alias("df"))

    def probes(d: DataFrame) -> DataFrame:
        long = d.withColumn("lost", lost).filter(F.size("grams") > F.col("lost"))
        rare = long.select("id", "lost", F.explode("grams").alias("g")).join(common, "g").groupBy("id", "lost").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("by"))
        by_gram = rare.select("id", F.explode(F.slice("by", 1, F.col("lost") + 1)).alias("k")).select("id", F.concat(F.lit("2"), "k.g").alias("_key"))
        by_char = d.withColumn("lost", lost).filter(F.size("grams") <= F.col("lost")).select("id", F.explode("chars").alias("k")).select("id", F.concat(F.lit("1"), "k").alias("_key"))
        return by_gram.unionAll(by_char)

    def keys(d: DataFrame) -> DataFrame:
        return d.select("id", F.explode(F.concat(F.transform("grams", lambda g: F.concat(F.lit("2"), g)), F.transform("chars", lambda c: F.concat(F.lit("1"), c)))).alias("_key"))

    named = lambda d, n: d.select(F.col("id").alias(f"{n}_id"), "_key")
    met = _blocks(named(probes(a), "l"), named(keys(b), "r")).select("l_id", "r_id").unionAll(_blocks(named(keys(a), "l"), named(probes(b), "r")).select("l_id", "r_id")).distinct()
    full = lambda d, n: d.withColumn("lost", lost).select(*[F.col(c).alias(f"{n}_{c}") for c in ("id", "name", "grams", "size", "lost")])
    pairs = met.join(full(a, "l"), "l_id").join(full(b, "r"), "r_id")
    own, other = F.size("l_grams") - F.col("l_lost"), F.size("r_grams") - F.col("r_lost")
    need = F.when(F.col("l_size") < F.col("r_size"), own).when(F.col("l_size") > F.col("r_size"), other).otherwise(F.least(own, other))
    near = pairs.filter(F.size(F.array_intersect("l_grams", "r_grams")) >= need)
    return near.withColumn("score", fuzzy.partial_ratio("l_name", "r_name")).filter(F.col("score") >= least - 1e-9).select("l_id", "r_id", "score")


def contained_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b) of distinct non-empty texts a of left (a) and b of right (b) of which one is inside the other: the longer one's substrings are keys."""
    x, y = left.select("a").filter("a <> ''").distinct(), right.select("b").filter("b <> ''").distinct()
    parts = lambda c: F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.transform(F.sequence(F.lit(1), F.length(c) - i + 1), lambda n: F.substr(c, i, n))))))
    inside = x.select("a", parts(F.col("a")).alias("b")).join(y, "b").select("a", "b")
    return inside.unionAll(y.select("b", parts(F.col("b")).alias("a")).join(x, "a").select("a", "b")).distinct()


def word_sets(words: str) -> Column:
    """Structs (level, key): every set of one, two and three of the sorted distinct words of an array column."""
    w = f"array_sort({words})"
    one = f"transform({w}, x -> struct(1 as level, x as key))"
    two = f"flatten(transform({w}, (x, i) -> transform(slice({w}, i + 2, size({w})), y -> struct(2 as level, concat(x, ' ', y) as key))))"
    three = f"flatten(transform({w}, (x, i) -> flatten(transform(slice({w}, i + 2, size({w})), (y, j) -> transform(slice({w}, i + j + 3, size({w})), z -> struct(3 as level, concat(x, ' ', y, ' ', z) as key))))))"
    return F.expr(f"concat({one}, {two}, {three})")
