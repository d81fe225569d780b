"""Reports for readers outside of Spark: collision rows and their summary, prompts for an audit, its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.operators import audit

#: Fields of a club's card, in order.
CARD = (
    "city", "county", "address", "phone", "phone_kind", "phone_e164", "email", "website", "fb_url", "ig_url", "x_url", "president", "stadium_name", "stadium_capacity", "founded_year", "lat", "lng",
)
#: Names of batches.
BATCHES = "ABCDEFGHIJ"


def collision_rows(judged: DataFrame, entities: DataFrame, carry: list[str]) -> DataFrame:
    """One row per (group, member) of judged groups, with the member's columns `carry` as texts, nulls as empty ones."""
    own = entities.select("id", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in carry])
    return judged.join(own, "id").select(F.concat_ws(":", "field", "key").alias("group_key"), "field", "key", "id", *carry, "score", "reasons", "verdict")


def write_collisions(rows: DataFrame, path: str) -> None:
    """CSV with a header, groups together, members by falling score; ranges of groups are files one after the other."""
    order = ["field", "key", F.desc("score"), "id"]
    rows.repartitionByRange("field", "key").sortWithinPartitions(*order).write.option("header", True).option("escape", '"').csv(path)


def collision_summary(judged: DataFrame, total: DataFrame) -> DataFrame:
    """One row: clubs_total, groups_total, rows, clubs_with_any_orphan, and by_field, a JSON object with a field's groups, verdicts and clubs that lose a value.

    What is gathered is one row per field.
    """
    fields = judged.groupBy("field").agg(
        F.countDistinct("key").alias("groups"), *[F.count_if(F.col("verdict") == v).alias(v) for v in ("owner", "orphan", "ambiguous")],
        F.countDistinct(F.when(F.col("verdict") == "orphan", F.col("id"))).alias("clubs_losing_value"),
    )
    each = F.struct("field", F.struct("groups", "owner", "orphan", "ambiguous", "clubs_losing_value").alias("found"))
    one = fields.agg(
        F.coalesce(F.sum("groups"), F.lit(0)).alias("groups_total"), F.coalesce(F.sum(F.col("owner") + F.col("orphan") + F.col("ambiguous")), F.lit(0)).alias("rows"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(each)))).alias("by_field"),
    )
    losers = judged.filter("verdict = 'orphan'").agg(F.countDistinct("id").alias("clubs_with_any_orphan"))
    parts = total.agg(F.count("*").alias("clubs_total")).unionByName(one, allowMissingColumns=True).unionByName(losers, allowMissingColumns=True)  # one row each
    return parts.agg(*[F.max(c).alias(c) for c in ("clubs_total", "groups_total", "rows", "clubs_with_any_orphan", "by_field")])


def _filled(c: Column) -> Column:
    text = c.cast("string")
    return F.when((text != "") & ~F.rlike(text, F.lit(r"^-?0(\.0+)?$")), text)


def card(clubs: DataFrame, leagues: str | None = None) -> Column:
    """A club's card: a head line of canonical_name, slug and tier, then a line for each field of CARD that the table has and that is neither null, empty nor zero."""
    head = F.format_string("CLUB: %s (slug=%s, tier=%s)", "canonical_name", "slug", F.col("tier").cast("string"))
    lines = [F.concat(F.lit(f"  {c}: "), _filled(F.col(c))) for c in CARD if c in clubs.columns]
    more = [F.concat(F.lit("  leagues: "), F.nullif(leagues, F.lit("")))] if leagues else []
    return F.concat_ws("\n", head, *lines, *more)


def batched(sample: DataFrame, n: int, *order: Column) -> DataFrame:
    """Add place and batch, a letter: the sample dealt round robin over n batches in its order."""
    if not 0 < n <= len(BATCHES):
        raise ValueError(f"1 to {len(BATCHES)} batches")
    return audit.numbered(sample, *order).withColumnRenamed("_place", "place").withColumn("batch", F.substring(F.lit(BATCHES), F.pmod("place", F.lit(n)) + 1, F.lit(1)))


def prompts(sample: DataFrame, intro: str, leagues: str | None = None) -> DataFrame:
    """(batch, prompt) of a batched sample: the introduction and the cards in their order. A row holds a batch, which the sample's size bounds."""
    cards = sample.select("batch", F.struct("place", card(sample, leagues).alias("card")).alias("c"))
    body = F.array_join(F.array_sort(F.collect_list("c")).getField("card"), "\n\n")
    return cards.groupBy("batch").agg(F.concat(F.lit(intro + "\n\n== CLUBS TO VERIFY ==\n\n"), body, F.lit("\n")).alias("prompt"))


def sample_meta(sample: DataFrame, seed: int, sizes: dict, n: int) -> DataFrame:
    """(meta): one JSON object with the seed, the strata, the number of batches and each sampled club's slug, tier and batch."""
    club = F.struct("place", F.struct("slug", "tier", "batch").alias("club"))
    strata = F.array(*[F.array(F.lit(t), F.lit(k)) for t, k in sizes.items()])
    found = sample.agg(F.array_sort(F.collect_list(club)).getField("club").alias("clubs"))
    return found.select(F.to_json(F.struct(F.lit(seed).alias("seed"), strata.alias("strata"), F.lit(n).alias("batches"), "clubs")).alias("meta"))


def report_lines(results: DataFrame, sample: DataFrame, dimensions: list[str], day: str) -> DataFrame:
    """(part, rank, slug, line) of an audit's report in Markdown, to be sorted by part, rank, slug.

    Results are (slug, overall, issues, one column of 0, 0.5, 1 or null per dimension). Part 1 is the head with the overall
    score, 2 a line per dimension with a star for each ten points, 3 a line per club, best first; a club outside of the sample has tier `?`.
    Without results the head alone is left.
    """
    head = results.agg(F.count("*").alias("n"), F.bround(F.avg("overall") * 100, 1).alias("score"))
    text = F.format_string(
        f"# Pipeline verification report — {day}\n\nSample size: **%s** clubs (stratified by tier)\n**Overall pipeline reliability: %s / 100**\n\n## Dimension scores\n\n| Dimension | Score | Stars |\n|---|---:|---|",
        F.col("n").cast("string"), F.coalesce(F.col("score").cast("string"), F.lit("n/a")),
    )
    first = head.select(F.lit(1).alias("part"), F.lit(0.0).alias("rank"), F.lit("").alias("slug"), text.alias("line"))
    place = F.array_position(F.array(*map(F.lit, dimensions)), F.col("dimension")).cast("double")
    pct = F.bround("pct", 1)
    row = F.when(pct.isNull(), F.concat(F.lit("| "), "dimension", F.lit(" | n/a | — |"))).otherwise(F.concat(F.lit("| "), "dimension", F.lit(" | "), pct.cast("string"), F.lit(" | "), F.expr("repeat('★', cast(bround(bround(pct, 1) / 10) as int))"), F.lit(" |")))
    second = audit.dimension_means(results, dimensions).select(F.lit(2).alias("part"), place.alias("rank"), F.lit("").alias("slug"), row.alias("line"))
    tier = F.coalesce(F.col("tier").cast("string"), F.lit("?"))
    line = F.concat(F.lit("| "), "slug", F.lit(" | T"), tier, F.lit(" | "), F.format_string("%.2f", "overall"), F.lit(" | "), F.coalesce(F.nullif("issues", F.lit("")), F.lit("—")), F.lit(" |"))
    third = results.join(sample.select("slug", "tier"), "slug", "left").select(F.lit(3).alias("part"), (F.lit(0.0) - F.col("overall")).alias("rank"), "slug", line.alias("line"))
    return first.unionAll(second).unionAll(third)
