"""Entity resolution: collision groups, owner scores, verdicts, blocking, distances.

Groups may be large, so sizes and token counts are aggregates joined back, not windows over a whole group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.functions import contact, place, text, url
from kartoteka.operators.coverage import top_k
from kartoteka.operators.shared import stored

# Points of evidence.
VALUE_TOKEN, WEAK_TOKEN, REGISTRY, SOLE_PLAIN, SOURCE, COHORT = 5, 1, 4, 3, 2, 3
GROUP = ["field", "key"]
#: Rows of one key on one side that one task may join.
BLOCK = 5000
#: Identity fields: normal form, and whether a name can stand inside of the value.
FIELDS = {
    "phone": (lambda: contact.e164(F.col("phone")), False),
    "email": (lambda: contact.norm_email(F.col("email")), True),
    "website": (lambda: url.norm_domain(F.col("website")), True),
    "phone_e164": (lambda: contact.e164(F.col("phone_e164")), False),
    "fb_url": (lambda: url.social_slug(F.col("fb_url"), "facebook.com"), True),
    "ig_url": (lambda: url.social_slug(F.col("ig_url"), "instagram.com"), True),
    "oib": (lambda: contact.norm_oib(F.col("oib")), False),
    "address": (lambda: place.norm_address(F.col("address")), True),
    "latlng": (lambda: place.norm_latlng(F.col("lat"), F.col("lng")), False),
}


def groups(entities: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """(field, key, matchable, and all entity columns) of entities that share a normalized value."""
    chosen = fields or [f for f in FIELDS if f in entities.columns or f == "latlng" and "lat" in entities.columns]
    keys = F.array(*[F.struct(F.lit(f).alias("field"), FIELDS[f][0]().alias("key"), F.lit(FIELDS[f][1]).alias("matchable")) for f in chosen])
    long = entities.withColumn("_k", F.explode(keys)).select("_k.*", *entities.columns).filter("key is not null")
    shared = long.groupBy(*GROUP).agg(F.count("*").alias("size")).filter("size > 1")
    return long.join(shared, GROUP)


def scores(found: DataFrame) -> DataFrame:
    """(field, key, id, size, score, reasons): evidence that a member owns the shared value, and what it is made of."""
    member = found.select(
        *GROUP, "matchable", "id", "size", text.club_tokens(F.col("canonical_name"), F.col("city")).alias("words"), text.tokens(F.col("registry_naziv")).alias("registry"),
        (~text.has_paren(F.col("canonical_name"))).alias("plain"), F.col("semafor_url").isNotNull().alias("sourced"), text.alnum(F.col("key")).alias("probe"),
    )
    word = member.select(*GROUP, "id", "size", "matchable", "probe", "registry", F.explode("words").alias("word"))
    word = word.withColumn("inside", F.col("matchable") & F.expr("contains(probe, word)"))
    claims = word.groupBy(*GROUP, "word").agg(F.count("*").alias("holders"))
    own = word.join(claims, [*GROUP, "word"]).filter("holders < size")  # words of all members tell nothing
    evidence = own.groupBy(*GROUP, "id").agg(
        F.max(F.col("inside") & (F.col("holders") == 1)).alias("unique"), F.max("inside").alias("weak"), F.max(F.expr("array_contains(registry, word)")).alias("registered")
    )
    plain = member.groupBy(*GROUP).agg(F.count_if("plain").alias("plains"))
    joined = member.join(evidence, [*GROUP, "id"], "left").join(plain, GROUP)
    points = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    score = (
        F.when(F.coalesce("unique", F.lit(False)), VALUE_TOKEN).otherwise(points(F.col("weak"), WEAK_TOKEN))
        + points(F.col("registered"), REGISTRY) + points(F.col("plain") & (F.col("plains") == 1), SOLE_PLAIN) + points(F.col("sourced"), SOURCE)
    )
    is_true = lambda c: F.coalesce(c, F.lit(False))
    reasons = F.concat_ws(
        "; ", F.when(is_true(F.col("unique")), f"+{VALUE_TOKEN} unique word in value").when(is_true(F.col("weak")), f"+{WEAK_TOKEN} word in value"), F.when(is_true(F.col("registered")), f"+{REGISTRY} registry name"),
        F.when(is_true(F.col("plain") & (F.col("plains") == 1)), f"+{SOLE_PLAIN} sole plain name"), F.when(is_true(F.col("sourced")), f"+{SOURCE} independent source"),
    )
    return joined.select(*GROUP, "id", "size", score.alias("score"), reasons.alias("reasons"))


def verdicts(scored: DataFrame) -> DataFrame:
    """Add verdict: a strict, positive maximum owns; the rest are orphans; else all are ambiguous."""
    best = scored.groupBy(*GROUP).agg(F.max("score").alias("top"))
    tied = scored.join(best, GROUP).groupBy(*GROUP).agg(F.max("top").alias("top"), F.count_if(F.col("score") == F.col("top")).alias("tops"))
    settled = (F.col("top") > 0) & (F.col("tops") == 1)
    judged = F.when(~settled, "ambiguous").when(F.col("score") == F.col("top"), "owner").otherwise("orphan")
    return scored.join(tied, GROUP).withColumn("verdict", judged).drop("top", "tops")


def with_cohorts(scored: DataFrame) -> DataFrame:
    """Owners of one group get COHORT points in groups of exactly the same members that they did not win; the reason is added to theirs."""
    members = scored.groupBy(*GROUP).agg(F.bit_xor(F.xxhash64("id")).alias("who"), F.sum(F.xxhash64("id", F.lit(1)).cast("decimal(38,0)")).alias("check"), F.count("*").alias("n"))
    first = verdicts(scored).join(members, GROUP)
    cohort = ["who", "check", "n"]
    owners = first.filter("verdict = 'owner'").select(*cohort, "id").distinct().withColumn("owns", F.lit(True))
    bonus = first.join(owners, [*cohort, "id"], "left")
    earned = F.col("owns") & (F.col("verdict") != "owner")
    why = F.concat_ws("; ", F.nullif("reasons", F.lit("")), F.when(earned, f"+{COHORT} owner among the same members"))
    return bonus.select(*GROUP, "id", "size", (F.col("score") + F.when(earned, COHORT).otherwise(0)).alias("score"), why.alias("reasons"))


def detect(entities: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """(field, key, id, size, score, reasons, verdict) of all collision groups. Scores are read several times over, so each round of them is written once."""
    first = stored(scores(stored(groups(entities, fields), "groups")), "scores")
    return verdicts(stored(with_cohorts(first), "scores"))


def summary(found: DataFrame) -> DataFrame:
    return found.groupBy("field").agg(
        F.countDistinct("key").alias("n_groups"),
        *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("owner", "orphan", "ambiguous")],
        F.countDistinct(F.when(F.col("verdict") == "orphan", F.col("id"))).alias("losers"),
    )


def _blocks(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a (l_id, ...) and b (r_id, ...) of one _key, joined. A key of many rows is dealt over a grid of blocks of some BLOCK rows a side."""
    sizes = [d.groupBy("_key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(n)) for d, n in ((a, "_nl"), (b, "_nr"))]
    grid = sizes[0].join(sizes[1], "_key")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda i, n: F.pmod(F.hash(i), F.col(n))
    a = a.join(grid, "_key").withColumn("_bl", own("l_id", "_nl")).withColumn("_br", every("_nr")).drop("_nl", "_nr")
    b = b.join(grid, "_key").withColumn("_br", own("r_id", "_nr")).withColumn("_bl", every("_nl")).drop("_nl", "_nr")
    return a.join(b, ["_key", "_bl", "_br"]).drop("_bl", "_br")


def kinds(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The distinct rows of these columns, numbered in a column `name`: equal rows are worked on once."""
    return stored(df.select(*columns).distinct().withColumn(name, F.monotonically_increasing_id()), "kinds")


def _sides(left: DataFrame, right: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For both sides of (id, words, city): rows (l_row, l_id) with the number of their kind, and kinds (l_id, l_words, l_city)."""
    out = []
    for d, n in ((left, "l"), (right, "r")):
        own = kinds(d, ["words", "city"], f"{n}_id")
        k = own.select(f"{n}_id", F.col("words").alias("_w"), F.col("city").alias("_c"))
        rows = d.join(k, F.col("words").eqNullSafe(F.col("_w")) & F.col("city").eqNullSafe(F.col("_c"))).select(F.col("id").alias(f"{n}_row"), f"{n}_id")
        out.append((rows, own.select(f"{n}_id", F.col("words").alias(f"{n}_words"), F.col("city").alias(f"{n}_city"))))
    return out


def _met(a: DataFrame, b: DataFrame, keep: Column | None) -> DataFrame:
    """Pairs of kinds that share a city or a word and fit `keep`: two equi-joins, each pair once, judged where it is made."""
    keep = F.lit(True) if keep is None else keep
    first = F.array_min(F.array_intersect(F.array_compact("l_words"), F.array_compact("r_words")))
    by_city = _blocks(a.withColumn("_key", F.col("l_city")), b.withColumn("_key", F.col("r_city"))).filter(first.isNull() & keep)
    words = lambda d, n: d.withColumn("_key", F.explode(F.array_distinct(F.array_compact(f"{n}_words"))))
    by_word = _blocks(words(a, "l"), words(b, "r")).filter((F.col("_key") == first) & keep)
    return by_city.unionByName(by_word, allowMissingColumns=True).drop("_key")


def candidates(left: DataFrame, right: DataFrame, keep: Column | None = None, apart: bool = False, **columns: Column) -> DataFrame:
    """Pairs (l_id, r_id, and `columns`) of (id, words, city) rows that share a city or a word and fit `keep`; rows of one id make no pair if `apart`.

    `keep` and `columns` are of l_words, l_city, r_words and r_city. Rows of equal words and city are one kind: a pair of kinds is made
    by its first shared word, or by its city if it shares no word, and judged and scored once; only pairs that stay get their rows.
    """
    (l_rows, a), (r_rows, b) = _sides(left, right)
    near = stored(_met(a, b, keep).select("l_id", "r_id", *[c.alias(n) for n, c in columns.items()]), "kind_pairs")
    one = near.join(l_rows, "l_id").select(F.col("l_row").alias("l_id"), F.col("r_id").alias("_key"), *columns)
    pairs = _blocks(one, r_rows.select(F.col("r_id").alias("_key"), F.col("r_row").alias("r_id")))
    pairs = pairs.filter(F.col("l_id") != F.col("r_id")) if apart else pairs
    return pairs.select("l_id", "r_id", *columns)


def best_two(left: DataFrame, right: DataFrame, keep: Column, score: Column) -> DataFrame:
    """The two best rows of right for each row of left: (l_id, r_id, score) of the pairs that `candidates` would give, apart, by score and then r_id.

    Of a kind no more than three rows are needed, one of which may be the row itself; so no kind is spread out.
    """
    (l_rows, a), (r_rows, b) = _sides(left, right)
    near = _met(a, b, keep).select("l_id", "r_id", score.alias("score"))
    order = (F.desc("score"), "r_row")
    few = top_k(r_rows, ["r_id"], 3, "r_row").groupBy("r_id").agg(F.array_sort(F.collect_list("r_row")).alias("rows"))
    # Kinds by their best row first: three kinds of a score hold the three best rows of that score.
    best = near.join(few.withColumn("r_row", F.get("rows", F.lit(0))), "r_id")
    best = top_k(best.select("l_id", "rows", "score", "r_row"), ["l_id"], 3, *order).select("l_id", "score", F.explode("rows").alias("r_row"))
    best = top_k(best, ["l_id"], 3, *order)
    pairs = l_rows.join(best, "l_id").filter(F.col("l_row") != F.col("r_row")).select(F.col("l_row").alias("l_id"), F.col("r_row").alias("r_id"), "score")
    return top_k(pairs, ["l_id"], 2, F.desc("score"), "r_id")


def overlap_score() -> Column:
    """Shared words, half a point for a shared city, half for either side being a subset; .3 for two empty names."""
    shared = F.size(F.array_intersect("l_words", "r_words"))
    subset = lambda x, y: F.when(F.size(F.array_except(x, y)) == 0, 0.5).otherwise(0.0)
    city = F.when(F.col("l_city") == F.col("r_city"), 0.5).otherwise(0.0)
    empty = (F.size("l_words") == 0) & (F.size("r_words") == 0)
    return F.when(empty, 0.3 + city).otherwise(shared + city + F.when(shared > 0, subset("l_words", "r_words") + subset("r_words", "l_words")).otherwise(0.0))


def similarity(a: Column, b: Column) -> Column:
    """Edit-distance ratio from 0 to 100; no fuzzy library is at hand, so thresholds are not those of another scorer."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 100.0).otherwise(100.0 * (1 - F.levenshtein(a, b) / longest))


def accepted(same_city: Column, score: Column, active: Column) -> Column:
    """Confidence of a match, or null."""
    return (
        F.when(same_city & (score >= 90), "high").when(same_city & (score >= 80), "medium").when(score >= 88, "medium").when(same_city & (score >= 70) & active, "low")
    )


def nearest(points: DataFrame, targets: DataFrame, most_m: float) -> DataFrame:
    """The nearest target of each point within most_m metres: (id, target_id, metres).

    Cells are as wide as the radius (in longitude at the latitude farthest from the equator), so a point meets the targets of
    its own cell alone: the targets, the smaller side, are dealt to their neighbours' cells as well.
    """
    far = F.greatest(F.max(F.abs("lat")), F.lit(0.0))
    lat = max([x[0] or 0.0 for x in (points.agg(far).first(), targets.agg(far).first())])
    high = most_m / 111_000.0 + 1e-9
    wide = high / max(math.cos(math.radians(min(lat + high, 89.0))), 0.01)
    t = targets.select(F.col("id").alias("target_id"), F.col("lat").alias("t_lat"), F.col("lng").alias("t_lng"))
    cells = F.explode(F.array(*[F.struct((F.floor(F.col("t_lat") / high) + y).alias("gy"), (F.floor(F.col("t_lng") / wide) + x).alias("gx")) for y in (-1, 0, 1) for x in (-1, 0, 1)]))
    t = t.withColumn("o", cells).select("target_id", "t_lat", "t_lng", "o.*")
    p = points.select("id", "lat", "lng").withColumns({"gy": F.floor(F.col("lat") / high), "gx": F.floor(F.col("lng") / wide)})
    near = p.join(t, ["gy", "gx"]).withColumn("metres", place.haversine_m(F.col("lat"), F.col("lng"), F.col("t_lat"), F.col("t_lng"))).filter(F.col("metres") <= most_m)
    return near.groupBy("id").agg(F.min(F.struct("metres", "target_id")).alias("m")).select("id", "m.target_id", "m.metres")


def place_evidence(specific: Column, found: Column, county: Column, codes: Column) -> Column:
    """Whether a source names a place that fits an entity: struct of ok and reason, from specific to coarse evidence."""
    stem = F.exists(text.place_tokens(county), lambda c: F.exists(found, lambda f: text.prefix_match(c, f)))
    out = lambda ok, why: F.struct(F.lit(ok).alias("ok"), F.lit(why).alias("reason"))
    return (
        F.when(F.size(found) == 0, out(False, "no place"))
        .when((F.size(specific) > 0) & F.arrays_overlap(specific, found), out(True, "specific place"))
        .when(F.size(specific) > 0, out(False, "another place"))
        .when(F.coalesce(county, F.lit("")) == "", out(False, "no signal"))
        .when((F.size(codes) > 0) & F.exists(codes, lambda c: place.counties_compatible(county, c)), out(True, "postcode"))
        .when(F.size(codes) > 0, out(False, "postcode elsewhere"))
        .when(stem, out(True, "county stem"))
        .otherwise(out(False, "county not named"))
    )


def namesake_ambiguous(results: DataFrame) -> DataFrame:
    """(id, ambiguous) of search results (id, canonical_name, domain, score): a bracketed name with two own domains within two points of the best."""
    best = results.groupBy("id", "canonical_name", "domain").agg(F.max("score").alias("score"))
    top = best.groupBy("id").agg(F.max("score").alias("top"))
    close = best.join(top, "id").filter(F.col("score") >= F.col("top") - 2)
    return close.groupBy("id").agg((F.max(text.has_paren(F.col("canonical_name"))) & (F.count("*") > 1)).alias("ambiguous"))


def pitch_truth(t1: str, m1: str, t2: str, m2: str) -> Column:
    """Which of two geocodes is nearer to its nearest pitch; one pitch at almost equal distances is a tie."""
    tie = (F.col(t1) == F.col(t2)) & (F.abs(F.col(m1) - F.col(m2)) < 50)
    return (
        F.when(tie, "tie").when(F.col(m1).isNull() & F.col(m2).isNull(), "unverified").when(F.col(m2).isNull() | (F.col(m1) <= F.col(m2)), "first").otherwise("second")
    )
