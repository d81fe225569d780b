"""Matching clubs with a registry, pages and geocoders, as staged joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kartoteka.functions import clubs as names
from kartoteka.functions import fuzzy, place
from kartoteka.functions.text import fold, has_paren
from kartoteka.operators.blocking import contained_pairs, partial_pairs, word_sets
from kartoteka.operators.coverage import top_k
from kartoteka.operators.resolve import _blocks, accepted, kinds, similarity
from kartoteka.operators.shared import stored


def _forms(df: DataFrame, name: str) -> DataFrame:
    norm = names.registry_norm(F.col(name))
    return df.withColumn("norm", norm).withColumn("short", names.registry_short(F.col("norm")))


def prepared_clubs(clubs: DataFrame) -> DataFrame:
    """(l_id, l_norm, l_short, l_words, l_city_words, l_place, l_county, l_city_only, l_distinct, ...) of (id, name, city, county)."""
    df = _forms(clubs.select("id", "name", "city", "county"), "name").withColumn("words", names.generic_free(names.words_of(F.col("short"))))
    own, parts = names.words_of(fold(F.col("city"))), F.split("short", " ")
    df = df.withColumn("city_words", F.when(F.size(own) > 0, own).when(F.size(parts) >= 2, F.array(F.element_at(parts, -1))).otherwise(own))
    df = df.withColumn("distinct", F.array_except("words", "city_words")).withColumn("city_only", F.size("distinct") == 0)
    df = df.withColumns({"all_words": names.words_of(F.col("short")), "place": fold(F.col("city")), "county": names.county_group(F.col("county"))})
    return df.select(*[F.col(c).alias(f"l_{c}") for c in df.columns])


def prepared_registry(registry: DataFrame) -> DataFrame:
    """(r_id, r_norm, r_short, r_words, r_clean, r_place, ...) of (id, naziv, seat, county, status), football rows only."""
    df = _forms(registry.select("id", "naziv", "seat", "county", "status"), "naziv").filter(names.registry_kept(F.col("norm")))
    df = df.withColumn("words", names.words_of(F.col("short")))
    df = df.withColumns({"clean": names.generic_free(F.col("words")), "place": names.seat_place(F.col("seat")), "county": names.county_group(F.col("county")), "rank": names.status_rank(F.col("status"))})
    return df.select(*[F.col(c).alias(f"r_{c}") for c in df.columns])


def registry_pairs(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """(l_id, r_id, city): pairs of prepared rows that hold the best `most` of each club by (city, shared words), and all ties of these.

    Keys are sets of one to three words within a county and, first, within the seats that fit the club's city. The
    registry's rows are counted by key (a row with `r_n` stands for so many). A club whose sets of three words find enough rows asks for these alone, else for sets
    of two, else for single words; only where its city has not enough rows does it ask the whole county. So a hot word
    is joined by those clubs alone that have nothing rarer. A club named after its city meets rows whose words are in the
    city's name, by their first word and their number; rows with generic words alone by a q-gram index of their names.
    """
    scopes = lambda place: F.explode(F.array(F.lit("*"), place))
    counties = F.explode(F.array(F.lit("*"), F.col("r_county")))
    whole = F.when(F.size("r_clean") > 0, F.array(F.struct(F.lit(0).alias("level"), F.concat(F.lit("="), F.array_min("r_clean"), F.lit("="), F.size("r_clean")).alias("key"))))
    keyed = b.withColumn("r_n", F.col("r_n") if "r_n" in b.columns else F.lit(1)).withColumn("county", counties).withColumn("scope", scopes(F.col("r_place"))).select("r_id", "r_n", "county", "scope", F.explode(F.concat(word_sets("r_clean"), F.coalesce(whole, F.array().cast("array<struct<level:int,key:string>>")))).alias("k"))
    index = stored(keyed.select("r_id", "r_n", F.concat_ws("|", "county", "scope", "k.key").alias("_key")), "registry_keys")

    fits = contained_pairs(a.select(F.col("l_place").alias("a")), b.select(F.col("r_place").alias("b")))
    probe = F.when(F.col("l_city_only"), F.flatten(F.transform("l_city_words", lambda w: F.transform(F.sequence(F.lit(1), F.size("l_city_words")), lambda n: F.struct(F.lit(0).alias("level"), F.concat(F.lit("="), w, F.lit("="), n).alias("key")))))).otherwise(word_sets("l_distinct"))
    asked = a.withColumn("county", F.explode(F.when(F.col("l_county") == "", F.array(F.lit("*"))).otherwise(F.array("l_county", F.lit("")))))
    asked = asked.join(fits.groupBy(F.col("a").alias("l_place")).agg(F.collect_set("b").alias("seats")), "l_place", "left")
    asked = asked.withColumn("scope", F.explode(F.concat(F.array(F.lit("*")), F.coalesce("seats", F.array().cast("array<string>"))))).select("l_id", "l_city_only", "county", "scope", F.explode(probe).alias("k"))
    asked = asked.select("l_id", (F.col("scope") != "*").alias("near"), "k.level", F.concat_ws("|", "county", "scope", "k.key").alias("_key")).distinct()

    counted = stored(asked.join(index.groupBy("_key").agg(F.sum("r_n").alias("n")), "_key"), "club_keys")
    enough = lambda near: F.max(F.when((F.col("near") == near) & (F.col("n") >= most) & (F.col("level") > 0), F.col("level")))
    levels = counted.groupBy("l_id").agg(enough(True).alias("near_level"), enough(False).alias("far_level"))
    least = F.when(F.col("near"), F.coalesce("near_level", F.lit(0))).when(F.col("near_level").isNull(), F.coalesce("far_level", F.lit(0)))
    exact = F.when(least > 0, F.col("level") == least).otherwise(F.col("level") <= 1)
    wanted = counted.join(levels, "l_id").filter(least.isNotNull() & exact).select("l_id", "_key")
    met = _blocks(wanted, index.drop("r_n")).select("l_id", "r_id").distinct()
    # A club named after its city and a row of generic words alone share a word or most of their characters.
    bare = b.filter(F.size("r_clean") == 0)
    if not bare.isEmpty():
        lone = a.filter("l_city_only")
        by_word = _blocks(lone.select("l_id", F.explode("l_city_words").alias("_key")), bare.select("r_id", F.explode("r_words").alias("_key"))).select("l_id", "r_id")
        alike = partial_pairs(lone.select(F.col("l_id").alias("id"), F.col("l_short").alias("name")), bare.select(F.col("r_id").alias("id"), F.col("r_short").alias("name"))).select("l_id", "r_id")
        met = met.unionAll(by_word).unionAll(alike).distinct()

    own = a.select("l_id", "l_county", "l_place", "l_city_only", "l_city_words", "l_distinct")
    other = b.select("r_id", "r_county", "r_place", "r_clean")
    gate = (F.col("l_county") == "") | (F.col("r_county") == "") | (F.col("l_county") == F.col("r_county"))
    telling = F.when(F.col("l_city_only"), F.size(F.array_except("r_clean", "l_city_words")) == 0).otherwise(F.size(F.array_intersect("l_distinct", "r_clean")) > 0)
    city = (F.col("l_place") != "") & (F.col("r_place") != "") & (F.col("l_place").contains(F.col("r_place")) | F.col("r_place").contains(F.col("l_place")))
    return met.join(own, "l_id").join(other, "r_id").filter(gate & telling).select("l_id", "r_id", city.cast("int").alias("city"))


def edit_score() -> Column:
    """The best of edit ratios of full and short forms and of shared words."""
    dice = 200.0 * F.size(F.array_intersect("l_all_words", "r_words")) / (F.size("l_all_words") + F.size("r_words"))
    return F.greatest(similarity(F.col("l_norm"), F.col("r_norm")), similarity(F.col("l_short"), F.col("r_short")), F.coalesce(dice, F.lit(0.0)))


def weighted_score() -> Column:
    """The best of weighted ratios of full and short forms and of the token-set ratio of short forms."""
    return F.greatest(fuzzy.weighted_ratio("l_norm", "r_norm"), fuzzy.weighted_ratio("l_short", "r_short"), fuzzy.token_set_ratio("l_short", "r_short"))


def registry_match(clubs: DataFrame, registry: DataFrame, most: int = 5, score=edit_score) -> DataFrame:
    """The best `most` registry rows of each club: (id, registry_id, place, score, city, status, overlap, confidence).

    The county is a hard gate; a distinctive word of the club must be in the registry's name, or, for a club named after
    its city alone, the registry's name must have no other word. Rank: city, overlap, status, score, registry id. Forms
    and words are worked out once for each row, equal rows are matched once, and names are scored only where city, overlap
    and status leave a tie that reaches the first `most`.
    """
    a, b = stored(prepared_clubs(clubs), "clubs"), stored(prepared_registry(registry), "registry")
    # Clubs of one form of name, city and county share their rows; forms that differ in their prefix alone share the search, too.
    form, profile = ["l_norm", "l_place", "l_county"], ["l_short", "l_place", "l_county"]
    own = stored(a.dropDuplicates(profile).withColumn("l_id", F.monotonically_increasing_id()), "profiles")
    forms = a.dropDuplicates(form).select("l_norm", "l_all_words", *profile).join(own.select("l_id", *profile), profile)
    forms = stored(forms.withColumn("l_form", F.monotonically_increasing_id()), "forms")
    # Equal registry rows are told apart by their ids alone, of which the first `most` count.
    same = ["r_norm", "r_place", "r_county", "r_rank"]
    first = [F.first(c).alias(c) for c in ("r_short", "r_words", "r_clean")]
    rows = top_k(b, same, most, "r_id").groupBy(*same).agg(F.array_sort(F.collect_list("r_id")).alias("r_ids"), *first)
    rows = stored(rows.withColumns({"r_id": F.monotonically_increasing_id(), "r_n": F.size("r_ids").cast("long")}), "registry_kinds")

    pairs = registry_pairs(own, rows, most).join(own, "l_id").join(rows, "r_id")
    overlap = F.size(F.array_intersect(F.when(F.col("l_city_only"), F.col("l_words")).otherwise(F.col("l_distinct")), "r_clean"))
    known = pairs.select("l_id", "r_id", "r_n", "city", F.col("r_rank").alias("status"), overlap.alias("overlap"))
    # City, overlap and status (0 to 3) as one number: rows of a higher number go first.
    level = F.col("city") * (1 << 40) + F.col("overlap") * 4 + F.col("status")
    before = Window.partitionBy("l_id").orderBy(F.desc("level")).rangeBetween(Window.unboundedPreceding, -1)
    tied = known.withColumn("level", level).withColumn("ahead", F.coalesce(F.sum("r_n").over(before), F.lit(0))).filter(F.col("ahead") < most)
    tied = stored(tied.select("l_id", "r_id", "city", "status", "overlap"), "tied")

    named = tied.join(forms.select("l_id", "l_form", "l_norm", "l_short", "l_all_words"), "l_id").join(rows.select("r_id", "r_ids", "r_norm", "r_short", "r_words"), "r_id")
    # Norms make short forms and words, so a pair of norms is scored once.
    texts = named.select("l_norm", "l_short", "l_all_words", "r_norm", "r_short", "r_words").dropDuplicates(["l_norm", "r_norm"])
    texts = stored(texts.withColumn("score", F.round(score(), 6)).select("l_norm", "r_norm", "score"), "name_scores")
    scored = named.join(texts, ["l_norm", "r_norm"]).select("l_form", "score", "city", "status", "overlap", F.explode("r_ids").alias("registry_id"))
    order = [F.desc("city"), F.desc("overlap"), F.desc("status"), F.desc("score"), "registry_id"]
    ranked = scored.withColumn("place", F.row_number().over(Window.partitionBy("l_form").orderBy(*order))).filter(F.col("place") <= most)
    ranked = ranked.join(forms.select("l_form", *form), "l_form").withColumn("confidence", accepted(F.col("city") == 1, F.col("score"), F.col("status") == 3))
    told = a.select(F.col("l_id").alias("id"), *form).join(ranked, form)
    return told.select("id", "registry_id", "score", "city", "status", "overlap", "place", "confidence")


def match_lists(clubs: DataFrame, matched: DataFrame) -> DataFrame:
    """(id, part, candidates) of all clubs and their up to five registry rows: matched with the row taken, low_conf with all of them in order, nomatch with none."""
    rows = matched.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "registry_id"))).alias("c"), F.max(F.when(F.col("place") == 1, F.col("confidence"))).alias("best"))
    ids = lambda c: F.array_join(F.transform(c, lambda x: x.registry_id.cast("string")), ",")
    part = F.when(F.col("c").isNull(), "nomatch").when(F.col("best").isNull(), "low_conf").otherwise("matched")
    taken = F.when(part == "matched", ids(F.slice("c", 1, 1))).when(part == "low_conf", ids(F.col("c"))).otherwise("")
    return clubs.select("id").join(rows, "id", "left").select("id", part.alias("part"), taken.alias("candidates"))


def unique_by_city(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l_id, r_id) of rows (id, city, words) whose city has exactly one partner with no word of either side missing on the other.

    Rows of equal city and words are one kind with a count and its smallest id. The smaller of two sets of words is asked for
    by its two words that are rarest among all kinds, the larger one is found by all its sets of one or two words.
    """
    sides, weights = [], None
    for d, n in ((left, "l"), (right, "r")):
        # Stored before the filter, which would work out the words once more.
        named = stored(d.select(F.col("id").alias(f"{n}_row"), "city", F.array_sort(F.array_distinct(F.array_compact("words"))).alias("words")), "words").filter("city is not null and size(words) > 0")
        own = stored(named.groupBy("city", "words").agg(F.count("*").alias("n"), F.min(f"{n}_row").alias("one")).withColumn(f"{n}_id", F.monotonically_increasing_id()), "kinds")
        sides.append((named, own))
        found = own.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("df"))
        weights = found if weights is None else weights.unionAll(found).groupBy("w").agg(F.sum("df").alias("df"))
    (rows, a), (_, b) = sides

    def asked(own: DataFrame, n: str) -> DataFrame:
        rare = own.select(f"{n}_id", "city", F.explode("words").alias("w")).join(weights, "w").groupBy(f"{n}_id", "city").agg(F.slice(F.array_sort(F.collect_list(F.struct("df", "w"))), 1, 2).alias("k"))
        return rare.select(f"{n}_id", F.concat_ws("|", "city", F.array_join(F.array_sort("k.w"), " ")).alias("_key"))

    def held(own: DataFrame, n: str) -> DataFrame:
        return own.select(f"{n}_id", "city", F.explode(F.filter(word_sets("words"), lambda k: k.level <= 2)).alias("k")).select(f"{n}_id", F.concat_ws("|", "city", "k.key").alias("_key"))

    def inside(small: str, large: str, strictly: bool) -> DataFrame:
        """Pairs of kinds whose `small` set is in the other."""
        x, y = (asked(o, n) if n == small else held(o, n) for n, o in (("l", a), ("r", b)))
        met = _blocks(x, y).select("l_id", "r_id")
        for n, o in (("l", a), ("r", b)):
            met = met.join(o.select(f"{n}_id", F.col("words").alias(f"{n}_words"), *([F.col("n"), F.col("one")] if n == "r" else [])), f"{n}_id")
        subset = F.size(F.array_except(f"{small}_words", f"{large}_words")) == 0
        return met.filter(subset & (F.size(f"{small}_words") < F.size(f"{large}_words")) if strictly else subset).select("l_id", "n", "one")

    met = inside("l", "r", False).unionAll(inside("r", "l", True))
    one = met.groupBy("l_id").agg(F.min("one").alias("r_id"), F.sum("n").alias("n")).filter("n = 1")
    told = a.join(one.select("l_id", "r_id"), "l_id").select("city", "words", "r_id")
    return rows.join(told, ["city", "words"]).select(F.col("l_row").alias("l_id"), "r_id")


def one_to_one(pages: DataFrame, clubs: DataFrame) -> DataFrame:
    """(page_id, club_id, status) of pages (id, name, city) against clubs (id, name, city): matched, ambiguous or no_name_hit.

    What a walk over the pages by id gives: a page takes the one club left of its name and city, or the only club left of
    its name where one side has no city; a club that is taken is gone for later pages. The walk is worked out by
    aggregates, so a name of many clubs and pages is no group in one task:

    - A city with several clubs of a name never comes down to one. A city with one club gives it to its first page.
    - One club of a name is left over when all others have gone to the first pages of their cities. After the last of
      these, it goes to the next page that has its city, has none, or any page if the club has none.

    Rows that repeat an id are one; a null or empty name hits nothing; cities '' are unknown.
    """
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    p = pages.groupBy(F.col("id").alias("page_id")).agg(F.first(F.struct(blank("name").alias("name"), blank("city").alias("city"))).alias("v")).select("page_id", "v.*")
    c = clubs.groupBy(F.col("id").alias("club_id")).agg(F.first(F.struct(blank("name").alias("name"), blank("city").alias("city"))).alias("v")).select("club_id", "v.*").filter("name is not null")
    p, c = stored(p, "pages"), stored(c, "clubs")
    towns = c.groupBy("name", "city").agg(F.count("*").alias("n"), F.min("club_id").alias("club_id"))
    first = p.filter("name is not null and city is not null").groupBy("name", "city").agg(F.min("page_id").alias("page_id"))
    lone = stored(towns.filter("n = 1 or city is null").join(first, ["name", "city"], "left"), "lone_towns")
    # Of a name whose clubs are lone ones and at most one without a city: the club that is left over, and the page that settles the last of the others.
    names_ = towns.groupBy("name").agg(F.count_if((F.col("n") > 1)).alias("thick"))
    never = F.lit((1 << 63) - 1)
    when = F.when(F.col("city").isNull(), never).otherwise(F.coalesce("page_id", never - 1))
    over = lone.join(names_.filter("thick = 0").select("name"), "name").withColumn("at", when)
    rest = over.groupBy("name").agg(F.max_by(F.struct("club_id", "city", "page_id"), F.struct("at", "club_id")).alias("x"), F.count("*").alias("m"))
    others = over.join(rest.select("name", "x"), "name").filter(~F.col("club_id").eqNullSafe(F.col("x.club_id"))).groupBy("name").agg(F.max("at").alias("settled"))
    rest = rest.join(others, "name", "left").withColumn("settled", F.coalesce("settled", F.lit(-(1 << 63)))).filter(F.col("settled") < never - 1)
    late = p.join(rest.select("name", F.col("x.club_id").alias("club_id"), F.col("x.city").alias("town"), "settled"), "name").filter(F.col("page_id") > F.col("settled"))
    late = late.filter(F.col("town").isNull() | F.col("city").isNull() | (F.col("city") == F.col("town"))).groupBy("name").agg(F.min("page_id").alias("page_id"), F.min("club_id").alias("club_id"))
    by_town = lone.filter("city is not null and page_id is not null").select("page_id", "club_id")
    # A club that is left over goes to the earlier of its two pages.
    taken = by_town.unionByName(late.select("page_id", "club_id")).groupBy("club_id").agg(F.min("page_id").alias("page_id"))
    known = c.select("name").distinct().withColumn("hit", F.lit(True))
    j = p.join(known, "name", "left").join(taken, "page_id", "left")
    status = F.when(F.col("hit").isNull(), "no_name_hit").when(F.col("club_id").isNotNull(), "matched").otherwise("ambiguous")
    return j.select("page_id", "club_id", status.alias("status"))


def substring_partners(rows: DataFrame, key: str, name: str, *by: str) -> DataFrame:
    """(key) of the rows that have another row with equal `by` whose name is inside theirs or holds it.

    Names that contain each other are found among the distinct names; rows then meet counts of (by, name), never each other, so
    a group of any size makes no pairs. Rows that repeat a key count apart; null names and groups have no partner.
    """
    counts = rows.groupBy(*by, name).agg(F.count("*").alias("n"))
    one = counts.select(F.col(name).alias("a")).distinct()
    met = contained_pairs(one, one.toDF("b")).select(F.col("a").alias(name), F.col("b").alias("_other"))
    other = counts.select(*by, F.col(name).alias("_other"), "n")
    partner = counts.drop("n").join(met, name).join(other, [*by, "_other"]).filter((F.col(name) != F.col("_other")) | (F.col("n") > 1))
    return rows.join(partner.select(*by, name).distinct(), [*by, name], "left_semi").select(key)


def margin_match(pairs: DataFrame, margin: float = 0.5, least: float = 0.5) -> DataFrame:
    """(l_id, r_id, status) of pairs (l_id, r_id, score): matched if the best is at least `least` and beats the second by `margin`, else ambiguous or unmatched."""
    best = pairs.withColumn("place", F.row_number().over(Window.partitionBy("l_id").orderBy(F.desc("score"), "r_id"))).filter("place <= 2")
    two = best.groupBy("l_id").agg(F.max(F.when(F.col("place") == 1, F.struct("score", "r_id"))).alias("a"), F.max(F.when(F.col("place") == 2, F.col("score"))).alias("b"))
    status = F.when(F.col("a.score") - F.col("b") < margin, "ambiguous").when(F.col("a.score") < least, "unmatched").otherwise("matched")
    return two.select("l_id", F.when(status == "matched", F.col("a.r_id")).alias("r_id"), status.alias("status"))


def best_person(persons: DataFrame, order: Column) -> DataFrame:
    """(udr_id, first_name, last_name, rank) of persons (udr_id, first_name, last_name, capacity, role): liquidators and nameless rows go, presidents come first, then authorised persons, then deputies; the first by `order` among equals.

    A smallest struct for each association: no association is sorted in one task.
    """
    up = lambda c: F.upper(F.trim(F.coalesce(c, F.lit(""))))
    capacity, role = up(F.col("capacity")), up(F.col("role"))
    has = lambda w: capacity.contains(w) | role.contains(w)
    rank = F.when(has("PREDSJEDNIK"), 0).when(capacity.contains("OSOBA OVLASTENA") | capacity.contains("OVLAŠTEN"), 1).when(capacity.contains("ZAMJENIK") | capacity.contains("DOPREDSJEDNIK"), 2).otherwise(99)
    name = lambda c: F.trim(F.coalesce(c, F.lit("")))
    kept = persons.filter(~has("LIKVIDATOR") & (F.concat(name("first_name"), name("last_name")) != ""))
    pick = F.min_by(F.struct(name("first_name").alias("first_name"), name("last_name").alias("last_name"), rank.alias("rank")), F.struct(rank, order))
    return kept.groupBy("udr_id").agg(pick.alias("p")).select("udr_id", "p.*")


def close_pairs(points: DataFrame, metres: float) -> DataFrame:
    """(id, near_id, metres) of two points (id, lat, lng) within `metres`, each pair once.

    Points fall into bands of latitude as high as the radius, bands into cells at least as wide as the radius where the band and
    its neighbours are nearest to a pole. Cells of a band go round the earth, so the date line is no border; near a
    pole a band is one cell. A place meets the cells around it in its own band and in both neighbours. Points
    of one place are measured once; those without coordinates are left out.
    """
    high = metres / 111_000.0
    at = points.select("id", "lat", "lng").filter("lat is not null and lng is not null")
    places = kinds(at, ["lat", "lng"], "place")
    p = places.withColumn("gy", F.floor(F.col("lat") / high))

    def cells(band: Column) -> Column:
        steep = F.least(F.greatest(F.abs(band - 1), F.abs(band + 2)) * high, F.lit(90.0))
        return F.greatest(F.floor(F.cos(F.radians(steep)) * (360.0 / 1.6 / high)), F.lit(1))  # an arc is at most pi / 2 times its chord

    def cell(n: Column) -> Column:
        return F.pmod(F.floor((F.col("lng") + 180.0) / 360.0 * n), n)

    def beside(band: Column) -> Column:
        n = cells(band)
        return F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda x: F.struct(band.alias("gy"), F.pmod(cell(n) + x, n).alias("gx")))

    own = p.withColumn("gx", cell(cells(F.col("gy"))))
    around = F.explode(F.array_distinct(F.concat(*[beside(F.col("gy") + y) for y in (-1, 0, 1)])))
    near = p.select(F.col("place").alias("near_place"), F.col("lat").alias("b_lat"), F.col("lng").alias("b_lng"), around.alias("o")).select("near_place", "b_lat", "b_lng", "o.*")
    d = place.haversine_m(F.col("lat"), F.col("lng"), F.col("b_lat"), F.col("b_lng"))
    # Both ways round, as either place may hold the smaller id, and a place with itself.
    met = stored(own.join(near, ["gy", "gx"]).withColumn("metres", d).filter(F.col("metres") <= metres).select("place", "near_place", "metres"), "near_places")
    rows = at.join(places, ["lat", "lng"]).select("id", "place")
    one = rows.withColumnRenamed("id", "l_id").join(met, "place").select("l_id", "metres", F.col("near_place").alias("_key"))
    pairs = _blocks(one, rows.select(F.col("id").alias("r_id"), F.col("place").alias("_key"))).filter("l_id < r_id")
    return pairs.select(F.col("l_id").alias("id"), F.col("r_id").alias("near_id"), "metres")


def truth_pick(rows: DataFrame) -> DataFrame:
    """Add `reason` to rows (name, city, county, lat, lng, g_name, g_address, g_lat, g_lng): agree under 500 m, trust_google, or why not."""
    d = place.haversine_m(F.col("lat"), F.col("lng"), F.col("g_lat"), F.col("g_lng"))
    text = F.concat_ws(" ", "g_name", "g_address")
    bare = F.trim(F.regexp_replace(F.regexp_replace(fold(F.col("name")), r"\(\s*[^)]{1,12}\s*\)", ""), names.NAME_PREFIX, ""))
    city, county = names.place_words(F.col("city")), names.place_words(F.replace(fold(F.col("county")), F.lit("zupanija"), F.lit("")))
    telling = F.array_except(names.place_words(bare), F.array_union(city, county))
    telling = F.when(F.size(telling) > 0, telling).otherwise(names.place_words(bare))
    g_words, a_words = names.place_words(text), names.place_words(F.col("g_address"))
    extra = F.array_except(names.place_words(F.regexp_replace(fold(F.col("g_name")), names.NAME_PREFIX, "")), names.place_words(bare))
    hit = lambda x, y: F.coalesce(F.arrays_overlap(x, y), F.lit(False))
    backed = hit(county, g_words) | hit(city, a_words) | hit(F.array_except(telling, F.array_union(city, county)), a_words) | (F.size(county) == 0)
    reason = (
        F.when(d < 500, "agree").when(names.is_foreign(F.col("g_address")), "foreign_google").when(~names.looks_like_football(F.coalesce("g_name", F.lit(""))), "nonfootball_google")
        .when(has_paren(F.col("name")) & (F.size(extra) == 0), "bare_generic_google").when(hit(telling, g_words) & backed, "trust_google").otherwise("keep_nominatim")
    )
    return rows.withColumn("reason", reason)


def geo_issues(rows: DataFrame, cache: DataFrame, most_km: float = 25.0) -> DataFrame:
    """(id, name, issues) of rows (id, name, city, county, lat, lng) with at least one: bbox, name_mismatch, city_mismatch against a cache (query, lat, lng) of places.

    Places of a name are asked for from the last candidate to the first; the first that the cache knows counts. Most issues first, then by name.
    """
    county = F.trim(F.replace(F.coalesce("county", F.lit("")), F.lit(" županija"), F.lit("")))
    ask = lambda c: F.when(c.isNotNull() & (c != ""), F.concat_ws(", ", c, F.nullif(county, F.lit("")), F.lit("Hrvatska")))
    own = rows.withColumn("city_query", ask(F.col("city"))).withColumn("ladder", F.transform(F.reverse(names.place_names(F.col("name"))), ask))
    rungs = own.select("id", F.posexplode("ladder").alias("pos", "query")).join(cache, "query")
    hit = rungs.groupBy("id").agg(F.min_by(F.struct("lat", "lng"), "pos").alias("n"))
    city = cache.select(F.col("query").alias("city_query"), F.struct("lat", "lng").alias("c"))
    j = own.join(hit, "id", "left").join(city, "city_query", "left")
    km = lambda p: place.haversine_m(F.col("lat"), F.col("lng"), F.col(f"{p}.lat"), F.col(f"{p}.lng")) / 1000
    found = F.array_compact(F.array(
        F.when(~place.in_bounds(F.col("lat"), F.col("lng")), "bbox"), F.when(km("n") > most_km, "name_mismatch"), F.when(km("c") > most_km, "city_mismatch"),
    ))
    return j.filter("lat is not null and lng is not null").select("id", "name", found.alias("issues")).filter(F.size("issues") > 0).orderBy(F.desc(F.size("issues")), "name", "id")


def geo_suspects(clubs: DataFrame, runs: DataFrame, orphans: DataFrame) -> DataFrame:
    """(id, runs, orphan_fields) of clubs (id, geo_source) whose city a backfill run (club_id, fields: JSON array) wrote and whose source is both; orphans (id, field) are cross-referenced."""
    wrote = runs.filter(F.array_contains(F.from_json("fields", "array<string>"), "city")).groupBy(F.col("club_id").alias("id")).agg(F.count("*").alias("runs"))
    bad = orphans.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("field")), "|").alias("orphan_fields"))
    kept = clubs.filter("geo_source = 'both'").select("id").join(wrote, "id").join(bad, "id", "left")
    return kept.select("id", "runs", F.coalesce("orphan_fields", F.lit("")).alias("orphan_fields"))


def missing_candidates(found: DataFrame, clubs: DataFrame, seeds: DataFrame) -> DataFrame:
    """(id, name, city, county) of found (id, name, address) that no club (id, name, city, county) has: same class and core, reserves and women's teams dropped, an address needed.

    The county of a city comes from seeds (city, county), else from the club with the smallest id there.
    """
    keys = lambda d: d.withColumns({"klass": names.klass(F.col("name")), "core": names.core(F.col("name"))})
    own = keys(found.withColumn("name", F.trim("name")).filter("name <> '' and address <> ''")).filter((F.col("klass") != "Z") & ~names.is_reserve(F.col("name")))
    new = own.join(keys(clubs).select("klass", "core"), ["klass", "core"], "left_anti").withColumn("city", F.coalesce(place.city_from_address(F.col("address")), F.lit("")))
    first = clubs.filter("city is not null and county is not null").groupBy("city").agg(F.min_by("county", "id").alias("c2"))
    county = seeds.withColumnRenamed("county", "c1").join(first, "city", "full_outer").select("city", F.coalesce("c1", "c2").alias("county"))
    return new.join(county, "city", "left").select("id", "name", "city", "county")


__all__ = ["best_person", "close_pairs", "margin_match", "geo_issues", "geo_suspects", "match_lists", "missing_candidates", "one_to_one", "prepared_clubs", "prepared_registry", "registry_match", "top_k", "truth_pick", "unique_by_city"]
