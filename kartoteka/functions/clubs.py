"""Names of clubs, leagues and places: rules that decide and normal forms that join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartoteka.functions.place import CAPITAL_PAIR, norm_county
from kartoteka.functions.text import GENERIC_TOKENS, fold

# Legal forms, club words and short prefixes of two normal forms that must stay apart.
LEGAL_FIRST = ("š. d. d.", "s. d. d.", " sdd", "š.d.d.", "s.d.d.", " š d d", " s d d")
LEGAL_SECOND = ("š. d. d.", "s. d. d.", "š.d.d.", "s.d.d.", " sdd ")
CLUB_WORDS = r"\b(hrvatski |građanski |gradanski )?nogometni klub\b"
SHORT_FIRST = r"\b(hnk|gnk|nk|rnk|fk|znk|mnk)\b"
SHORT_SECOND = r"\b(hnk|gnk|nk|rnk|fk|znk|mnk|snk)\b"
# Quotes and punctuation that registry names lose.
QUOTES, POINTS = "[„«»`'\"]+", r"[.,;:!?/\\()\[\]{}]+"
# Prefixes and suffixes of names in the registry and in leagues.
REGISTRY_PREFIX = (
    r"^\s*(gradanski nogometni klub|gradski nogometni klub|hrvatski nogometni klub|hrvatski radnicki nogometni klub|hrvatski akademski nogometni klub|omladinski nogometni klub|"
    r"skolski nogometni klub|sportski nogometni klub|nogometni klub|nogometna udruga|nogometni|nogomet|hnk|gnk|nk|rnk|mnk|onk|snk|znk)\b\s*"
)
NAME_PREFIX = r"^(hnk|gnk|nk|rnk|mnk|hask|snk|gsnk|bsk|onk|nsk|hnsk)\s+"
CORE_WORDS = r"\b(znk|nk|hnk|snk|nsk|gnk|rnk|onk|hrnk|hnsk|snm|sn|ofk|mnk|nso|ns)\b"
RESERVE = r"\bii\b|\(b\)|\b2\b|\bi\b$"
# Words that shut out leagues, tournaments and registry rows.
LEAGUE_SKIP = r"\b(kup|cup|trofej|trophy|veteran|mladez|zene|futsal|juniori|kadeti|pioniri|limaci|u[0-9]{1,2}|turniri|prijateljske|league\s+s[0-9])\b"
TOURNAMENT_SKIP = r"\b(u[0-9]{1,2}|kadet|junior|pionir|mlad|veter|zene|futsal|kup|cup|trofej|trophy|memorijal|turnir)\b"
REGISTRY_SKIP = (
    r"\b(malonogometni|mala nogometna|mini ?nogometni|stolnonogometni|zenski nogometni|veteranski nogometni|veterani|skola nogometa|nogometna omladinska skola|skolski sport(ski)?|"
    r"udruga prijatelja|drustvo prijatelja|udruga navijaca|klub navijaca|americkog nogometa|klub americkog nogometa|teqball|futsal|nogometni delegati|zbor nogometnih|nogometno srediste|"
    r"savez nogometnih|nogometn[aei] (sluzbenici|treneri|suci|delegati))\b"
)
# Neighbours, and what a football ground is called.
FOREIGN = ("slovenija", "bosna i hercegovina", "srbija", "crna gora", "italija", "magyarorszag", "madarska")
FOOTBALL = r"\b(nk|hnk|gnk|rnk|mnk|znk|snk|gsnk|hrnk|fc)\b|nogomet|stadion|stadium"
PLACE_STOP = (
    "nogometni", "klub", "nogometna", "nogomet", "hrvatski", "gradanski", "gradski", "akademski", "radnicki", "omladinski", "sportski", "hrvatska", "udruga", "stadion", "stadium",
    "skola", "athletic",
)
# Registry statuses by rank.
STATUS_RANK = {"AKTIVAN": 3, "PRESTANAK DJELOVANJA": 2, "BRISAN": 1}


def _spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", " "), r"\s+", " "))


def _without(c: Column, legal: tuple, short: str, paren: str) -> Column:
    s = F.lower(F.coalesce(c, F.lit("")))
    for form in legal:
        s = F.replace(s, F.lit(form), F.lit(""))
    for pattern in (CLUB_WORDS, short):
        s = F.regexp_replace(s, pattern, "")
    return _spaced(F.regexp_replace(s, paren, " "))


def first_form(name: Column) -> Column:
    """Legal forms, club words and one-letter brackets dropped."""
    return _without(name, LEGAL_FIRST, SHORT_FIRST, r"\(\s*[a-zšđčćž]\s*\)")


def second_form(name: Column) -> Column:
    """As the first, with other lists and brackets of letters of any length."""
    return _without(name, LEGAL_SECOND, SHORT_SECOND, r"\(\s*[a-zšđčćž]+\s*\)")


def match_key(name: Column) -> Column:
    """Prefix and closing bracket dropped, folded."""
    return fold(F.regexp_replace(F.trim(F.regexp_replace(fold(name), NAME_PREFIX, "")), r"\s*\([^)]+\)\s*$", ""))


def registry_norm(c: Column) -> Column:
    """Quotes to spaces, acronyms of two or three letters joined (N.K. to nk), the punctuation of QUOTES and POINTS to spaces; hyphens stay."""
    s = F.regexp_replace(fold(c), QUOTES, " ")
    for letters in (2, 3):
        s = F.regexp_replace(s, r"\b" + r"([a-z])\." * letters, "".join(f"${i + 1}" for i in range(letters)))
    return F.trim(F.regexp_replace(F.regexp_replace(s, POINTS, " "), r"\s+", " "))


def registry_short(norm: Column) -> Column:
    return F.trim(F.regexp_replace(norm, REGISTRY_PREFIX, ""))


def klass(name: Column) -> Column:
    """Z (women), F (futsal), M."""
    low = fold(name)
    return F.when(low.startswith("znk") | low.contains("zenski"), "Z").when(low.startswith("mnk") | low.contains("futsal") | low.contains("malonog"), "F").otherwise("M")


def core(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(fold(name), CORE_WORDS, ""), "[^a-z0-9]+", " "))


def is_reserve(name: Column) -> Column:
    return F.rlike(fold(name), F.lit(RESERVE))


def place_names(name: Column) -> Column:
    """Whole, last and first word, quotes and two prefixes dropped."""
    n = F.regexp_replace(F.trim(F.regexp_replace(name, "[\"'„“”]", " ")), r"\s*\([^)]*\)\s*$", "")
    for _ in range(2):
        n = F.trim(F.regexp_replace(n, r"(?i)^(hnk|gnk|nk|rnk|mnk|onk|znk|snm)\s+", ""))
    words = F.filter(F.split(n, r"\s+"), lambda w: F.length(w) >= 3)
    several = F.when(F.size(words) >= 2, F.array(F.element_at(words, -1), words[0])).otherwise(F.expr("array() :: array<string>"))
    return F.when(F.size(words) == 0, F.expr("array() :: array<string>")).otherwise(F.array_distinct(F.concat(F.array(n), several)))


def search_query(name: Column, city: Column, county: Column) -> Column:
    base = F.trim(F.regexp_replace(name, r"\(\s*[^)]{1,12}\s*\)", ""))
    place = F.coalesce(F.nullif(city, F.lit("")), F.trim(F.replace(county, F.lit(" županija"), F.lit(""))))
    return F.concat_ws(" ", F.nullif(base, F.lit("")), F.nullif(place, F.lit("")), F.lit("nogometni klub kontakt"))


def short_label(name: Column, fallback: Column, n: int = 14) -> Column:
    return F.trim(F.left(F.trim(F.coalesce(name, fallback)), F.lit(n)))


def league_tier(name: Column) -> Column:
    low = fold(name)
    rank = F.regexp_extract(low, r"^\s*([0-9])\s*\.\s*znl", 1)
    by_rank = F.when(rank.isin("1", "2", "3", "4"), rank.cast("int") + 5).otherwise(99)
    upper = low.contains("premier") | low.contains("elitna") | low.contains("1. zagreba") | low.startswith("j1")
    return F.when(rank != "", by_rank).when(upper, 6).when(low.contains("2. zagreba"), 7)


def keep_league(name: Column, is_cup: Column, hidden: Column, county: Column) -> Column:
    """struct(keep, tier, reason)."""
    tier = league_tier(name)
    reason = (
        F.when(is_cup, "isCup=1").when(hidden, "hidden").when(F.rlike(fold(name), F.lit(LEAGUE_SKIP)), "skip-pattern").when(~county, "national-skipped")
        .when(tier.isNull(), F.concat(F.lit("untiered:'"), name, F.lit("'"))).otherwise("ok")
    )
    return F.struct((reason == "ok").alias("keep"), F.when(reason == "ok", tier).alias("tier"), reason.alias("reason"))


def tournament_kept(name: Column) -> Column:
    return ~F.rlike(fold(name), F.lit(TOURNAMENT_SKIP))


def registry_kept(norm: Column) -> Column:
    return norm.contains("nogomet") & ~F.rlike(norm, F.lit(REGISTRY_SKIP))


def is_foreign(address: Column) -> Column:
    return F.rlike(fold(address), F.lit("|".join(FOREIGN)))


def looks_like_football(place: Column) -> Column:
    return F.rlike(fold(place), F.lit(FOOTBALL))


def is_company(name: Column) -> Column:
    low = fold(name)
    return low.contains("dionick") & low.contains("drustv")


def place_words(c: Column) -> Column:
    """Words of three letters or more without those every ground has."""
    parts = F.filter(F.split(F.regexp_replace(fold(c), "[^a-z0-9 ]", " "), " +"), lambda w: F.length(w) >= 3)
    return F.array_distinct(F.array_except(parts, F.array(*map(F.lit, PLACE_STOP))))


def seat_place(seat: Column) -> Column:
    """The place at the end of a registry seat, without its postcode."""
    return F.coalesce(fold(F.trim(F.regexp_replace(F.element_at(F.split(seat, ","), -1), r"\b[0-9]{5}\b", ""))), F.lit(""))


def county_group(county: Column) -> Column:
    """Counties that fit each other under one name, '' if unknown: the capital and its ring are one."""
    x = norm_county(county)
    return F.when(x.isin(*CAPITAL_PAIR), CAPITAL_PAIR[0]).otherwise(x)


def city_match(city: Column, seat: Column) -> Column:
    """Containment either way of a city and the place in a registry seat."""
    a, b = fold(city), seat_place(seat)
    return (a != "") & (b != "") & (a.contains(b) | b.contains(a))


def county_fits(a: Column, b: Column) -> Column:
    """Equal, unknown on either side, or the capital and its ring."""
    x, y = norm_county(a), norm_county(b)
    return (x == "") | (y == "") | (x == y) | (x.isin(*CAPITAL_PAIR) & y.isin(*CAPITAL_PAIR))


def status_rank(status: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in STATUS_RANK.items() for x in kv]), status), F.lit(0))


def words_of(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))


def generic_free(words: Column) -> Column:
    return F.array_except(words, F.array(*map(F.lit, GENERIC_TOKENS)))
