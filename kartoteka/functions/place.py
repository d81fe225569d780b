"""Addresses, places, dates, geodesy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartoteka.functions.text import fold

# County by the first two digits of a postcode.
POSTCODE_COUNTY = {
    "10": "grad zagreb", "11": "zagrebacka", "20": "dubrovacko-neretvanska", "21": "splitsko-dalmatinska", "22": "sibensko-kninska",
    "23": "zadarska", "31": "osjecko-baranjska", "32": "vukovarsko-srijemska", "33": "viroviticko-podravska", "34": "pozesko-slavonska",
    "35": "brodsko-posavska", "40": "medimurska", "42": "varazdinska", "43": "bjelovarsko-bilogorska", "44": "sisacko-moslavacka",
    "47": "karlovacka", "48": "koprivnicko-krizevacka", "49": "krapinsko-zagorska", "51": "primorsko-goranska", "52": "istarska", "53": "licko-senjska",
}
CAPITAL_PAIR = ("grad zagreb", "zagrebacka")
LAT, LNG = (42.30, 46.60), (13.40, 19.50)
EARTH_M = 6371000.0
BUCKETS = ((50, "agree"), (250, "near"), (1000, "minor"), (10000, "major"))


def city_from_address(c: Column) -> Column:
    last = F.element_at(F.split(c, ","), -1)
    return F.nullif(F.trim(F.regexp_replace(last, r"\b[0-9]{5}\b", "")), F.lit(""))


def address_tail(c: Column) -> Column:
    parts = F.transform(F.split(c, ","), lambda p: F.trim(p))
    return F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, -2, 2), ", "))


def zip_from(c: Column) -> Column:
    """The first run of four or five digits, spaces inside joined, if it has five."""
    run = F.regexp_extract(F.regexp_replace(c, r"(?<=[0-9]) (?=[0-9])", ""), "([0-9]{4,5})", 1)
    return F.when(F.length(run) == 5, run)


def postcode_counties(c: Column) -> Column:
    """Sorted counties of all five-digit codes in a text."""
    table = F.create_map(*[F.lit(x) for kv in POSTCODE_COUNTY.items() for x in kv])
    codes = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\b([0-9]{5})\b"), F.lit(1))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(codes, lambda x: F.try_element_at(table, F.left(x, F.lit(2)))))))


def norm_county(c: Column) -> Column:
    return F.trim(F.regexp_replace(fold(c), r"\s*zupanija\s*$", ""))


def counties_compatible(a: Column, b: Column) -> Column:
    x, y = norm_county(a), norm_county(b)
    return (x != "") & (y != "") & ((x == y) | (x.isin(*CAPITAL_PAIR) & y.isin(*CAPITAL_PAIR)))


def norm_address(c: Column) -> Column:
    s = F.trim(F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9 ]+", " "), " +", " "))
    return F.when(s != "", s)


def norm_latlng(lat: Column, lng: Column) -> Column:
    return F.when(lat.isNotNull() & lng.isNotNull(), F.format_string("%.5f,%.5f", lat, lng))


def parse_year(c: Column) -> Column:
    year = F.regexp_extract(c, "^([0-9]{4})", 1).try_cast("int")
    return F.when(year.between(1850, 2100), year)


def epoch_year(c: Column) -> Column:
    return F.year(F.timestamp_seconds(c))


def in_bounds(lat: Column, lng: Column) -> Column:
    return lat.between(*LAT) & lng.between(*LNG)


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), F.lit(2))
    return 2 * EARTH_M * F.asin(F.sqrt(a))


def distance_bucket(metres: Column) -> Column:
    out = F.when(metres.isNull(), "no_data")
    for limit, name in BUCKETS:
        out = out.when(metres < limit, name)
    return out.otherwise("far")
