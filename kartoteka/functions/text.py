"""Names and free text: Column -> Column."""

from __future__ import annotations

import json
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no identity.
GENERIC_TOKENS = (
    "nk", "hnk", "gnk", "rnk", "mnk", "onk", "snk", "znk", "hask", "hrnk", "bsk", "snm", "hnsk", "gsnk", "nogometni", "nogometna", "nogometno", "nogomet", "klub", "kluba", "sportski", "sport",
    "skolski", "skola", "udruga", "drustvo", "hrvatski", "gradanski", "gradski", "omladinski", "opcina", "grad",
)
# Club prefixes as they stand in names, before folding, and a bracketed suffix.
PREFIX = r"(?iu)^(hnk|gnk|nk|rnk|mnk|hašk|šnk|nogometni\s+klub|građanski\s+nogometni\s+klub)\s+"
PAREN = r"\(\s*[^)]{1,12}\s*\)"


def _base(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


#: Blocks with characters that decompose: Latin, Greek and Cyrillic with marks, raised and lowered digits, letter-like and full-width forms.
_BLOCKS = (range(0xA1, 0x300), range(0x370, 0x530), range(0x1E00, 0x2000), range(0x2070, 0x20A0), range(0x2100, 0x2150), range(0xFF01, 0xFF5F))
#: Characters that decompose into one other character and marks (from a rule, not a list).
_MARKED = [(chr(i), b) for block in _BLOCKS for i in block if len(b := _base(chr(i))) == 1 and b != chr(i) and (b.isalnum() or b.isascii() and b != " ")]
#: Characters that decompose into several (fractions, ligatures, digraphs, signs, dots) or into a space, by the same rule; half-width and presentation forms of other scripts are left out.
_SEVERAL = {chr(i): _base(chr(i)) for block in (range(0xA0, 0x300), range(0x370, 0x530), range(0x1E00, 0x2190), range(0x2460, 0x24EB), range(0x3200, 0x3400), range(0xFB00, 0xFB07)) for i in block}
_FROM, _TO = "".join(a for a, _ in _MARKED), "".join(b for _, b in _MARKED)
_SEVERAL = {a: b for a, b in _SEVERAL.items() if a != b and a not in _FROM}


def _ranges(chars: list[str]) -> str:
    """The inside of a character class for these, neighbours as ranges."""
    codes, out = sorted(map(ord, chars)), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(rf"\u{a:04X}-\u{b:04X}" for a, b in out)


_RARE = "[\u0300-\u036F" + _ranges(list(_SEVERAL)) + "]"
_SEVERAL_JSON = json.dumps(_SEVERAL, ensure_ascii=False)


def _plain(c: Column, more: str = "", to: str = "") -> Column:
    """Marked letters by a table; texts with combining marks or characters that become several, which are few, once more by character."""
    s = F.translate(c, more + _FROM, to + _TO)
    known = F.from_json(F.lit(_SEVERAL_JSON), "map<string,string>")
    each = F.transform(F.split(F.regexp_replace(s, "[\u0300-\u036F]", ""), ""), lambda x: F.coalesce(F.try_element_at(known, x), x))
    return F.when(F.rlike(s, F.lit(_RARE)), F.array_join(each, "")).otherwise(s)


def deburr(c: Column) -> Column:
    """Marks dropped, lower case; a barred d stays (the client-side search)."""
    return F.lower(_plain(c))


def strip_marks(c: Column) -> Column:
    """Marks dropped; a barred d becomes d."""
    return _plain(c, "đĐ", "dD")


def fold(c: Column) -> Column:
    """Marks dropped, lower case, runs of whitespace to one space, trimmed; null becomes the empty text."""
    return F.trim(F.regexp_replace(F.lower(strip_marks(F.coalesce(c, F.lit("")))), r"\s+", " "))


def alnum(c: Column) -> Column:
    return F.regexp_replace(fold(c), "[^a-z0-9]+", "")


def slugify(name: Column, city: Column | None = None) -> Column:
    """Prefix dropped after folding, so prefixes with marks stay; the city is added unless the name ends with it."""
    base = F.regexp_replace(F.trim(F.lower(strip_marks(name))), PREFIX, "")
    if city is not None:
        town = F.trim(F.lower(strip_marks(F.coalesce(city, F.lit("")))))
        base = F.when((town != "") & ~base.endswith(town), F.concat_ws("-", base, town)).otherwise(base)
    return F.regexp_replace(F.regexp_replace(base, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def short_name(name: Column) -> Column:
    rest = F.trim(F.regexp_replace(name, PREFIX, ""))
    return F.when(rest == "", name).otherwise(F.split_part(F.regexp_replace(rest, r"\s+", " "), F.lit(" "), F.lit(1)))


def strip_prefix_twice(c: Column, words: str = "nogometni klub|klub|udruga|nk|hnk") -> Column:
    """At most two leading words of the list go."""
    pattern = rf"^({words})\s+"
    return F.regexp_replace(F.regexp_replace(c, pattern, ""), pattern, "")


def collapse_acronyms(c: Column) -> Column:
    """N.K. -> NK, three and two letters."""
    three = F.regexp_replace(c, r"\b([A-Za-z])\.\s?([A-Za-z])\.\s?([A-Za-z])\.", "$1$2$3")
    return F.regexp_replace(three, r"\b([A-Za-z])\.\s?([A-Za-z])\.", "$1$2")


def tokens(c: Column, least: int = 4, drop: list[str] | tuple = tuple(GENERIC_TOKENS)) -> Column:
    """Distinct words of a folded text with `least` letters or more, without generic ones, sorted."""
    parts = F.filter(F.split(fold(c), "[^a-z0-9]+"), lambda w: F.length(w) >= least)
    return F.array_sort(F.array_distinct(F.array_except(parts, F.array(*map(F.lit, drop)))))


def club_tokens(name: Column, city: Column) -> Column:
    return tokens(F.regexp_replace(F.concat_ws(" ", name, city), PAREN, " "))


def place_tokens(c: Column) -> Column:
    """Letters only, four or more, without generic words."""
    return tokens(F.regexp_replace(fold(c), "[^a-z]+", " "))


def distinctive(words: Column, common: Column) -> Column:
    """Words beyond the common ones; all of them if none is left."""
    rest = F.array_except(words, common)
    return F.when(F.size(rest) == 0, words).otherwise(rest)


def has_paren(name: Column) -> Column:
    return F.coalesce(F.rlike(name, F.lit(PAREN)), F.lit(False))


def title_hyphens(c: Column) -> Column:
    """Title case, also after a hyphen."""
    return F.array_join(F.transform(F.split(F.lower(c), "-"), lambda p: F.initcap(p)), "-")


def clean_name(c: Column) -> Column:
    """Quotes and a trailing bracket dropped."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[\"'„“”]", ""), r"\s*\([^)]*\)\s*$", ""), r"\s+", " "))


def klass(name: Column) -> Column:
    low = fold(name)
    return F.when(F.rlike(low, F.lit(r"\b(znk|zenski|zene)\b")), "women").when(F.rlike(low, F.lit(r"\b(mnk|futsal)\b")), "futsal").otherwise("men")


def place_candidates(name: Column) -> Column:
    """Whole name, last word, last two words, of three letters or more, in this order."""
    words = F.split(F.regexp_replace(fold(name), r"\s+", " "), " ")
    n = F.size(words)
    return F.array_distinct(F.filter(F.array(fold(name), F.element_at(words, -1), F.array_join(F.slice(words, F.greatest(n - 1, F.lit(1)), 2), " ")), lambda x: F.length(x) >= 3))


def prefix_match(a: Column, b: Column, n: int = 6) -> Column:
    return (F.least(F.length(a), F.length(b)) >= n) & (F.left(a, F.lit(n)) == F.left(b, F.lit(n)))


def same_place(a: Column, b: Column) -> Column:
    """Whether two place names share a word, or the first six letters of one."""
    return F.exists(place_tokens(a), lambda x: F.exists(place_tokens(b), lambda y: (x == y) | prefix_match(x, y)))


def any_like(c: Column, patterns: tuple[str, ...] | list[str]) -> Column:
    """Whether a text is like any of the patterns, in either case of A-Z; null is like none. The text is lowered once, and plain `%x%` patterns become searches without a regular expression."""
    low = F.lower(c)
    hits = [low.like(p.lower()) for p in patterns]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False)) if hits else F.lit(False)


def is_blank(c: Column, kind: str) -> Column:
    """Null, whitespace, or integer 0."""
    return c.isNull() | ((F.trim(c) == "") if kind == "string" else (c == 0) if kind in ("int", "bigint") else F.lit(False))


def is_null_or_empty(c: Column) -> Column:
    return c.isNull() | (c == "")
