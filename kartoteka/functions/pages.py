"""HTML in columns: references decoded in one pass, tags as tokens, the fields of a club's page by a stack of open elements."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as space in text, as a character class: ASCII and Unicode spaces.
SPACE = r"[\t-\r\x1C-\x20\x85\xA0  -     　]+"
#: A reference after its &: decimal, hexadecimal or named, the semicolon optional.
REFERENCE = r"^&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Named references of the HTML standard come from the language's own table; those that count without a semicolon, too.
NAMES = html.entities.html5
LEGACY = "|".join(sorted((n for n in NAMES if not n.endswith(";")), key=lambda n: (-len(n), n)))
#: Numbers that stand for another character: the C1 range read as Windows-1252, and null.
INSTEAD = {0: "�"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
#: Scripts and styles, comments, tags, declarations, text.
TOKEN = r"""(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|</?[a-z](?:[^'">]++|"[^"]*+"|'[^']*+')*+>|<[!?][^>]*>|[^<]+|<"""


def _map(pairs: dict[str, str]) -> Column:
    """A map constant; folded before the query runs."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _character(n: Column) -> Column:
    """The character of a code point; what is none gives the replacement character or nothing, as browsers have it."""
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    nothing = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (F.pmod(n, F.lit(65536)) >= 65534)
    given = F.try_element_at(_map({str(k): v for k, v in INSTEAD.items()}), n.cast("string"))
    return F.coalesce(given, F.when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "�").when(nothing, "").otherwise(plain))


def _reference(ref: Column) -> Column:
    """What a reference stands for; itself if it stands for nothing."""
    body = F.substring(ref, 2, 64)
    digits = F.regexp_replace(body, "^#[xX]?0*|;$", "")
    hexed = F.rlike(body, F.lit("^#[xX]"))
    number = F.when(F.length(digits) > 9, F.lit(0x110000)).otherwise(F.conv(F.when(digits == "", "0").otherwise(digits), 16, 10).cast("long"))
    number = F.when(hexed, number).otherwise(F.when(F.length(digits) > 9, F.lit(0x110000)).otherwise(F.when(digits == "", 0).otherwise(digits).try_cast("long")))
    legacy = F.regexp_extract(body, f"^(?:{LEGACY})", 0)
    legacy = F.when((legacy != "") & (F.length(legacy) < F.length(body)), F.concat(F.try_element_at(_map({n: v for n, v in NAMES.items() if not n.endswith(";")}), legacy), F.substr(body, F.length(legacy) + 1)))
    return F.when(F.startswith(body, F.lit("#")), _character(number)).otherwise(F.coalesce(F.try_element_at(_map(NAMES), body), legacy, ref))


def unescape(c: Column) -> Column:
    """References decoded once: what a reference stands for is not read again, so `&amp;lt;` gives `&lt;`."""

    def piece(p: Column) -> Column:
        ref = F.regexp_extract(p, REFERENCE, 0)
        return F.when(ref == "", p).otherwise(F.concat(_reference(ref), F.substr(p, F.length(ref) + 1)))

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(F.split(c, "(?=&)"), piece), "")).otherwise(c)


def squeeze(c: Column) -> Column:
    """Runs of spaces of any kind to one, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def tokens(page: Column) -> Column:
    """Tags, comments, scripts and texts of a page, in order."""
    return F.regexp_extract_all(page, F.lit(TOKEN), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag, references decoded; null if it is not there."""
    found = F.regexp_extract(tag, rf"""(?is)[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.when(found != "", unescape(F.regexp_replace(found, "^[\"']|[\"']$", "")))


def has_class(classes: Column, name: str) -> Column:
    return F.array_contains(classes, name)


_STATE = (
    "struct<stack:array<struct<tag:string,classes:array<string>,n:int>>,n:int,header:int,title:int,h1:int,h2:int,logo:string,x:string,y:string,map:boolean,"
    "items:array<struct<n:int,classes:array<string>>>,heads:array<struct<n:int,items:array<int>>>,texts:array<struct<within:array<int>,text:string>>,phones:array<struct<items:array<int>,href:string>>>"
)
_EMPTY = {"stack": [], "n": 0, "map": False, "items": [], "heads": [], "texts": [], "phones": []}


def _step(s: Column, token: Column) -> Column:
    """The state after one more token: open elements, and what of the header's content the fields need."""
    name = F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1))
    is_end, is_text = token.startswith("</"), ~token.startswith("<") | (token == "<")
    is_start = (name != "") & ~is_end & ~name.isin("script", "style")
    n, stack = s.n, s.stack
    classes = F.coalesce(F.split(F.trim(attribute(token, "class")), r"\s+"), F.array().cast("array<string>"))
    within = lambda cls: F.exists(stack, lambda e: has_class(e.classes, cls))
    inside = F.exists(stack, lambda e: e.n == s.header)
    start = lambda *tags: is_start & inside & name.isin(*tags)
    first = lambda known, cond: F.when(known.isNull() & cond, n).otherwise(known)
    in_title = F.exists(stack, lambda e: e.n == s.title)
    open_items = F.transform(F.filter(stack, lambda e: F.exists(s["items"], lambda i: i.n == e.n)), lambda e: e.n)
    open_heads = F.transform(F.filter(stack, lambda e: (e.n == s.h1) | (e.n == s.h2) | (e.tag == "h3")), lambda e: e.n)
    is_item = start("li") & within("info") & (F.try_element_at(stack, F.lit(-1)).tag == "ul")
    href = attribute(token, "href")
    more = lambda known, cond, value: F.when(cond, F.concat(known, F.array(value))).otherwise(known)
    last = F.size(stack) - F.array_position(F.transform(F.reverse(stack), lambda e: e.tag), name).cast("int")
    opened = F.when(is_start & ~name.isin(*VOID) & ~token.endswith("/>"), F.concat(stack, F.array(F.struct(name.alias("tag"), classes.alias("classes"), n.alias("n")))))
    closed = F.when(is_end & F.exists(stack, lambda e: e.tag == name), F.slice(stack, F.lit(1), last))
    is_map = start("div") & (attribute(token, "id") == "club_map") & attribute(token, "data-coordinates-x").isNotNull() & ~s.map
    is_map = F.coalesce(is_map | (is_start & inside & (attribute(token, "id") == "club_map") & attribute(token, "data-coordinates-x").isNotNull() & ~s.map), F.lit(False))
    is_logo = start("img") & within("basic_info") & within("logo") & s.logo.isNull()
    after = F.struct(
        F.coalesce(opened, closed, stack).alias("stack"),
        (n + 1).alias("n"),
        first(s.header, is_start & has_class(classes, "clubHeader")).alias("header"),
        first(s.title, is_start & inside & within("basic_info") & has_class(classes, "title")).alias("title"),
        first(s.h1, start("h1") & in_title).alias("h1"),
        first(s.h2, start("h2") & in_title).alias("h2"),
        F.when(is_logo, attribute(token, "src")).otherwise(s.logo).alias("logo"),
        F.when(is_map, attribute(token, "data-coordinates-x")).otherwise(s.x).alias("x"),
        F.when(is_map, attribute(token, "data-coordinates-y")).otherwise(s.y).alias("y"),
        (s.map | is_map).alias("map"),
        more(s["items"], is_item, F.struct(n.alias("n"), classes.alias("classes"))).alias("items"),
        more(s.heads, start("h3") & (F.size(open_items) > 0), F.struct(n.alias("n"), open_items.alias("items"))).alias("heads"),
        more(s.texts, is_text & inside & (F.size(open_heads) > 0), F.struct(open_heads.alias("within"), token.alias("text"))).alias("texts"),
        more(s.phones, start("a") & href.startswith("tel:") & F.exists(stack, lambda e: e.tag == "h3"), F.struct(open_items.alias("items"), href.alias("href"))).alias("phones"),
    )
    return F.when(name.isin("script", "style") & ~is_text | token.startswith("<!") | token.startswith("<?"), s).otherwise(after.cast(_STATE))


def club_page(page: Column) -> Column:
    """A struct of the fields of a club's page: short_name, full_name, founded_date, founded_year, address, stadium_name, phone, lat, lng, logo_url.

    Tokens go by a stack of open elements: an end tag closes the last element of its name and what is open inside of it,
    one without an open element is passed over, void elements close themselves. Only what lies in the first element of
    class clubHeader counts. The state holds open elements and the header's own fields, so it does not grow with the page.
    A null page, and one without a header, gives nulls.
    """
    state = F.aggregate(tokens(page), F.from_json(F.lit(json.dumps(_EMPTY)), _STATE), _step)

    def text_in(s: Column, n: Column) -> Column:
        parts = F.transform(F.filter(s.texts, lambda t: F.array_contains(t.within, n)), lambda t: unescape(t.text))
        return F.nullif(squeeze(F.array_join(parts, " ")), F.lit(""))

    def value(s: Column, item: Column) -> Column:
        heads = F.filter(s.heads, lambda h: F.array_contains(h["items"], item.n))
        return F.when(F.size(heads) > 0, text_in(s, F.try_element_at(heads, F.lit(1)).n))

    def fields(s: Column) -> Column:
        known = F.transform(s["items"], lambda i: F.struct(i.n.alias("n"), i.classes.alias("classes"), value(s, i).alias("v")))
        kinds = ("foundation_date", "address", "stadium", "phone")
        kind = lambda i: F.coalesce(*[F.when(has_class(i.classes, k), k) for k in kinds])
        pick = lambda k: F.try_element_at(F.filter(known, lambda i: i.v.isNotNull() & (kind(i) == k)), F.lit(-1))
        founded, phone = pick("foundation_date").v, pick("phone")
        link = F.try_element_at(F.filter(s.phones, lambda a: F.array_contains(a["items"], phone.n)), F.lit(1)).href
        lat, lng = s.x.try_cast("double"), s.y.try_cast("double")
        return F.struct(
            F.when(s.h1.isNotNull(), text_in(s, s.h1)).alias("short_name"),
            F.when(s.h2.isNotNull(), text_in(s, s.h2)).alias("full_name"),
            founded.alias("founded_date"),
            F.nullif(F.regexp_extract(founded, r"[0-9]{2}\.[0-9]{2}\.([0-9]{4})", 1), F.lit("")).cast("int").alias("founded_year"),
            pick("address").v.alias("address"),
            pick("stadium").v.alias("stadium_name"),
            F.coalesce(F.nullif(F.trim(F.substring(link, 5, 1 << 20)), F.lit("")), phone.v).alias("phone"),
            lat.alias("lat"),
            F.when(lat.isNotNull(), lng).alias("lng"),
            s.logo.alias("logo_url"),
        )

    found = F.element_at(F.transform(F.array(state), fields), 1)
    return F.when(F.contains(page, F.lit("clubHeader")), found)
