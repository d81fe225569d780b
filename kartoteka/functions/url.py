"""URLs and links."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartoteka.functions.text import fold, has_paren

SCHEME = "^[a-z][a-z0-9+.-]*://"
# Hosts that are not a club's own site, sites that list clubs, sites of professional clubs, and document endings.
FOREIGN_HOSTS = (
    "facebook.com", "fb.com", "fbcdn.net", "instagram.com", "cdninstagram.com", "twitter.com", "x.com", "t.co", "youtube.com", "youtu.be", "tiktok.com", "ttwstatic.com", "wa.me", "whatsapp.com",
)
AGGREGATORS = (
    "wikipedia.org", "transfermarkt", "sofascore", "hrsport.net", "sportnet.hr", "index.hr", "24sata", "tportal", "soccerway", "fcfutbol", "playmaker", "playmakerstats", "soccerstand", "poslovna.hr",
    "companywall.hr", "sudreg.hr", "fininfo.hr", "burzakapital.hr", "boniteti.hr", "fina.hr", "nszz.hr", "nszns.hr", "nssmz.hr", "nssloga-cakovec.hr", "hrvatskekarta.com", "semafor.hns.family",
    "dugoselska-kronika.hr", "dugoselski-sport.hr", "opcina-", "-opcina", "opcokucani", "nova-raca",
)
PRO_CLUBS = ("hajduk.hr", "gnkdinamo.hr", "dinamo.hr", "nkrijeka.hr", "hnk-rijeka.hr", "nk-osijek.hr", "nkosijek.hr", "hnk-gorica.hr", "lokomotiva.hr", "slaven-belupo.hr", "nk-istra.hr", "nk-istra1961.hr", "varazdin.hr", "vukovar1991.hr")
DOCUMENTS = (".pdf", ".docx", ".doc", ".xlsx", ".xls")
CONTACT_WORDS = ("kontakt", "klub", "contact", "o-klubu", "about")


def norm_domain(c: Column) -> Column:
    """Host without scheme, user, port, www. and outer dots; null if nothing is left."""
    s = F.regexp_replace(F.regexp_replace(fold(c), SCHEME, ""), "[/?#].*$", "")
    s = F.split_part(F.regexp_replace(s, "^.*@", ""), F.lit(":"), F.lit(1))
    s = F.regexp_replace(F.regexp_replace(s, r"^www\.", ""), r"^\.+|\.+$", "")
    return F.when(s != "", s)


def social_slug(c: Column, host: str) -> Column:
    """One key for a profile, whatever the spelling of its url."""
    s = F.regexp_replace(fold(c), SCHEME, "")
    path = F.regexp_replace(F.regexp_extract(s, f"^.*?{host.replace('.', '[.]')}(.*)$", 1), "^/+", "")
    number = F.regexp_extract(path, "id=([0-9]+)", 1)
    inner = F.when(F.rlike(path, F.lit("^(pg|pages|people)/")), F.regexp_extract(path, "^[^/]+/+([^/]*)", 1)).otherwise(path)
    plain = F.trim(F.regexp_replace(inner, "[?#/].*$", ""))
    return F.when(~s.contains(host), None).when(path.startswith("profile.php"), F.when(number != "", F.concat(F.lit("profile:"), number))).when(plain != "", plain)


def about_url(c: Column) -> Column:
    """A page url with its known endings cut and the about path put on."""
    base = F.regexp_replace(F.regexp_replace(c, "[?#].*$", ""), "/+(about|about_contact_and_basic_info|posts|photos|videos)?/*$", "")
    return F.concat(base, F.lit("/about"))


def own_site(c: Column) -> Column:
    """Whether a url's host is none of the foreign ones nor below them."""
    host = norm_domain(c)
    pattern = r"(^|\.)(" + "|".join(h.replace(".", "[.]") for h in FOREIGN_HOSTS) + ")$"
    return host.isNotNull() & ~F.rlike(host, F.lit(pattern))


def score_url(url: Column, name_words: Column, name: Column | None = None) -> Column:
    """Additive rank of a candidate home page. A bracketed name is a namesake, so a professional club's site is none of its own."""
    low = F.lower(url)
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    has = lambda words: reduce(or_, [low.contains(w) for w in words])
    share = has(("/sharer", "/dialog", "/share"))
    return reduce(
        add,
        [
            points(F.rlike(low, F.lit("^https?://")), 1),
            points(has(AGGREGATORS), -5),
            points(has_paren(name) & has(PRO_CLUBS), -20) if name is not None else F.lit(0),
            points(reduce(or_, [low.endswith(d) for d in DOCUMENTS]), -8),
            points(low.contains("facebook.com"), F.when(share, -10).otherwise(1)),
            points(has(("twitter.com", "x.com")) & has(("/home?status=", "?status=", "/intent/tweet")), -10),
            points(low.endswith(".hr") | low.contains(".hr/"), 3),
            points(F.exists(name_words, lambda w: low.contains(w)), 4),
            *[points(low.contains(w), 1) for w in CONTACT_WORDS],
        ],
    )


def clean_website(c: Column) -> Column:
    s = F.regexp_replace(F.trim(c), "^/+|/+$", "")
    return F.when(s.contains("."), F.when(F.rlike(s, F.lit("^https?://")), s).otherwise(F.concat(F.lit("https://"), s)))


def page_number(c: Column) -> Column:
    """The numeric id in a path, or null."""
    found = F.regexp_extract(c, "/([0-9]+)(?:[/.?#]|$)", 1)
    return F.when(found != "", found.cast("long"))


def links(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(html, F.lit('href="([^"#]+)'), F.lit(1)))


_THUMB = r"(?i)/_resized/(.+?)_[0-9]+_[0-9]+_wg(?:_t)?\.(png|jpe?g|gif)$"
# Endings of images, and first path parts that are no profile.
IMAGES = ("png", "jpg", "gif")
RESERVED = ("pages", "people", "groups", "pg")


def original_candidates(c: Column) -> Column:
    """Full-size urls of a thumbnail's, its own ending first; a url that is no thumbnail stays."""
    stem, ext, base = F.regexp_extract(c, _THUMB, 1), F.lower(F.regexp_extract(c, _THUMB, 2)), F.regexp_replace(c, _THUMB, "")
    endings = F.concat(F.array(ext), F.filter(F.array(*map(F.lit, IMAGES)), lambda e: e != ext))
    full = F.transform(endings, lambda e: F.concat(base, F.lit("/"), stem, F.lit("."), e))
    last = F.array(F.concat(base, F.lit("/_resized/"), stem, F.lit("_280_280_wg_t."), ext))
    return F.when(stem == "", F.array(c)).otherwise(F.concat(full, last))


def page_handle(c: Column) -> Column:
    """The numeric id of a profile url, else its first path part unless that is reserved."""
    number = F.regexp_extract(c, r"facebook\.com/profile\.php\?id=([0-9]+)", 1)
    part = F.regexp_extract(c, r"facebook\.com/([^/?#]+)", 1)
    return F.when(number != "", number).when(~part.isin("", *RESERVED), part)


def srcset(base: Column, slug: Column, side: Column) -> Column:
    """One entry for each size that the source image fills."""
    sizes = F.filter(F.array(*map(F.lit, (192, 256, 512, 1024))), lambda s: s <= side)
    return F.array_join(F.transform(sizes, lambda s: F.concat(base, F.lit("/logos/"), s.cast("string"), F.lit("/"), slug, F.lit(".png "), s.cast("string"), F.lit("w"))), ", ")


def club_id(c: Column) -> Column:
    found = F.regexp_extract(c, "/(?:en/)?(?:klubovi|clubs)/([0-9]+)/", 1)
    return F.when(found != "", found.cast("long"))


def canonical_url(base: Column, number: Column) -> Column:
    return F.concat(base, F.lit("/klubovi/"), number.cast("string"), F.lit("/"))


# Bytes of a detail link's token before the number and between number and field name (in hex), and the field's name, whose last byte has its high bit set.
TOKEN_HEAD, TOKEN_MIDDLE, TOKEN_NAME = "F2070100000100010001", "000000000000000000010101", "oib"
TOKEN_FIELD = TOKEN_NAME[:-1].encode().hex().upper() + f"{ord(TOKEN_NAME[-1]) | 0x80:02X}0201"


def detail_token(number: Column, record: Column) -> Column:
    """Token of a registry's detail link: the number (ASCII, its last byte with the high bit set) and the record's id as a zigzag varint, in url-safe base64 without padding.

    Null without a number or a record.
    """
    text = F.nullif(number, F.lit(""))
    last = F.hex(F.ascii(F.right(text, F.lit(1))).bitwiseOR(128))
    z = F.shiftleft(record.cast("long"), 1)
    left = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.call_function("shiftright", z, i * 7)), lambda x: x > 0)
    left = F.when(z == 0, F.array(F.lit(0).cast("long"))).otherwise(left)
    varint = F.array_join(F.transform(left, lambda x: F.lpad(F.hex(x.bitwiseAND(127) + F.when(x > 127, 128).otherwise(0)), 2, "0")), "")
    code = F.concat(F.lit(TOKEN_HEAD), F.hex(F.encode(F.left(text, F.length(text) - 1), "UTF-8")), last, F.lit(TOKEN_MIDDLE + TOKEN_FIELD), varint)
    return F.rtrim(F.translate(F.base64(F.unhex(code)), "+/", "-_"), F.lit("="))
