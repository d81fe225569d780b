"""Scalar functions applied to columns of the test tables: names, contacts, urls, places, markup, colours."""

from __future__ import annotations

from pyspark.sql import functions as F

from kartoteka.functions import colour, contact, markup, pages, place, text, url
from kartoteka.plans.registry import query
from kartoteka.session import table


def docs(spark, sf_dir, *more):
    return table(spark, sf_dir, "documents").select("doc_id", "text", *more)


# ---- names

FOLDED = r"trim(regexp_replace(lower(strip_accents(replace(replace(coalesce(text, ''), 'đ', 'd'), 'Đ', 'D'))), '\s+', ' ', 'g'))"


@query("x01_fold", f"select doc_id, md5({FOLDED}) as folded, md5(regexp_replace({FOLDED}, '[^a-z0-9]+', '', 'g')) as plain from documents")
def x01(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select("doc_id", F.md5(text.fold(F.col("text"))).alias("folded"), F.md5(text.alnum(F.col("text"))).alias("plain"))


@query(
    "x02_slug",
    r"""with t as (select c_custkey, lower(c_name) as base, lower(c_mktsegment) as town from customer)
        select c_custkey, trim(regexp_replace(case when c_custkey % 2 = 0 and not ends_with(base, town) then base || '-' || town else base end, '[^a-z0-9]+', '-', 'g'), '-') as slug from t""",
)
def x02(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    city = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))
    return c.select("c_custkey", text.slugify(F.concat(F.lit("HNK "), "c_name"), city).alias("slug"))


@query(
    "x03_short_names",
    """select p_partkey, split_part(p_name, ' ', 1) as short, p_name as twice, upper(left(p_name, 1)) || 'K ' || p_name as joined,
       array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), '-') as titled, p_name as cleaned from part""",
)
def x03(spark, sf_dir):
    p, name = table(spark, sf_dir, "part"), F.col("p_name")
    dotted = F.concat(F.upper(F.left(name, F.lit(1))), F.lit(".K. "), name)
    return p.select(
        "p_partkey", text.short_name(F.concat(F.lit("NK "), name)).alias("short"), text.strip_prefix_twice(F.concat(F.lit("nk klub "), name)).alias("twice"),
        text.collapse_acronyms(dotted).alias("joined"), text.title_hyphens(F.replace(name, F.lit(" "), F.lit("-"))).alias("titled"),
        text.clean_name(F.concat(F.lit('"'), name, F.lit('" (X)'))).alias("cleaned"),
    )


@query(
    "x11_tokens",
    """with t as (select p_partkey, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(p_name || ' ' || p_type), '[^a-z0-9]+'),
         lambda w: length(w) >= 4 and w not in ('klub', 'grad', 'sport')))) as words, list_filter(string_split(lower(p_type), ' '), lambda w: length(w) >= 4) as common from part)
       select p_partkey, coalesce(array_to_string(words, ' '), '') as words, coalesce(array_to_string(case when len(list_filter(words, lambda w: not list_contains(common, w))) = 0 then words
         else list_filter(words, lambda w: not list_contains(common, w)) end, ' '), '') as own from t""",
)
def x11(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", text.club_tokens(F.col("p_name"), F.col("p_type")).alias("w"), text.tokens(F.col("p_type")).alias("common"))
    return p.select("p_partkey", F.array_join("w", " ").alias("words"), F.array_join(text.distinctive(F.col("w"), F.col("common")), " ").alias("own"))


@query(
    "x17_place_candidates",
    """select p_partkey, array_to_string(list_filter([p_name, split_part(p_name, ' ', -1)], lambda x: length(x) >= 3), '|') as candidates,
       case when p_partkey % 3 = 0 then 'women' when p_partkey % 3 = 1 then 'futsal' else 'men' end as class, p_partkey % 3 = 2 as paren from part""",
)
def x17(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 3
    name = F.concat(F.when(k == 0, "ŽNK ").when(k == 1, "MNK ").otherwise("NK "), "p_name", F.when(k == 2, " (S)").otherwise(""))
    return p.select("p_partkey", F.array_join(text.place_candidates(F.col("p_name")), "|").alias("candidates"), text.klass(name).alias("class"), text.has_paren(name).alias("paren"))


@query("x16_deburr", "select doc_id, md5(lower(strip_accents(text))) as d from documents")
def x16(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5(text.deburr(F.col("text"))).alias("d"))


@query("x22_blank", "select count(*) filter (quality is null or quality = 0)::bigint as blank_int, count(*) filter (lang is null or trim(lang) = '')::bigint as blank_text from documents left join labels using (doc_id)")
def x22(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.agg(F.count_if(text.is_blank(F.col("quality"), "int")).alias("blank_int"), F.count_if(text.is_blank(F.col("lang"), "string")).alias("blank_text"))


# ---- contacts

NUMBER = "lpad((c_custkey * 7919 % 10000000)::varchar, 7, '0')"


@query(
    "p01_phones",
    f"""with t as (select c_custkey, c_custkey % 4 as k, {NUMBER} as n from customer)
        select c_custkey, case k when 0 then 'mobile' when 1 then 'landline' when 2 then 'mobile' else 'unknown' end as kind,
          case k when 0 then '+38591' || n when 1 then '+3851' || n when 2 then '+38598' || n end as e164, k in (0, 2) as international from t""",
)
def p01(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n, k = F.lpad((F.col("c_custkey") * 7919 % 10000000).cast("string"), 7, "0"), F.col("c_custkey") % 4
    spelt = F.when(k == 0, F.concat(F.lit("+385 91/"), n)).when(k == 1, F.concat(F.lit("01 "), n)).when(k == 2, F.concat(F.lit("00385(98) "), n)).otherwise(F.lit("call 112"))
    return c.select("c_custkey", contact.phone_kind(spelt).alias("kind"), contact.e164(spelt).alias("e164"), contact.is_international(contact.first_number(spelt)).alias("international"))


@query(
    "p04_phones_in_text",
    f"""with t as (select doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '{contact.PHONE}'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g')) between 8 and 13) as p from documents)
        select doc_id, len(p)::int as n, p[1] as "first" from t""",
)
def p04(spark, sf_dir):
    p = docs(spark, sf_dir).select("doc_id", contact.phones_in(F.coalesce("text", F.lit(""))).alias("p"))
    return p.select("doc_id", F.size("p").alias("n"), F.get("p", F.lit(0)).alias("first"))


@query(
    "p04_contact_block_first",
    f"""with t as (select s_suppkey, case when s_suppkey % 2 = 0 then '01 2345 67' || (s_suppkey % 10) else '' end as block, 'x +385 91 123 45' || (10 + s_suppkey % 80) || ' y' as whole from supplier)
        select s_suppkey, coalesce(nullif(regexp_extract(block, '{contact.PHONE}'), ''), nullif(regexp_extract(whole, '{contact.PHONE}'), '')) as phone from t""",
)
def p04_block(spark, sf_dir):
    k = F.col("s_suppkey")
    block = F.when(k % 2 == 0, F.concat(F.lit("01 2345 67"), k % 10)).otherwise("")
    whole = F.concat(F.lit("x +385 91 123 45"), 10 + k % 80, F.lit(" y"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", contact.first_phone(block, whole).alias("phone"))


@query(
    "p08_emails_in_text",
    r"""with t as (select doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[A-Za-z]{2,}'), lambda x: not regexp_matches(lower(x), '@(facebook|fb|instagram)\.com$')) as e from documents)
        select doc_id, len(e)::int as n, lower(e[1]) as "first" from t where len(e) > 0""",
)
def p08(spark, sf_dir):
    e = docs(spark, sf_dir).select("doc_id", contact.emails_in(F.coalesce("text", F.lit(""))).alias("e")).filter(F.size("e") > 0)
    return e.select("doc_id", F.size("e").alias("n"), contact.norm_email(F.col("e")[0]).alias("first"))


@query(
    "p10_ids",
    """select o_orderkey, case when o_orderkey % 2 = 0 then lpad(o_orderkey::varchar, 11, '1') end as oib, case when o_orderkey % 3 = 0 then lpad(o_orderkey::varchar, 17, '2') end as iban,
       o_orderkey % 4 <> 0 as accepted from orders""",
)
def p10(spark, sf_dir):
    k = F.col("o_orderkey")
    oib = F.concat(F.lit("OIB "), F.lpad(k.cast("string"), F.when(k % 2 == 0, 11).otherwise(10), F.lit("1")))
    digits = F.lpad(k.cast("string"), 17, "2")
    iban = F.concat(F.left(digits, F.lit(4)), F.lit(" "), F.substring(digits, 5, 99), F.when(k % 3 == 0, "").otherwise("x"))
    mail = F.concat(F.when(k % 4 == 0, "tajnik@hns.").otherwise("club@example."), F.lit("hr"))
    return table(spark, sf_dir, "orders").select("o_orderkey", contact.norm_oib(oib).alias("oib"), contact.iban_digits(iban).alias("iban"), contact.email_accepted(mail).alias("accepted"))


# ---- urls

HOST = r"nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(url, ''))), '^[a-z][a-z0-9+.-]*://', ''), '[/?#].*$', ''), '^.*@', ''), ':.*$', ''), '^www\.', ''), '.'), '')"


@query("u01_domain", f"select page_id, {HOST} as domain from pages")
def u01(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", url.norm_domain(F.col("url")).alias("domain"))


@query(
    "u02_social",
    "select page_id, case page_id % 4 when 0 then 'profile:' || page_id when 3 then null else 'club' || page_id end as slug, 'https://facebook.com/club' || page_id || '/about' as about from pages",
)
def u02(spark, sf_dir):
    k = F.col("page_id")
    name = F.concat(F.lit("club"), k)
    link = (
        F.when(k % 4 == 0, F.concat(F.lit("https://www.facebook.com/profile.php?id="), k)).when(k % 4 == 1, F.concat(F.lit("facebook.com/pg/"), name, F.lit("/about")))
        .when(k % 4 == 2, F.concat(F.lit("HTTPS://FACEBOOK.com/"), name, F.lit("/?ref=x"))).otherwise(F.concat(F.lit("https://example.com/"), name))
    )
    page = F.concat(F.lit("https://facebook.com/"), name, F.when(k % 2 == 0, "/posts/").otherwise("/"))
    return table(spark, sf_dir, "pages").select("page_id", url.social_slug(link, "facebook.com").alias("slug"), url.about_url(page).alias("about"))


@query(
    "u05_score",
    rf"""with t as (select page_id, lower(url) as u, page_id % 3 = 0 as paren from pages), s as (
          select page_id, case when regexp_matches(u, '^https?://') then 1 else 0 end
            + case when regexp_matches(u, '{"|".join(a.replace(".", "[.]") for a in url.AGGREGATORS)}') then -5 else 0 end
            + case when regexp_matches(u, '\.(pdf|docx?|xlsx?)$') then -8 else 0 end
            + case when paren and regexp_matches(u, '{"|".join(a.replace(".", "[.]") for a in url.PRO_CLUBS)}') then -20 else 0 end
            + case when contains(u, 'facebook.com') then case when regexp_matches(u, '/(sharer|dialog|share)') then -10 else 1 end else 0 end
            + case when (contains(u, 'twitter.com') or contains(u, 'x.com')) and (contains(u, '/home?status=') or contains(u, '?status=') or contains(u, '/intent/tweet')) then -10 else 0 end
            + case when ends_with(u, '.hr') or contains(u, '.hr/') then 3 else 0 end + case when contains(u, 'example') then 4 else 0 end
            + (contains(u, 'kontakt')::int + contains(u, 'klub')::int + contains(u, 'contact')::int + contains(u, 'o-klubu')::int + contains(u, 'about')::int) as score from t)
        select page_id, score::int as score from s""",
)
def u05(spark, sf_dir):
    name = F.when(F.col("page_id") % 3 == 0, "NK Example (Z)").otherwise("NK Example")
    return table(spark, sf_dir, "pages").select("page_id", url.score_url(F.col("url"), F.array(F.lit("example")), name).alias("score"))


@query("u10_links", """select page_id, len(list_distinct(regexp_extract_all(html, 'href="([^"#]+)', 1)))::int as n, nullif(regexp_extract(url, '/([0-9]+)(?:[/.?#]|$)', 1), '')::bigint as number from pages""")
def u10(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.size(url.links(F.col("html"))).alias("n"), url.page_number(F.col("url")).alias("number"))


@query("u07_website", "select s_suppkey, case when s_suppkey % 2 = 0 then 'https://club' || s_suppkey || '.hr' when s_suppkey % 3 = 0 then 'http://club.hr' end as site, s_suppkey % 3 <> 0 as own from supplier")
def u07(spark, sf_dir):
    k = F.col("s_suppkey")
    raw = F.when(k % 2 == 0, F.concat(F.lit("/club"), k, F.lit(".hr//"))).when(k % 3 == 0, "http://club.hr/").otherwise("none")
    link = F.when(k % 3 == 0, "https://m.facebook.com/x").otherwise("https://notfacebook.com")
    return table(spark, sf_dir, "supplier").select("s_suppkey", url.clean_website(raw).alias("site"), url.own_site(link).alias("own"))


# ---- places

ZIP = "(10000 + c_custkey * 37 % 44000)::varchar"
ADDRESS = f"c_name || ', Ulica ' || c_nationkey || ', ' || {ZIP} || ' ' || c_mktsegment"


def addressed(spark, sf_dir):
    code = (10000 + F.col("c_custkey") * 37 % 44000).cast("string")
    address = F.concat("c_name", F.lit(", Ulica "), F.col("c_nationkey"), F.lit(", "), code, F.lit(" "), "c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", address.alias("address"), F.concat(F.left(code, F.lit(2)), F.lit(" "), F.substring(code, 3, 3)).alias("code"))


@query(
    "g01_addresses",
    f"""select c_custkey, c_mktsegment as city, 'Ulica ' || c_nationkey || ', ' || {ZIP} || ' ' || c_mktsegment as tail, {ZIP} as zip,
        trim(regexp_replace(lower({ADDRESS}), '[^a-z0-9]+', ' ', 'g')) as norm from customer""",
)
def g01(spark, sf_dir):
    a = F.col("address")
    return addressed(spark, sf_dir).select("c_custkey", place.city_from_address(a).alias("city"), place.address_tail(a).alias("tail"), place.zip_from(F.col("code")).alias("zip"), place.norm_address(a).alias("norm"))


COUNTIES = ", ".join(f"('{k}', '{v}')" for k, v in place.POSTCODE_COUNTY.items())


@query(
    "g05_postcode_counties",
    f"""with m(p, county) as (values {COUNTIES}) select c_custkey, coalesce(county, '') as counties, coalesce(county in ('grad zagreb', 'zagrebacka'), false) as capital
        from customer left join m on p = left({ZIP}, 2)""",
)
def g05(spark, sf_dir):
    found = F.col("found")
    a = addressed(spark, sf_dir).select("c_custkey", place.postcode_counties(F.col("address")).alias("found"))
    capital = place.counties_compatible(F.coalesce(F.get(found, F.lit(0)), F.lit("")), F.lit("Zagrebačka županija"))
    return a.select("c_custkey", F.array_join("found", ",").alias("counties"), capital.alias("capital"))


@query("g09_years", "select o_orderkey, year(o_orderdate)::int as founded, year(o_orderdate)::int as epoch from orders")
def g09(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", place.parse_year(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("founded"), place.epoch_year(F.unix_timestamp("o_orderdate")).alias("epoch"))


LAT, LNG = "41.5 + ({0} * 7 % 600) / 100.0", "13.0 + ({0} * 11 % 700) / 100.0"
HAVERSINE = """2 * 6371000.0 * asin(sqrt(pow(sin(radians(({2}) - ({0})) / 2), 2) + cos(radians({0})) * cos(radians({2})) * pow(sin(radians(({3}) - ({1})) / 2), 2)))"""


def located(df, key):
    k = F.col(key)
    return df.select(key, (F.lit(41.5) + (k * 7 % 600) / 100.0).alias("lat"), (F.lit(13.0) + (k * 11 % 700) / 100.0).alias("lng"))


@query(
    "g11_distances",
    f"""with s as (select c_custkey, {LAT.format('c_custkey')} as lat, {LNG.format('c_custkey')} as lng from customer),
          d as (select *, case when c_custkey % 10 > 0 then {HAVERSINE.format('lat', 'lng', 'lat + (c_custkey % 10) / 1000.0', 'lng')} end as m from s)
        select c_custkey, round(m, 3) as metres, case when m is null then 'no_data' when m < 50 then 'agree' when m < 250 then 'near' when m < 1000 then 'minor' when m < 10000 then 'major' else 'far' end as bucket,
          lat between 42.30 and 46.60 and lng between 13.40 and 19.50 as inside, printf('%.5f,%.5f', lat, lng) as key from d""",
)
def g11(spark, sf_dir):
    s = located(table(spark, sf_dir, "customer"), "c_custkey")
    step = F.nullif(F.col("c_custkey") % 10, F.lit(0)) / 1000.0
    m = place.haversine_m(F.col("lat"), F.col("lng"), F.col("lat") + step, F.col("lng"))
    return s.select(
        "c_custkey", F.round(m, 3).alias("metres"), place.distance_bucket(m).alias("bucket"), place.in_bounds(F.col("lat"), F.col("lng")).alias("inside"), place.norm_latlng(F.col("lat"), F.col("lng")).alias("key")
    )


# ---- markup, colours


#: References by name with what they stand for, and C1 numbers, as one row that a query joins.
ENTS = "ents as (select [{}] as k, [{}] as v, [{}] as c1)".format(*[
    ", ".join("'" + x.replace("'", "''") + "'" for x in xs) for xs in (pages.NAMES, pages.NAMES.values(), [pages.INSTEAD[n] for n in range(128, 160)])
])
_REF = "regexp_extract(p, '" + pages.REFERENCE.replace("^&", "^") + "')"
_DIGITS = f"regexp_replace({_REF}, '^#[xX]?0*|;$', '', 'g')"
_NUM = f"(case when length({_DIGITS}) > 9 then 1114112 when {_DIGITS} = '' then 0 when {_REF}[2] in ('x', 'X') then ('0x' || {_DIGITS})::bigint else {_DIGITS}::bigint end)"
_CHAR = f"""(case when {_NUM} = 0 then '\uFFFD' when {_NUM} between 128 and 159 then c1[{_NUM} - 127] when {_NUM} between 55296 and 57343 or {_NUM} > 1114111 then '\uFFFD'
  when {_NUM} between 1 and 8 or {_NUM} = 11 or {_NUM} between 14 and 31 or {_NUM} = 127 or {_NUM} between 64976 and 65007 or {_NUM} % 65536 >= 65534 then '' else chr({_NUM}::int) end)"""
_PIECE = f"""(case when {_REF} = '' then '&' || p when {_REF}[1] = '#' then {_CHAR} || substr(p, length({_REF}) + 1) when list_contains(k, {_REF}) then v[list_position(k, {_REF})] || substr(p, length({_REF}) + 1)
  when regexp_extract({_REF}, '^(?:{pages.LEGACY})') <> '' then v[list_position(k, regexp_extract({_REF}, '^(?:{pages.LEGACY})'))] || substr(p, length(regexp_extract({_REF}, '^(?:{pages.LEGACY})')) + 1) else '&' || p end)"""
_SPACES = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
#: SQL of unescape and of html_text, over a query with ents in it.
UNESCAPE = lambda x: f"array_to_string(list_concat([string_split({x}, '&')[1]], list_transform(string_split({x}, '&')[2:], lambda p: {_PIECE})), '')"
SQUEEZE = lambda x: f"trim(regexp_replace({x}, '{_SPACES}', ' ', 'g'))"


@query(
    "h02_html_text",
    rf"""with {ENTS}, t as (select page_id, regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') as s,
          regexp_extract(html, '(?is)<title>(.*?)</title>', 1) as title from pages)
        select page_id, md5({SQUEEZE(UNESCAPE("s"))}) as visible, nullif(trim(title), '') as title from t, ents""",
)
def h02(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(markup.html_text(F.col("html"))).alias("visible"), markup.html_title(F.col("html")).alias("title"))


@query("h05_json", "select event_id, (props->>'$.k')::bigint as k, coalesce(props->>'$.missing', '-') as missing from events")
def h05(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long, missing string").alias("p"))
    return e.select("event_id", "p.k", F.coalesce("p.missing", F.lit("-")).alias("missing"))


CHANNEL = "case when {0} / 255.0 <= 0.03928 then {0} / 255.0 / 12.92 else pow(({0} / 255.0 + 0.055) / 1.055, 2.4) end"


@query(
    "c01_colours",
    f"""with t as (select p_partkey, (p_partkey * 37 % 256)::int as r, (p_partkey * 59 % 256)::int as g, (p_partkey * 83 % 256)::int as b from part)
        select p_partkey, printf('#%02X%02X%02X', r, g, b) as hex, round(0.2126 * ({CHANNEL.format('r')}) + 0.7152 * ({CHANNEL.format('g')}) + 0.0722 * ({CHANNEL.format('b')}), 9) as luminance,
          least(abs(r - g), 360 - abs(r - g))::int as apart, (case when r >= 1024 then 1024 when r >= 192 then 192 end)::int as size from t""",
)
def c01(spark, sf_dir):
    k = F.col("p_partkey")
    t = table(spark, sf_dir, "part").select("p_partkey", *[(k * m % 256).cast("int").alias(n) for n, m in (("r", 37), ("g", 59), ("b", 83))])
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    return t.select("p_partkey", colour.hex_of(r, g, b).alias("hex"), F.round(colour.luminance(r, g, b), 9).alias("luminance"), colour.hue_distance(r, g).alias("apart"), colour.largest_size(r).alias("size"))


# ---- projections


@query(
    "f05_reachability",
    """select c_custkey, (c_acctbal > 0)::int + (c_nationkey > 5)::int + (c_mktsegment = 'BUILDING')::int as score, (c_acctbal > 0 and c_nationkey > 5 and c_mktsegment = 'BUILDING') as is_full,
       concat_ws(' · ', case when c_acctbal > 0 then 'in credit' end, c_mktsegment, case when c_nationkey > 5 then 'nation ' || c_nationkey end) as line from customer""",
)
def f05(spark, sf_dir):
    flags = [F.col("c_acctbal") > 0, F.col("c_nationkey") > 5, F.col("c_mktsegment") == "BUILDING"]
    line = F.concat_ws(" · ", F.when(flags[0], "in credit"), "c_mktsegment", F.when(flags[1], F.concat(F.lit("nation "), "c_nationkey")))
    score = sum((f.cast("int") for f in flags), F.lit(0))
    return table(spark, sf_dir, "customer").select("c_custkey", score.alias("score"), (flags[0] & flags[1] & flags[2]).alias("is_full"), line.alias("line"))


@query(
    "f15_keep_and_tier",
    """select p_partkey, not regexp_matches(lower(p_type), 'promo|small') as keep, (case when regexp_matches(lower(p_type), '^economy') then 4 when regexp_matches(lower(p_type), '^standard') then 3 else 8 end)::int as tier,
       case when contains(lower(p_type), 'promo') then 'promotion' when contains(lower(p_type), 'small') then 'small' else 'kept' end as reason from part""",
)
def f15(spark, sf_dir):
    low = F.lower("p_type")
    tier = F.when(F.rlike(low, F.lit("^economy")), 4).when(F.rlike(low, F.lit("^standard")), 3).otherwise(8)
    reason = F.when(low.contains("promo"), "promotion").when(low.contains("small"), "small").otherwise("kept")
    return table(spark, sf_dir, "part").select("p_partkey", (~F.rlike(low, F.lit("promo|small"))).alias("keep"), tier.alias("tier"), reason.alias("reason"))
