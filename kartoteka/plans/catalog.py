"""Club pages, cached answers of several shapes, repairs over versions, stored indexes: queries, each with DuckDB SQL.

Payloads are texts that both engines build by the same expression, from the test tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.functions import pages
from kartoteka.operators import audit, matching, repair, resolve, search, state
from kartoteka.operators.shared import shared_dir
from kartoteka.plans import resolution
from kartoteka.plans.clubs import CLUBS, clubs
from kartoteka.plans.registry import query
from kartoteka.plans.scalars import ENTS, SQUEEZE, UNESCAPE
from kartoteka.session import table
from kartoteka.sources import payloads

# ---- club pages

#: A club's header of a page's own title and id, before the page itself, whose markup must not disturb it.
_TITLE = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
_HEAD = f"""'<div class="page clubHeader"><div class=basic_info><div class="logo x"><img alt="a > b" src="/l/' || cast(page_id as string) || '.png?a=1&amp;b=2"></div><div class=''title''><h1>' || {_TITLE}
  || '</h1><h2>Klub&nbsp;<b>' || cast(page_id as string) || '</b> &amp;amp; &Scaron;</h2></div></div><div class="info"><ul><li class="foundation_date"><h3>0' || cast(1 + page_id % 9 as string) || '.05.' || cast(1900 + page_id % 120 as string)
  || '.</h3></li><li class="address"><h3>' || case when page_id % 3 = 0 then 'Trg 1, &#268;akovec' when page_id % 3 = 1 then '' else 'Put ' || cast(page_id as string) end || '</h3><br></li><li class="stadium"><h3>Uz <i>put</i></h3></li><li class="phone"><h3>'
  || case when page_id % 5 = 0 then '032 ' || cast(page_id as string) else '<a href="tel:+385' || cast(page_id as string) || '">nazovi</a>' end || '</h3></li></ul></div>'
  || case when page_id % 7 = 0 then '<div id="club_map" data-coordinates-x="x" data-coordinates-y="1"></div>' when page_id % 7 = 1 then '' else '<div id=club_map data-coordinates-x="45.' || cast(page_id as string) || '" data-coordinates-y="16.5"></div>' end || '</div>'"""


@query(
    "h01_club_page",
    f"""with {ENTS} select page_id, nullif({SQUEEZE(UNESCAPE(f"regexp_replace({_TITLE}, '<[^>]*>', ' ', 'g')"))}, '') as short_name, 'Klub ' || page_id || ' &amp; Š' as full_name, '0' || (1 + page_id % 9) || '.05.' || (1900 + page_id % 120) || '.' as founded_date,
       (1900 + page_id % 120)::int as founded_year, case page_id % 3 when 0 then 'Trg 1, Čakovec' when 1 then null else 'Put ' || page_id end as address, 'Uz put' as stadium_name,
       case when page_id % 5 = 0 then '032 ' || page_id else '+385' || page_id end as phone, case when page_id % 7 > 1 then ('45.' || page_id)::double end as lat, case when page_id % 7 > 1 then 16.5::double end as lng, '/l/' || page_id || '.png?a=1&b=2' as logo_url
       from pages, ents""",
)
def h01(spark, sf_dir):
    page = F.concat(F.expr(_HEAD), F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", pages.club_page(page).alias("f")).select("page_id", "f.*")


@query("g10_date_years", "select o_orderkey, case when o_orderkey % 7 = 0 then null else year(o_orderdate)::int end as year from orders")
def g10(spark, sf_dir):
    k = F.col("o_orderkey")
    written = F.when(k % 7 == 0, F.date_format("o_orderdate", "yyyy/MM")).otherwise(F.concat(F.lit("osnovan "), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit(".")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(F.regexp_extract(written, r"[0-9]{2}\.[0-9]{2}\.([0-9]{4})", 1), F.lit("")).cast("int").alias("year"))


# ---- payloads

_K = "cast(c_custkey as string)"
_LAT = "cast(40 + c_custkey % 7 as string) || '.25'"
TEAM = f"""case when c_custkey % 11 = 0 then '' when c_custkey % 13 = 0 then '{{"team": {{"id": ' || {_K} when c_custkey % 17 = 0 then '{{"team": null}}' when c_custkey % 5 = 0 then '{{"id": ' || {_K} || ', "venue": null}}'
  when c_custkey % 5 = 1 then '{{"id": ' || {_K} || ', "venue": {{"venueCoordinates": {{"latitude": "' || {_LAT} || '", "longitude": 16.5}}}}}}'
  when c_custkey % 2 = 0 then '{{"team": {{"id": ' || {_K} || ', "venue": {{"venueCoordinates": {{"latitude": ' || {_LAT} || ', "longitude": 16}}}}}}, "pregameForm": null}}'
  else '{{"id": ' || {_K} || ', "venue": {{"venueCoordinates": {{"latitude": ' || {_LAT} || ', "longitude": 15.75}}}}}}' end"""


def _asked(spark, sf_dir, payload: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.expr(payload).alias("payload"))


@query(
    "s09_team_coordinates",
    f"""with p as (select c_custkey as id, {TEAM} as payload from customer), j as (select *, case when json_valid(payload) then payload::json end as v from p),
       t as (select *, case when json_exists(v, '$.team') then v->'$.team' else v end as t from j), c as (select *, t->'$.venue.venueCoordinates.latitude' as la, t->'$.venue.venueCoordinates.longitude' as lo from t),
       n as (select *, json_type(la) in ('DOUBLE', 'UBIGINT', 'BIGINT') and json_type(lo) in ('DOUBLE', 'UBIGINT', 'BIGINT') as "both" from c)
       select id, case when payload = '' then 'miss' when v is null then 'broken' else 'hit' end as status, (t->>'$.id')::bigint as team_id, case when "both" then la::varchar::double end as lat, case when "both" then lo::varchar::double end as lng from n""",
)
def s09(spark, sf_dir):
    return payloads.team_coordinates(_asked(spark, sf_dir, TEAM), "id")


LEAGUES = """'[{"id": ' || cast(n_nationkey as string) || ', "name": "' || n_name || '", "shortName": "x", "priority": ' || cast(n_regionkey as string) || ', "leagues": [{"name": "1. ' || n_name || '", "seasonId": ' || cast(100 + n_nationkey as string)
  || ', "isCup": false, "hidden": ' || case when n_nationkey % 4 = 0 then 'true' else 'false' end || '}, {"name": "Kup", "isCup": true}]}, {"id": 900, "name": "empty", "leagues": []}, {"id": 901}]'"""


@query(
    "s05_county_leagues",
    """select n_nationkey, n_nationkey::bigint as county_id, n_name as county, n_regionkey::int as priority, case i when 1 then '1. ' || n_name else 'Kup' end as league, case when i = 1 then 100 + n_nationkey end::bigint as season_id, i = 2 as is_cup, i = 1 and n_nationkey % 4 = 0 as hidden
       from nation, (select unnest([1, 2]) as i)""",
)
def s05(spark, sf_dir):
    return payloads.county_leagues(table(spark, sf_dir, "nation").select("n_nationkey", F.expr(LEAGUES).alias("payload")), "n_nationkey")


#: A table of teams below a name or by itself; some teams without a name.
TABLE = """case when s_suppkey % 10 = 0 then '[' when s_suppkey % 2 = 0 then '{"teamStandings": [' || t || ']}' else '[' || t || ']' end"""
_TEAMS = """'{"teamId": ' || cast(s_suppkey as string) || ', "teamName": " ' || s_name || ' "}, {"teamId": 7, "teamName": ""}, {"teamName": "z"}, {"teamId": ' || cast(s_suppkey + 1 as string) || ', "teamName": "B"}'"""


@query("s08_standings", "select s_suppkey, unnest([s_suppkey, s_suppkey + 1])::bigint as team_id, unnest([trim(s_name), 'B']) as team_name from supplier where s_suppkey % 10 > 0")
def s08(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").withColumn("t", F.expr(_TEAMS))
    return payloads.standings(s.select("s_suppkey", F.expr(TABLE).alias("payload")), "s_suppkey")


HITS = f"""case when c_custkey % 9 = 0 then '' when c_custkey % 9 = 1 then '{{"data": [' when c_custkey % 9 = 2 then '{{"data": []}}' when c_custkey % 9 = 3 then '{{"error": 1}}'
  when c_custkey % 9 in (4, 5) then '{{"data": [{{"idorg": 1}}, {{"idorg": ' || {_K} || '}}]}}' else '{{"data": [{{"idorg": ' || {_K} || ', "naziv": "NK"}}]}}' end"""


@query(
    "s16_registry_hits",
    """select c_custkey as id, case k when 0 then 'miss' when 1 then 'broken' when 2 then 'none' when 3 then 'none' when 4 then 'several' when 5 then 'several' else 'one' end as status, case when k > 5 then 1 when k > 3 then 2 else 0 end::int as hits,
       case when k > 5 then c_custkey end as hit from (select c_custkey, c_custkey % 9 as k from customer)""",
)
def s16(spark, sf_dir):
    return payloads.only_hit(_asked(spark, sf_dir, HITS).withColumnRenamed("id", "c_custkey"), "c_custkey", "idorg").select(F.col("c_custkey").alias("id"), "status", "hits", F.col("id").alias("hit"))


@query("e19_search_hits", f"with p as (select c_custkey as id, {HITS} as payload from customer) select id, (payload->>'$.data[0].idorg')::bigint as hit from p where json_valid(payload) and json_array_length(payload, '$.data') = 1")
def e19(spark, sf_dir):
    found = payloads.only_hit(_asked(spark, sf_dir, HITS).withColumnRenamed("id", "c_custkey"), "c_custkey", "idorg")
    return found.filter("status = 'one'").select(F.col("c_custkey").alias("id"), F.col("id").alias("hit"))


BODY = "'{\"textQuery\": \"' || s_name || '\"}'"
ANSWER = """case when s_suppkey % 6 = 0 then '{"places": []}' when s_suppkey % 6 = 1 then '{"results": [{"formatted_address": "' || s_name || '", "geometry": {"location": {"lat": 45.5, "lng": ' || cast(s_suppkey as string) || '}}}]}'
  when s_suppkey % 6 = 2 then '{' else '{"places": [{"displayName": {"text": "' || s_name || '"}, "location": {"latitude": 44.5, "longitude": ' || cast(s_suppkey as string) || '}}, {"id": 2}]}' end"""


@query(
    "s19_cached_places",
    f"""with cache as (select left(sha256('places|' || {BODY}), 16) as cache_key, s_suppkey % 6 as k, s_suppkey, s_name from supplier where s_suppkey % 5 > 0)
       select a.s_suppkey as id, case when k is null then 'unasked' when k = 0 then 'none' when k = 2 then 'broken' else 'hit' end as status, case when k in (1, 3, 4, 5) then c.s_name end as name,
         case when k = 1 then 45.5 when k > 2 then 44.5 end::double as lat, case when k in (1, 3, 4, 5) then c.s_suppkey end::double as lng from supplier a left join cache c on c.cache_key = left(sha256('places|' || {BODY.replace("s_name", "a.s_name")}), 16)""",
)
def s19(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    cache = s.filter("s_suppkey % 5 > 0").select(payloads.request_key("places", F.expr(BODY)).alias("cache_key"), F.expr(ANSWER).alias("payload"))
    return payloads.cached_places(s.select(F.col("s_suppkey").alias("id"), F.expr(BODY).alias("body")), cache, "id", "places")


IMAGES = """case when p_partkey % 8 = 0 then '{"query": {"pages": {"-1": {"title": "' || p_name || '", "missing": ""}}}}' when p_partkey % 8 = 1 then '{"batchcomplete": ""}' when p_partkey % 8 = 2 then null
  else '{"query": {"pages": {"' || cast(p_partkey as string) || '": {"title": "' || p_name || '", "original": {"source": "https://example.hr/' || cast(p_partkey as string) || '.svg"}}, "-2": {"title": "other"}}}}' end"""


@query(
    "s24_page_images",
    """select p_partkey as id, case when p_partkey % 8 < 2 then 'none' when p_partkey % 8 = 2 then 'miss' else 'hit' end as status, case when p_partkey % 8 > 2 then p_name end as title,
       case when p_partkey % 8 > 2 then 'https://example.hr/' || p_partkey || '.svg' end as source from part""",
)
def s24(spark, sf_dir):
    return payloads.page_images(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.expr(IMAGES).alias("payload")), "id")


# ---- filters, persons, external ids, margins, samples

_SHOWN = """select id, name as canonical_name, cast(null as string) as short_name, city, county, 1 + id % 9 as top_tier, case when id % 3 = 0 then 'mobile' when id % 3 = 1 then 'landline' end as phone_kind,
  case when id % 3 < 2 then '09' || id end as phone, case when id % 2 = 0 then 'a@b.hr' when id % 5 = 0 then '' end as email, case when id % 7 > 0 then city end as address, case when id % 4 = 0 then 'x.hr' end as website, cast(null as string) as fb_url, case when id % 4 = 1 then 'i' end as ig_url from clubs"""
_DEBURR = lambda x: f"lower(strip_accents({x}))"


@query(
    "f02_client_filter",
    f"""with {CLUBS}, s as ({_SHOWN}), parts(part, id) as (select 'tier', id from s where top_tier = 3 and county = 'Grad Zagreb' union all select 'query', id from s where contains({_DEBURR("canonical_name || '  ' || coalesce(city, '') || ' ' || coalesce(county, '')")}, 'cakov')
         union all select 'full', id from s where phone_kind = 'mobile' and phone <> '' and email <> '' and address <> '' and (website <> '' or ig_url <> ''))
       select part, id from parts""",
)
def f02(spark, sf_dir):
    shown = _shown(clubs(spark, sf_dir))
    one = lambda part, **rules: search.client_filter(shown, **rules).select(F.lit(part).alias("part"), "id")
    return one("tier", tier=3, county="Grad Zagreb").unionAll(one("query", query=" Čakov ")).unionAll(one("full", full=True))


def _shown(c: DataFrame) -> DataFrame:
    k = F.col("id")
    none = F.lit(None).cast("string")
    return c.select(
        "id", F.col("name").alias("canonical_name"), none.alias("short_name"), "city", "county", (1 + k % 9).alias("top_tier"), F.when(k % 3 == 0, "mobile").when(k % 3 == 1, "landline").alias("phone_kind"),
        F.when(k % 3 < 2, F.concat(F.lit("09"), k)).alias("phone"), F.when(k % 2 == 0, "a@b.hr").when(k % 5 == 0, "").alias("email"), F.when(k % 7 > 0, F.col("city")).alias("address"), F.when(k % 4 == 0, "x.hr").alias("website"),
        none.alias("fb_url"), F.when(k % 4 == 1, "i").alias("ig_url"),
    )


CAPACITY = "(['predsjednik', 'Dopredsjednik', 'osoba ovlaštena za zastupanje', 'likvidator', 'član', 'ZAMJENIK tajnika', ''])[o_orderkey % 7 + 1]"
_CAPACITIES = ("predsjednik", "Dopredsjednik", "osoba ovlaštena za zastupanje", "likvidator", "član", "ZAMJENIK tajnika", "")


@query(
    "w03_best_person",
    f"""with p as (select o_custkey as udr_id, case when o_orderkey % 11 > 0 then ' ' || o_orderpriority end as first_name, case when o_orderkey % 11 > 1 then o_orderkey::varchar else ' ' end as last_name, upper({CAPACITY}) as c, o_orderkey from orders),
       r as (select *, case when contains(c, 'PREDSJEDNIK') then 0 when contains(c, 'OVLAŠTEN') then 1 when contains(c, 'ZAMJENIK') then 2 else 99 end as rank from p where not contains(c, 'LIKVIDATOR') and trim(coalesce(first_name, '')) || trim(last_name) <> '')
       select udr_id, trim(coalesce(first_name, '')) as first_name, trim(last_name) as last_name, rank::int as rank from r qualify row_number() over (partition by udr_id order by rank, o_orderkey) = 1""",
)
def w03(spark, sf_dir):
    k = F.col("o_orderkey")
    p = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("udr_id"), F.when(k % 11 > 0, F.concat(F.lit(" "), "o_orderpriority")).alias("first_name"), F.when(k % 11 > 1, k.cast("string")).otherwise(" ").alias("last_name"),
        F.get(F.array(*map(F.lit, _CAPACITIES)), (k % 7).cast("int")).alias("capacity"), F.lit(None).cast("string").alias("role"), k,
    )
    return matching.best_person(p, F.col("o_orderkey"))


@query(
    "d02_upsert_external",
    """with old as (select s_suppkey as id, case when s_suppkey % 3 > 0 then 'lg' || (s_suppkey % 40) end as ext, s_name as name, s_suppkey % 4 as tier from supplier),
       new as (select row_number() over (order by n_nationkey) as spot, case when n_nationkey % 5 > 0 then 'lg' || (n_nationkey * 3 % 50) end as ext, n_name as name, n_nationkey % 8 as tier from nation),
       v as (select *, row_number() over (partition by coalesce(ext, '#' || spot) order by spot desc) as k, min(spot) over (partition by coalesce(ext, '#' || spot)) as first from new qualify k = 1),
       m as (select v.*, o.id from v left join (select ext, min(id) as id from old where ext is not null group by ext) o on o.ext = v.ext)
       select old.id, old.ext, coalesce(m.name, old.name) as name, coalesce(m.tier, old.tier)::bigint as tier from old left join m on m.id = old.id
       union all select (select max(id) from old) + row_number() over (order by first), ext, name, tier::bigint from m where id is null""",
)
def d02(spark, sf_dir):
    k, n = F.col("s_suppkey"), F.col("n_nationkey")
    old = table(spark, sf_dir, "supplier").select(k.alias("id"), F.when(k % 3 > 0, F.concat(F.lit("lg"), k % 40)).alias("ext"), F.col("s_name").alias("name"), (k % 4).alias("tier"))
    new = table(spark, sf_dir, "nation").select(F.when(n % 5 > 0, F.concat(F.lit("lg"), n * 3 % 50)).alias("ext"), F.col("n_name").alias("name"), (n % 8).cast("long").alias("tier"), n)
    return state.upsert_external(old, new, "ext", F.col("n_nationkey")).select("id", "ext", "name", "tier")


@query(
    "e04_margin_winner",
    """with p as (select p_partkey as id, list_distinct(string_split(p_name || case when p_partkey % 3 = 0 then ' no' || p_partkey % 50 else '' end, ' ')) as words, p_brand as city from part), a as (select * from p where id % 100 = 0),
       s as (select a.id as l, p.id as r, len(list_intersect(a.words, p.words)) as shared, len(a.words) as na, len(p.words) as nb, a.city = p.city as same from a join p on a.id <> p.id where shared > 0),
       t as (select l, r, shared + case when same then 0.5 else 0 end + case when shared = na then 0.5 else 0 end + case when shared = nb then 0.5 else 0 end as score from s),
       k as (select *, row_number() over (partition by l order by score desc, r) as k, lead(score) over (partition by l order by score desc, r) as second from t)
       select l as l_id, case when coalesce(score - second, 1) >= 0.5 then r end as r_id, case when score - second < 0.5 then 'ambiguous' else 'matched' end as status from k where k = 1""",
)
def e04(spark, sf_dir):
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k.alias("id"), F.array_distinct(F.split(F.concat("p_name", F.when(k % 3 == 0, F.concat(F.lit(" no"), k % 50)).otherwise("")), " ")).alias("words"), F.col("p_brand").alias("city"))
    # The stated query set, every hundredth id, against all rows.
    return matching.margin_match(resolve.best_two(p.filter("id % 100 = 0"), p, F.arrays_overlap("l_words", "r_words"), resolve.overlap_score()))


@query("e20_rescaled_sample", "select doc_id, lang from documents where lang in ('de', 'en', 'es', 'fr') qualify row_number() over (partition by lang order by md5(doc_id || ':7'), doc_id) <= case lang when 'de' then 8 when 'en' then 24 when 'es' then 1 else 5 end")
def e20(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    order = F.struct(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":7"))), F.col("doc_id"))
    return audit.stratified_sample(d, "lang", audit.rescaled({"de": 30, "en": 91, "es": 1, "fr": 20}, 38), order).select("doc_id", "lang")


# ---- the index on disk


def _stored_index(spark, sf_dir, docs: DataFrame | None = None) -> DataFrame:
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    search.write_index(search.build_index(table(spark, sf_dir, "part") if docs is None else docs, "p_partkey", ["p_name", "p_type"]), path)
    return search.read_index(spark, path)


@query("q02_stored_search", r"select p_partkey from part where regexp_matches(lower(p_name || ' ' || p_type), '(^|[^a-z0-9])s') and regexp_matches(lower(p_name || ' ' || p_type), '(^|[^a-z0-9])eco')")
def q02(spark, sf_dir):
    return search.search(_stored_index(spark, sf_dir), "p_partkey", "S éco")


@query("q01_refreshed_index", r"select p_partkey from part where p_partkey % 5 > 0 and (regexp_matches(lower(p_name || ' ' || p_type), '(^|[^a-z0-9])blu') or p_partkey % 5 = 2)")
def q01(spark, sf_dir):
    """Rows that changed are read again, rows that went leave the index; what stayed is not read."""
    p = table(spark, sf_dir, "part")
    changed = p.filter("p_partkey % 5 = 2").withColumn("p_name", F.concat("p_name", F.lit(" blue")))
    fresh = search.refreshed_index(_stored_index(spark, sf_dir), changed, "p_partkey", ["p_name", "p_type"], p.filter("p_partkey % 5 = 0").select("p_partkey"))
    path = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    search.write_index(fresh, path)
    return search.search(search.read_index(spark, path), "p_partkey", "blu")


# ---- repairs over versions

_NULLED = lambda c: f"case when id not in (select id from plan where \"column\" = '{c}') then {c} end as {c}"
#: The plan of all fields the entities have, with the columns of their bundles.
PLAN = f"""{resolution.VERDICTS}, hit as (select distinct id, unnest(case field when 'oib' then ['oib', 'registry'] else [field] end) as col, field || ':' || key as reason from v where verdict = 'orphan'),
  plan as (select e.id, col as "column", case col when 'email' then email when 'oib' then oib when 'registry' then registry else address end as old_value, min(reason) as reason from e join hit on hit.id = e.id where old_value is not null group by all),
  after as (select id, name, city, {_NULLED("email")}, {_NULLED("oib")}, {_NULLED("address")}, {_NULLED("registry")}, sourced from e)"""
#: The same detection over the entities as the first run left them.
AGAIN = PLAN.split("),\n  after")[0].replace(resolution.ENTITIES, "e as (select * from after)") + ")"
_NAMED = "case \"column\" when 'registry' then 'registry_naziv' else \"column\" end"


def _repaired(spark, sf_dir) -> repair.Store:
    store = repair.Store(spark, f"{shared_dir(spark)}/repairs-{uuid.uuid4().hex}")
    store.begin(resolution.entities(spark, sf_dir), "0001")
    store.run("0002")
    return store


@query("d11_second_run", f"with {PLAN} select count(*)::bigint as n from (with {AGAIN} select * from plan)")
def d11_second(spark, sf_dir):
    """What a second run plans after it has detected anew on the version that the first one wrote."""
    return repair.plan(_repaired(spark, sf_dir).clubs()).agg(F.count("*").alias("n"))


@query("d14_repair_history", f"with {PLAN} select '0002' as batch, id, {_NAMED} as field, old_value, null::varchar as new_value, reason from plan")
def d14(spark, sf_dir):
    """The audit rows of all versions, read back."""
    return _repaired(spark, sf_dir).history().select("batch", "id", "field", "old_value", "new_value", "reason")


@query("k14_repaired_version", f"with {PLAN} select id, email, oib, address, registry as registry_naziv from after")
def k14(spark, sf_dir):
    """The newest version; the one before it is the backup."""
    return _repaired(spark, sf_dir).clubs().select("id", "email", "oib", "address", "registry_naziv")


@query("d13_taken_back", f"with {resolution.ENTITIES} select id, email, oib, address, registry as registry_naziv from e")
def d13(spark, sf_dir):
    """A tagged batch taken back exactly, from its audit rows."""
    store = _repaired(spark, sf_dir)
    store.take_back("0002", "0003")
    return store.clubs().select("id", "email", "oib", "address", "registry_naziv")
