"""Collision reports, audit prompts, sitemaps and cached searches over the test tables, each with DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.operators import audit, matching, reports, resolve
from kartoteka.operators.shared import shared_dir
from kartoteka.plans.clubs import CLUBS, clubs
from kartoteka.plans.registry import query
from kartoteka.plans.resolution import REASONS, SCORED, VERDICTS, entities
from kartoteka.session import table
from kartoteka.sources import landing, payloads, snapshots

# ---- collisions

#: The verdicts with what their scores are made of.
EXPLAINED = VERDICTS.replace(SCORED, SCORED.replace(" as score", f" as score, {REASONS} as reasons")).replace(
    "as score from c left join", "as score, concat_ws('; ', nullif(reasons, ''), case when o.id is not null and verdict <> 'owner' then '+3 owner among the same members' end) as reasons from c left join"
)


@query("k07_collision_rows", f"with {EXPLAINED} select field || ':' || key as group_key, field, key, v.id, n.name as canonical_name, coalesce(n.city, '') as city, score::int as score, reasons, verdict from v join e n on n.id = v.id")
def k07_rows(spark, sf_dir):
    e = entities(spark, sf_dir)
    return reports.collision_rows(resolve.detect(e), e, ["canonical_name", "city"])


@query(
    "k07_collision_summary",
    f"""with {VERDICTS}, f as (select field, count(distinct key) as g, count(*) as n, count(*) filter (verdict = 'owner') as o, count(*) filter (verdict = 'orphan') as l, count(*) filter (verdict = 'ambiguous') as a, count(distinct id) filter (verdict = 'orphan') as c from v group by 1)
       select (select count(*) from e)::bigint as clubs_total, sum(g)::bigint as groups_total, sum(n)::bigint as rows, (select count(distinct id) from v where verdict = 'orphan')::bigint as clubs_with_any_orphan,
         '{{' || string_agg('"' || field || '":{{"groups":' || g || ',"owner":' || o || ',"orphan":' || l || ',"ambiguous":' || a || ',"clubs_losing_value":' || c || '}}', ',' order by field) || '}}' as by_field from f""",
)
def k07_summary(spark, sf_dir):
    e = entities(spark, sf_dir)
    return reports.collision_summary(resolve.detect(e), e)


# ---- audits

SIZES = {1: 3, 3: 2, 4: 2, 5: 2, 6: 3, 7: 2, 8: 1}
INTRO = "Check every field of these clubs."
_TIERED = """t as (select *, 'c' || id as slug, (1 + id % 8)::int as tier, case when id % 3 = 0 then '' when id % 3 = 1 then '01 ' || id end as phone, case when id % 4 > 0 then (id % 4 - 1) * 100 end::int as stadium_capacity, 'T' || (1 + id % 8) || ': L (2025)' as leagues from clubs)"""
_SAMPLE = f"""s0 as (select * from t where tier in ({", ".join(map(str, SIZES))})
  qualify row_number() over (partition by tier order by md5(id || ':42'), id) <= case tier {" ".join(f"when {t} then {n}" for t, n in SIZES.items())} end),
  s as (select *, row_number() over (order by tier, name, id) - 1 as place from s0)"""


def _tiered(spark, sf_dir) -> DataFrame:
    k = F.col("id")
    return clubs(spark, sf_dir).select(
        "id", F.col("name").alias("canonical_name"), F.concat(F.lit("c"), k).alias("slug"), (1 + k % 8).cast("int").alias("tier"), "city", "county",
        F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("01 "), k)).alias("phone"), F.when(k % 4 > 0, (k % 4 - 1) * 100).cast("int").alias("stadium_capacity"),
        F.concat(F.lit("T"), 1 + k % 8, F.lit(": L (2025)")).alias("leagues"),
    )


def _sample(spark, sf_dir) -> DataFrame:
    order = F.struct(F.md5(F.concat(F.col("id").cast("string"), F.lit(":42"))), F.col("id"))
    picked = audit.stratified_sample(_tiered(spark, sf_dir), "tier", SIZES, order).drop("place")
    return reports.batched(picked, 4, F.col("tier"), F.col("canonical_name"), F.col("id"))


@query(
    "k15_audit_prompts",
    rf"""with {CLUBS}, {_TIERED}, {_SAMPLE}, c as (select place, ('ABCD')[place % 4 + 1] as batch, concat_ws(chr(10), 'CLUB: ' || name || ' (slug=' || slug || ', tier=' || tier || ')', '  city: ' || nullif(city, ''), '  county: ' || nullif(county, ''),
         '  phone: ' || nullif(phone, ''), '  stadium_capacity: ' || nullif(stadium_capacity, 0), '  leagues: ' || leagues) as card from s)
       select batch, '{INTRO}' || chr(10) || chr(10) || '== CLUBS TO VERIFY ==' || chr(10) || chr(10) || string_agg(card, chr(10) || chr(10) order by place) || chr(10) as prompt from c group by batch""",
)
def k15_prompts(spark, sf_dir):
    return reports.prompts(_sample(spark, sf_dir), INTRO, "leagues")


@query(
    "k15_sample_meta",
    f"""with {CLUBS}, {_TIERED}, {_SAMPLE} select '{{"seed":42,"strata":[{",".join(f"[{t},{n}]" for t, n in SIZES.items())}],"batches":4,"clubs":[' || string_agg('{{"slug":"' || slug || '","tier":' || tier || ',"batch":"' || ('ABCD')[place % 4 + 1] || '"}}', ',' order by place) || ']}}' as meta from s""",
)
def k15_meta(spark, sf_dir):
    return reports.sample_meta(_sample(spark, sf_dir), 42, SIZES, 4)


@query(
    "k15_audit_report",
    f"""with {CLUBS}, {_TIERED}, {_SAMPLE}, r as (select slug, (id % 5) * 0.25 as overall, case when id % 3 = 0 then 'phone' when id % 3 = 1 then '' end as issues, case when id % 4 < 3 then (id % 4) * 0.5 end as identity, (id % 3) * 0.5 as location, null::double as contact from t),
       h as (select count(*) as n, round_even(avg(overall) * 100, 1) as score from r), d as (select 1 as k, 'identity' as name, round_even(round(avg(identity) * 100, 6), 1) as v from r union all select 2, 'location', round_even(round(avg(location) * 100, 6), 1) from r union all select 3, 'contact', avg(contact) from r)
       select 1 as part, 0::double as rank, '' as slug, '# Pipeline verification report — 2025-01-01' || chr(10) || chr(10) || 'Sample size: **' || n || '** clubs (stratified by tier)' || chr(10) || '**Overall pipeline reliability: ' || score || ' / 100**' || chr(10) || chr(10)
         || '## Dimension scores' || chr(10) || chr(10) || '| Dimension | Score | Stars |' || chr(10) || '|---|---:|---|' as line from h
       union all select 2, k, '', '| ' || name || ' | ' || case when v is null then 'n/a | —' else v || ' | ' || repeat('★', round_even(v / 10, 0)::int) end || ' |' from d
       union all select 3, -overall, r.slug, '| ' || r.slug || ' | T' || coalesce(s.tier::varchar, '?') || ' | ' || printf('%.2f', overall::double) || ' | ' || coalesce(nullif(issues, ''), '—') || ' |' from r left join s using (slug)""",
)
def k15_report(spark, sf_dir):
    k = F.col("id")
    r = _tiered(spark, sf_dir).select(
        "slug", ((k % 5) * 0.25).alias("overall"), F.when(k % 3 == 0, "phone").when(k % 3 == 1, "").alias("issues"), F.when(k % 4 < 3, (k % 4) * 0.5).alias("identity"),
        ((k % 3) * 0.5).alias("location"), F.lit(None).cast("double").alias("contact"),
    )
    return reports.report_lines(r, _sample(spark, sf_dir), ["identity", "location", "contact"], "2025-01-01")


# ---- sitemaps, searches, persons


@query(
    "k06_sitemap",
    f"""with {CLUBS}, p(path, priority, freq) as (select '/', '1.0', 'weekly' union all select '/klub/c' || id || '&x=<' || id || '>', '0.7', 'monthly' from clubs
         union all select distinct '/zupanija/' || replace(url_encode(county), '%2F', '/'), '0.6', 'monthly' from clubs where county is not null)
       select 'sitemap.xml' as file, 1 as place, '<url><loc>https://k.hr' || replace(replace(replace(path, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</loc><lastmod>2025-01-01</lastmod><changefreq>' || freq || '</changefreq><priority>' || priority || '</priority></url>' as line from p
       union all select 'sitemap.xml', 0, '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">' union all select 'sitemap.xml', 2, '</urlset>'
       union all select 'robots.txt', 0, 'User-agent: *' || chr(10) || 'Allow: /' union all select 'robots.txt', 2, chr(10) || 'Sitemap: https://k.hr/sitemap.xml'""",
)
def k06(spark, sf_dir):
    c = clubs(spark, sf_dir)
    page = lambda df, path, priority, freq: df.select(path.alias("path"), F.lit(priority).alias("priority"), F.lit(freq).alias("freq"))
    own = page(c, F.concat(F.lit("/klub/c"), "id", F.lit("&x=<"), "id", F.lit(">")), "0.7", "monthly")
    county = page(c.select("county").filter("county is not null").distinct(), F.concat(F.lit("/zupanija/"), snapshots.path_part(F.col("county"))), "0.6", "monthly")
    return snapshots.sitemap_lines(page(spark.range(1), F.lit("/"), "1.0", "weekly").unionAll(own).unionAll(county), "https://k.hr", "2025-01-01")


@query(
    "s06_cached_searches",
    """with q as (select c_custkey as id, case when c_custkey % 7 > 0 then c_name || ' "x" č' end as query from customer),
       cache as (select left(sha256('{"limit": 5, "query": "' || c_name || ' \\"x\\" č"}'), 16) as k, c_custkey % 6 as m, c_custkey from customer where c_custkey % 5 > 0),
       f as (select q.id, case when m is null then 'unasked' when m = 0 then 'miss' when m = 1 then 'broken' when m = 2 then 'none' else 'hit' end as status, m from q left join cache c on c.k = left(sha256('{"limit": 5, "query": "' || replace(query, '"', '\\"') || '"}'), 16))
       select id, status, null::int as place, null as url, null as title from f where status <> 'hit' union all select id, status, i::int, case i when 0 then 'https://a' || id || '.hr' else 'https://b.hr' end, case i when 0 then 'A' end from f, (select unnest([0, 1]) as i) where status = 'hit'""",
)
def s06(spark, sf_dir):
    k, c = F.col("c_custkey"), table(spark, sf_dir, "customer")
    asked = F.concat("c_name", F.lit(' "x" č'))
    answer = F.when(k % 6 == 1, '{"data": {"web": [').when(k % 6 == 2, '{"data": {"web": []}}').when(k % 6 > 2, F.concat(F.lit('{"data": {"web": [{"url": "https://a'), k, F.lit('.hr", "title": "A"}, {"url": "https://b.hr"}]}}')))
    cache = c.filter(k % 5 > 0).select(payloads.search_key(asked, F.lit(5)).alias("cache_key"), answer.alias("payload"))
    return payloads.cached_searches(c.select(k.alias("id"), F.when(k % 7 > 0, asked).alias("query"), F.lit(5).alias("limit")), cache, "id")


CAPACITIES = ("tajnik", "Predsjednik kluba", "osoba ovlaštena za zastupanje", "likvidator", "zamjenik, član")


@query(
    "s12_persons_dump",
    f"""with p as (select o_custkey::varchar as udr_id, 'I "' || (o_orderkey % 10) || '"' as first_name, 'P, ' || o_orderkey as last_name, upper(({list(CAPACITIES)})[o_orderkey % 5 + 1]) as c, o_orderkey from orders),
       r as (select *, case when contains(c, 'PREDSJEDNIK') then 0 when contains(c, 'OVLAŠTEN') then 1 when contains(c, 'ZAMJENIK') then 2 else 99 end as rank from p where not contains(c, 'LIKVIDATOR'))
       select udr_id, first_name, last_name, rank::int as rank from r qualify row_number() over (partition by udr_id order by rank, o_orderkey) = 1""",
)
def s12(spark, sf_dir):
    """A dump of persons written and read back; of equal ranks the first in the files counts."""
    k = F.col("o_orderkey")
    capacity = F.get(F.array(*map(F.lit, CAPACITIES)), (k % 5).cast("int"))
    p = table(spark, sf_dir, "orders").select(
        k, F.col("o_custkey").alias("UDR_ID"), F.concat(F.lit('I "'), k % 10, F.lit('"')).alias("IME"), F.concat(F.lit("P, "), k).alias("PREZIME"), capacity.alias("SVOJSTVO"), F.lit(None).cast("string").alias("FUNKCIJA")
    )
    path = f"{shared_dir(spark)}/persons-{uuid.uuid4().hex}"
    p.repartitionByRange(k).sortWithinPartitions(k).drop("o_orderkey").write.option("header", True).option("escape", '"').csv(path)
    return matching.best_person(landing.persons(spark, path), F.col("place"))
