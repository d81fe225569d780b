"""Inputs of other formats, scopes and rebuilt tables over the whole test tables: written by a sink, read by its reader, each with DuckDB SQL."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.functions import colour, markup, text
from kartoteka.operators import coverage, resolve, search, state
from kartoteka.operators.shared import shared_dir
from kartoteka.plans.clubs import CLUBS, clubs
from kartoteka.plans.registry import query
from kartoteka.plans.resolution import BUNDLES, QUARANTINE, entities
from kartoteka.session import table
from kartoteka.sources import landing, snapshots


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- schemas, joins, filters

PROFILED = ("customer", "documents", "labels", "pages", "conversations")


@query(
    "s03_schema_profile",
    " union all ".join(
        f"""select '{t}' as "table", c.ordinal_position::int as place, c.column_name as "column", u.n::bigint as filled
            from (unpivot (select count(columns(*)) as '\\0' from {t}) on columns(*) into name k value n) u join information_schema.columns c on c.table_name = '{t}' and c.column_name = u.k"""
        for t in PROFILED
    ),
)
def s03(spark, sf_dir):
    return reduce(DataFrame.unionByName, [coverage.profile(table(spark, sf_dir, t), t) for t in PROFILED])


@query(
    "j03_constant_side",
    """select c_custkey, c_name, o_orderkey, o_totalprice::double as price from customer join orders on o_custkey = c_custkey and o_orderpriority = '1-URGENT' where c_acctbal > 0""",
)
def j03(spark, sf_dir):
    """The constant is a filter of the joined side's scan, so only its rows travel."""
    c = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select("c_custkey", "c_name")
    o = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("double").alias("price"))
    return c.join(o, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "o_orderkey", "price")


PATTERNS = ("%license%", "%click here%", "%@%.com%", "%password_:%", "a%", "%100\\%%")


@query("f07_like_list", f"select doc_id, {' or '.join(f'''coalesce(lower(text), '') like '{x}' escape chr(92)''' for x in PATTERNS)} as listed from documents")
def f07(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.any_like(F.col("text"), PATTERNS).alias("listed"))


@query(
    "f25_scoped_runs",
    """with d as (select doc_id, lang, source from documents), open as (select * from d where doc_id not in (select doc_id from labels where doc_id is not null))
       select 'open' as run, doc_id from open union all select 'lacking', doc_id from open where coalesce(lang, '') = '' or coalesce(source, '') = ''
       union all select 'first', doc_id from (select doc_id from open order by doc_id limit 25) union all select 'named', doc_id from d where doc_id in (1, 2, 3, 100)""",
)
def f25(spark, sf_dir):
    """What four runs would work on: all that is open, those lacking a value, the first 25, and four ids done before or not."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    done = table(spark, sf_dir, "labels").select("doc_id")
    runs = {"open": state.scoped(d, "doc_id", done), "lacking": state.scoped(d, "doc_id", done, missing=("lang", "source")), "first": state.scoped(d, "doc_id", done, limit=25), "named": state.scoped(d, "doc_id", done, refresh=True, only=[1, 2, 3, 100])}
    return reduce(DataFrame.unionByName, [r.select(F.lit(n).alias("run"), "doc_id") for n, r in runs.items()])


# ---- functions

_WORDS = "list_sort(list_distinct(list_filter(string_split_regex(regexp_replace(lower(strip_accents(replace(replace(coalesce({0}, ''), 'đ', 'd'), 'Đ', 'D'))), '[^a-z]+', ' ', 'g'), '[^a-z0-9]+'), lambda w: length(w) >= 4 and w not in ({1}))))"
_GENERIC = ", ".join(f"'{w}'" for w in text.GENERIC_TOKENS)


@query(
    "x13_same_place",
    f"""with {CLUBS}, t as (select id, {_WORDS.format("city", _GENERIC)} as a, {_WORDS.format("county", _GENERIC)} as b from clubs)
        select id, a as city_words, len(list_filter(a, lambda x: len(list_filter(b, lambda y: x = y or (least(length(x), length(y)) >= 6 and left(x, 6) = left(y, 6)))) > 0)) > 0 as same from t""",
)
def x13(spark, sf_dir):
    return clubs(spark, sf_dir).select("id", text.place_tokens(F.col("city")).alias("city_words"), text.same_place(F.col("city"), F.col("county")).alias("same"))


_CHANNEL = "case when {0} / 255.0 <= 0.03928 then {0} / 255.0 / 12.92 else pow(({0} / 255.0 + 0.055) / 1.055, 2.4) end"
_LUM = lambda r, g, b: f"(0.2126 * ({_CHANNEL.format(r)}) + 0.7152 * ({_CHANNEL.format(g)}) + 0.0722 * ({_CHANNEL.format(b)}))"
_OF = lambda n: f"round_even((l - s * least(l, 1 - l) * greatest(-1, least(fmod({n} + h / 30, 12) - 3, 9 - fmod({n} + h / 30, 12), 1))) * 255, 0)::int"


@query(
    "c04_dark_colours",
    f"""with t as (select p_partkey as k, (p_partkey * 37 % 256)::int as r, (p_partkey * 59 % 256)::int as g, (p_partkey * 83 % 256)::int as b from part),
        m as (select *, greatest(r, g, b)::double / 255.0::double as x, least(r, g, b)::double / 255.0::double as n, (greatest(r, g, b) - least(r, g, b))::double as d from t),
        q as (select *, case when d = 0 then 0 when r = greatest(r, g, b) then 60 * fmod((g - b) / d + 6, 6) when g = greatest(r, g, b) then 60 * ((b - r) / d + 2) else 60 * ((r - g) / d + 4) end as h,
          case when d = 0 then 0 when (x + n) / 2 <= 0.5::double then (x - n) / (x + n) else (x - n) / (2 - x - n) end as s from m),
        step as (select k, r as r0, g as g0, b as b0, h, s, unnest([0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15]::double[]) as l from q),
        tried as (select *, {_OF(0)} as r1, {_OF(8)} as g1, {_OF(4)} as b1 from step),
        best as (select * from tried where {_LUM("r1", "g1", "b1")} < 0.6 or l = 0.15 qualify row_number() over (partition by k order by l desc) = 1)
        select k as p_partkey, case when {_LUM("r0", "g0", "b0")} < 0.6 then printf('#%02X%02X%02X', r0, g0, b0) else printf('#%02X%02X%02X', r1, g1, b1) end as hex from best""",
)
def c04(spark, sf_dir):
    k = F.col("p_partkey")
    dark = colour.ensure_dark(*[(k * m % 256).cast("int") for m in (37, 59, 83)])
    return table(spark, sf_dir, "part").select("p_partkey", dark.alias("d")).select("p_partkey", colour.hex_of(F.col("d.r"), F.col("d.g"), F.col("d.b")).alias("hex"))


@query(
    "h04_contact_blocks",
    """with p as (select doc_id, case when doc_id % 4 > 0 then chr(10) || text || chr(10) end as contact, case when doc_id % 3 > 0 then chr(10) || coalesce(source, '-') || '.com' || chr(10) end as site, text from documents where text is not null and not regexp_matches(text, '##|\\n#')),
       m as (select doc_id, regexp_extract_all(contact, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') as found, site from p)
       select doc_id, len(coalesce(found, []))::int as n_emails, trim(site, chr(10)) as site from m""",
)
def h04(spark, sf_dir):
    """Pages in markdown made of every text; only the blocks of contact data and websites are read."""
    d = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull() & ~F.rlike("text", F.lit("##|\\n#")))
    part = lambda when, heading, body: F.when(when, F.concat(F.lit(f"## {heading}\n"), body, F.lit("\n"))).otherwise("")
    page = F.concat(F.lit("# Club\nintro a@b.hr\n"), part(F.col("doc_id") % 4 > 0, "Contact info", F.col("text")), part(F.col("doc_id") % 3 > 0, "Websites and social links", F.concat(F.coalesce("source", F.lit("-")), F.lit(".com"))), F.lit("## More\nx@y.hr\n"))
    b = d.select("doc_id", markup.contact_blocks(page).alias("b"))
    emails = F.regexp_extract_all("b.contact", F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), F.lit(0))
    return b.select("doc_id", F.coalesce(F.size(emails), F.lit(0)).alias("n_emails"), F.trim(F.col("b.websites"), F.lit("\n")).alias("site"))


@query(
    "h06_merged_lists",
    """with c as (select conv_id, list_sort(list_distinct(list(role))) as r, list_sort(list_distinct(list(case when turn > 1 then 'turn ' || turn end) filter (turn > 1))) as t from conversations group by 1),
       b as (select conv_id, list_sort(list_distinct(list_concat(coalesce(r, []), case when conv_id % 7 = 0 then [] else coalesce(t, []) end))) as v from c)
       select conv_id, to_json(v)::varchar as fields, len(v)::int as n from b""",
)
def h06(spark, sf_dir):
    """Two JSON lists of each conversation (some broken) as one."""
    turns = F.to_json(F.collect_list(F.when(F.col("turn") > 1, F.concat(F.lit("turn "), F.col("turn")))))
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.collect_list("role")).alias("roles"), turns.alias("turns"))
    merged = markup.merged_json_lists(F.col("roles"), F.when(F.col("conv_id") % 7 == 0, "{broken").otherwise(F.col("turns")))
    return c.select("conv_id", merged.alias("fields"), F.json_array_length(merged).alias("n"))


# ---- readers, over what sinks wrote of whole tables


@query(
    "s04_team_payloads",
    """select s_suppkey as team_id, s_name as short_name, case when s_suppkey % 5 > 0 then 1900 + s_suppkey % 120 end::int as founded, case when s_suppkey % 4 > 0 then 'V ' || s_name end as venue, case when s_suppkey % 4 > 0 then s_suppkey * 10 end::int as capacity,
         case when s_suppkey % 4 > 0 then n_name end as city, case when s_suppkey % 4 > 0 then 42 + s_nationkey / 10.0::double end as lat, case when s_suppkey % 4 > 0 then 13 + s_nationkey / 10.0::double end as lng
       from supplier join nation on n_nationkey = s_nationkey""",
)
def s04(spark, sf_dir):
    """One cached answer of an interface a line; parts that it does not know are left out of it."""
    k, known = F.col("s_suppkey"), F.col("s_suppkey") % 4 > 0
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    venue = F.struct(
        F.concat(F.lit("V "), "s_name").alias("name"), (k * 10).alias("capacity"), F.struct(F.col("n_name").alias("name")).alias("city"),
        F.struct((42 + F.col("s_nationkey") / 10).alias("latitude"), (13 + F.col("s_nationkey") / 10).alias("longitude")).alias("venueCoordinates"),
    )
    start = F.when(k % 5 > 0, F.unix_timestamp(F.make_date(1900 + k % 120, F.lit(7), F.lit(1)).cast("timestamp")))
    path = _folder(spark, "teams")
    s.select(F.struct(k.alias("id"), F.col("s_name").alias("shortName"), start.alias("foundationDateTimestamp"), F.when(known, venue).alias("venue")).alias("team")).write.json(path)
    return landing.teams(spark, path, by_line=True)


@query("s11_csv_dump", "select doc_id::varchar as doc_id, md5(text) as digest, length(text)::int as n, source from documents")
def s11(spark, sf_dir):
    """Whole texts, quotes, blanks and line breaks included, as a CSV dump with a header, read back without a bound on a field's size."""
    path = _folder(spark, "dump")
    snapshots.write_dump(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), path)
    d = landing.restored(spark, path, ["doc_id", "text", "source"])
    return d.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("n"), "source")


@query("s13_stage_verdicts", f"with {QUARANTINE} select * from plan")
def s13(spark, sf_dir):
    """The plan of a repair from the verdicts that an earlier stage left as CSV, not from memory."""
    e = entities(spark, sf_dir)
    path = _folder(spark, "verdicts")
    snapshots.write_csv(resolve.detect(e).select("id", "field", "key", "verdict"), path)
    read = landing.dump(spark, path).withColumn("id", F.col("id").cast(e.schema["id"].dataType))
    return state.quarantine_plan(e, read, BUNDLES)


@query(
    "s15_grounds",
    """select case when c_custkey % 3 = 0 then 'stadium' else 'pitch' end as kind, 'way' as osm_type, c_custkey::bigint as osm_id, case when c_custkey % 2 = 0 then 45 + c_nationkey / 100.0::double else 46 + c_nationkey / 100.0::double end as lat,
         case when c_custkey % 3 > 0 then case when c_custkey % 4 = 0 then 'tennis;football' else 'soccer' end end as sport, case when c_custkey % 3 = 0 and c_custkey % 5 > 0 then c_custkey * 3 end::int as capacity
       from customer where c_custkey % 11 > 0 and c_custkey % 3 < 2 or (c_custkey % 11 > 0 and c_custkey % 3 = 2 and c_custkey % 7 = 0)""",
)
def s15(spark, sf_dir):
    """Geodata payloads of every customer: stadiums, football grounds, other grounds, some without a place, some with a centre."""
    k = F.col("c_custkey")
    at = lambda base: F.when(k % 11 > 0, base + F.col("c_nationkey") / 100)
    sport = F.when(k % 4 == 0, "tennis;football").otherwise("soccer")
    tags = F.map_filter(
        F.create_map(
            F.lit("leisure"), F.when(k % 3 == 0, "stadium").otherwise("pitch"), F.lit("sport"), F.when(k % 3 > 0, F.when((k % 3 == 2) & (k % 7 > 0), "tennis").otherwise(sport)),
            F.lit("capacity"), F.when(k % 5 == 0, "many").otherwise((k * 3).cast("string")),
        ), lambda _, v: v.isNotNull(),
    )
    element = F.struct(
        F.lit("way").alias("type"), k.alias("id"), F.when(k % 2 > 0, at(46)).alias("lat"), F.when(k % 2 > 0, at(16)).alias("lon"),
        F.when(k % 2 == 0, F.struct(at(45).alias("lat"), at(15).alias("lon"))).alias("center"), tags.alias("tags"),
    )
    path = _folder(spark, "geodata")
    table(spark, sf_dir, "customer").select(F.array(element).alias("elements")).write.json(path)
    return landing.grounds(landing.features(spark, path, by_line=True)).select("kind", "osm_type", "osm_id", "lat", "sport", "capacity")


@query("s20_accept_list", "select doc_id, source from documents where doc_id in (select doc_id from labels where quality = 1)")
def s20(spark, sf_dir):
    """Rows of a list of accepted ids: a text file with an id a line, comments and blank lines."""
    path = _folder(spark, "accepted")
    ids = table(spark, sf_dir, "labels").filter("quality = 1").select(F.explode(F.array(F.concat(F.lit("  "), F.col("doc_id").cast("string")), F.concat(F.lit("# "), F.col("doc_id") + 1), F.lit(""))).alias("value"))
    ids.write.text(path)
    listed = landing.lines(spark, path).select(F.col("value").cast("long").alias("doc_id"))
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(listed, "doc_id", "left_semi")


TIERS = {"AFRICA": 1, "AMERICA": 2, "ASIA": 3}


@query(
    "s25_seeded_tiers",
    f"""select c_custkey, r_name, t.tier::int as tier from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey
        left join (values {", ".join(f"('{n}', {t})" for n, t in TIERS.items())}) t(name, tier) on t.name = r_name""",
)
def s25(spark, sf_dir):
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    tiers = landing.seed(spark, list(TIERS.items()), "r_name string, tier int")
    return c.join(F.broadcast(tiers), "r_name", "left").select("c_custkey", "r_name", "tier")


# ---- schemas that grow, tables built again


@query(
    "d15_grown_schema",
    """select c_custkey, c_name, case when c_custkey % 2 = 0 then c_mktsegment end as c_mktsegment, case when c_custkey % 2 = 0 then c_acctbal::double end as c_acctbal, null::varchar as oib from customer""",
)
def d15(spark, sf_dir):
    """A table of fewer columns together with a later one of more; a column that neither has is added once."""
    c = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("double"))
    early, late = c.filter("c_custkey % 2 = 1").select("c_custkey", "c_name"), c.filter("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    whole = state.add_missing_columns(early, {"c_mktsegment": "string", "c_acctbal": "double"}).unionByName(late)
    return state.add_missing_columns(state.add_missing_columns(whole, {"oib": "string"}), {"oib": "int", "c_name": "int"})


@query(
    "d16_rebuilt_index",
    r"""with p as (select p_partkey, lower(case when p_partkey % 3 = 0 then 'new ' || p_name else p_name end) as v from part where p_partkey % 10 > 0)
        select p_partkey, token, (place - 1)::int as pos from (select p_partkey, unnest(w) as token, generate_subscripts(w, 1) as place from (select p_partkey, list_filter(string_split_regex(v, '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from p))""",
)
def d16(spark, sf_dir):
    """The index of a table built, then built again once names changed and rows went: nothing of the first is left."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    base = _folder(spark, "index")
    snapshots.rebuild(search.build_index(p, "p_partkey", ["p_name"]), base)
    now = p.filter("p_partkey % 10 > 0").withColumn("p_name", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("new "), "p_name")).otherwise(F.col("p_name")))
    return snapshots.rebuild(search.build_index(now, "p_partkey", ["p_name"]), base).select("p_partkey", "token", "pos")
