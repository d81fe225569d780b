"""Listings, facets, coverage, joins, windows, sets and exports over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kartoteka.operators import audit, coverage, graph, matching
from kartoteka.plans.registry import query
from kartoteka.session import table
from kartoteka.sources import snapshots


def docs_with_labels(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return d.join(table(spark, sf_dir, "labels"), "doc_id", "left")


COVERAGE = """count(*)::bigint as n, count(quality)::bigint as labelled, count(*) filter (quality = 1)::bigint as good,
  count(*) filter (toxic = 1)::bigint as toxic, count(*) filter (n_chars >= 1000)::bigint as long_texts"""


@query("a01_coverage", f"select {COVERAGE} from documents left join labels using (doc_id)")
def a01(spark, sf_dir):
    return coverage.counts(docs_with_labels(spark, sf_dir), **coverage.DOCUMENTS)


@query("a02_coverage_scoped", f"select {COVERAGE}, sum(case when toxic = 1 then 1 end)::bigint as toxic_or_null from documents left join labels using (doc_id) where lang = 'de'")
def a02(spark, sf_dir):
    scoped = docs_with_labels(spark, sf_dir).filter("lang = 'de'")
    return scoped.agg(*coverage.measures(**coverage.DOCUMENTS), F.sum(F.when(F.col("toxic") == 1, 1)).alias("toxic_or_null"))


@query("a03_facet_counts", "select source, count(*)::bigint as n from documents group by source")
def a03(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


@query("a04_facet_null_label", "select coalesce(quality::varchar, '<none>') as quality, count(*)::bigint as n from documents left join labels using (doc_id) group by 1")
def a04(spark, sf_dir):
    return docs_with_labels(spark, sf_dir).groupBy(F.coalesce(F.col("quality").cast("string"), F.lit("<none>")).alias("quality")).agg(F.count("*").alias("n"))


@query(
    "a05_distinct_over_join",
    """select o_orderpriority, count(distinct c_custkey)::bigint as customers from customer join orders on o_custkey = c_custkey group by 1""",
)
def a05(spark, sf_dir):
    # The key is on the orders' side already: a semi join would only confirm it.
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi").groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("customers"))


@query(
    "a06_left_join_zero",
    """select n_name, count(distinct c_custkey)::bigint as rich from nation left join customer on c_nationkey = n_nationkey and c_acctbal > 9900 group by 1""",
)
def a06(spark, sf_dir):
    c = table(spark, sf_dir, "customer").filter("c_acctbal > 9900").groupBy("c_nationkey").agg(F.countDistinct("c_custkey").alias("rich"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return n.join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_name", F.coalesce("rich", F.lit(0)).alias("rich"))


@query(
    "a07_histogram_of_min",
    """select best, count(*)::bigint as customers from (select o_custkey, min(o_orderpriority) as best from orders group by 1) group by 1""",
)
def a07(spark, sf_dir):
    best = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderpriority").alias("best"))
    return best.groupBy("best").agg(F.count("*").alias("customers"))


@query(
    "a08_string_agg",
    "select r_name, string_agg(n_name, ', ' order by n_name) as nations from region join nation on n_regionkey = r_regionkey group by 1",
)
def a08(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.groupBy("r_name").agg(F.array_join(F.sort_array(F.collect_list("n_name")), ", ").alias("nations"))


@query("a09_having", "select md5(text) as print, count(*)::bigint as n from documents group by 1 having count(*) > 1")
def a09(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.md5(F.col("text").cast("binary")).alias("print")).agg(F.count("*").alias("n")).filter("n > 1")


@query("a10_boolean_sum", "select lang, count(quality)::bigint as labelled from documents left join labels using (doc_id) group by 1")
def a10(spark, sf_dir):
    return docs_with_labels(spark, sf_dir).groupBy("lang").agg(F.count("quality").alias("labelled"))


@query("a11_totals", "select count(*)::bigint as n, count(distinct l_orderkey)::bigint as orders, ceil(count(*) / 30.0)::bigint as pages from lineitem")
def a11(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("orders"), F.ceil(F.count("*") / 30.0).cast("bigint").alias("pages"))


@query(
    "a12_fill_rates",
    """with c as (select count(*)::bigint as n, count(lang)::bigint as lang, count(quality)::bigint as quality, count(toxic)::bigint as toxic from documents left join labels using (doc_id))
       select 'lang' as "column", lang as filled, n from c union all select 'quality', quality, n from c union all select 'toxic', toxic, n from c""",
)
def a12(spark, sf_dir):
    return audit.fill_rates(docs_with_labels(spark, sf_dir), ["lang", "quality", "toxic"])


@query(
    "a13_before_after",
    """select lang, count(quality)::bigint as before, count(coalesce(quality, case when n_chars > 2000 then 1 end))::bigint as after,
       (count(coalesce(quality, case when n_chars > 2000 then 1 end)) - count(quality))::bigint as gained from documents left join labels using (doc_id) group by 1""",
)
def a13(spark, sf_dir):
    filled = F.coalesce("quality", F.when(F.col("n_chars") > 2000, 1))
    both = docs_with_labels(spark, sf_dir).groupBy("lang").agg(F.count("quality").alias("before"), F.count(filled).alias("after"))
    return both.withColumn("gained", F.col("after") - F.col("before"))


@query("a14_two_level_counts", "select event_type, (user_id % 4)::bigint as bucket, count(*)::bigint as n from events group by 1, 2")
def a14(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 4).alias("bucket")).agg(F.count("*").alias("n"))


COMPLETE = """(case when quality is not null then 1 else 0 end + case when toxic is not null then 1 else 0 end + case when n_chars >= 1000 then 1 else 0 end + 0.5e0 * case when lang = 'en' then 1 else 0 end + 1) / 4.5e0"""


CHANNELS = "(case when quality is not null then 1 else 0 end + case when toxic is not null then 1 else 0 end + case when n_chars >= 1000 then 1 else 0 end + case when lang = 'en' then 1 else 0 end)"


@query(
    "a15_completeness",
    f"""select lang, grouping(lang)::int as overall, count(*)::bigint as n, round(avg({COMPLETE}), 6) as mean, {", ".join(f"count(*) filter ({CHANNELS} {'>=' if k == 4 else '='} {k})::bigint as c{k}" for k in range(5))}
       from documents left join labels using (doc_id) group by grouping sets ((lang), ())""",
)
def a15(spark, sf_dir):
    scored = docs_with_labels(spark, sf_dir).withColumns({"score": F.expr(COMPLETE.replace("e0", "D")), "channels": F.expr(CHANNELS)})
    bins = [F.count_if(F.col("channels") >= k if k == 4 else F.col("channels") == k).alias(f"c{k}") for k in range(5)]
    return scored.rollup("lang").agg(F.grouping("lang").cast("int").alias("overall"), F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean"), *bins)


@query(
    "a16_predicate_buckets",
    """with c as (select count(*) filter (n_chars < 500)::bigint as short, count(*) filter (n_chars > 5000)::bigint as long, count(*) filter (lang <> 'en')::bigint as foreign from documents)
       select 'short' as bucket, short as n from c union all select 'long', long from c union all select 'foreign', "foreign" from c""".replace(" as foreign", ' as "foreign"'),
)
def a16(spark, sf_dir):
    return coverage.buckets(table(spark, sf_dir, "documents"), short=F.col("n_chars") < 500, long=F.col("n_chars") > 5000, foreign=F.col("lang") != "en")


@query(
    "a17_mean_dimensions",
    """select 'quality' as dimension, count(quality)::bigint as n, round(avg(quality) * 100, 6) as pct from documents left join labels using (doc_id)
       union all select 'toxic', count(toxic), round(avg(toxic) * 100, 6) from documents left join labels using (doc_id)""",
)
def a17(spark, sf_dir):
    return audit.dimension_means(docs_with_labels(spark, sf_dir).select("quality", "toxic"), ["quality", "toxic"])


@query("a19_frequency_guard", "select doc_id from documents qualify count(*) over (partition by md5(text)) <= 3")
def a19(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("print"))
    often = d.groupBy("print").agg(F.count("*").alias("n")).filter("n > 3")
    return d.join(often, "print", "left_anti").select("doc_id")


@query("a20_group_pivot", "select source, count(*) filter (lang = 'de')::bigint as de, count(*) filter (lang = 'en')::bigint as en, count(*) filter (lang = 'fr')::bigint as fr from documents group by 1")
def a20(spark, sf_dir):
    pivot = table(spark, sf_dir, "documents").groupBy("source").pivot("lang", ["de", "en", "fr"]).agg(F.count(F.lit(1)))
    return pivot.na.fill(0)


@query("a21_percent", "select lang, round(100.0 * count(*) / sum(count(*)) over ())::bigint as pct from documents group by 1")
def a21(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    whole = d.agg(F.count("*")).scalar()
    return d.groupBy("lang").agg(F.count("*").alias("n")).select("lang", F.round(100.0 * F.col("n") / whole).cast("bigint").alias("pct"))


# ---- joins


@query(
    "j01_star",
    """select r_name, count(*)::bigint as orders, round(sum(o_totalprice), 2) as total from orders join customer on o_custkey = c_custkey
       join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1""",
)
def j01(spark, sf_dir):
    # Aggregated by customer first: the join with the dimensions sees one row per customer.
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("k"), F.sum("o_totalprice").alias("s"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("r_name").agg(F.sum("k").alias("orders"), F.round(F.sum("s"), 2).alias("total"))


@query(
    "j04_filter_in_on",
    "select c_custkey, count(o_orderkey)::bigint as urgent from customer left join orders on o_custkey = c_custkey and o_orderpriority like '1%' group by 1",
)
def j04(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").startswith("1")).groupBy("o_custkey").agg(F.count("*").alias("n"))
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("urgent"))


@query("j05_semi", "select doc_id, lang from documents where doc_id in (select doc_id from labels)")
def j05(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")


@query("j06_anti", "select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def j06(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("j07_shared_values", "select doc_id from documents where md5(text) in (select md5(text) from documents group by 1 having count(*) > 1)")
def j07(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("print"))
    return d.join(d.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1"), "print", "left_semi").select("doc_id")


@query("j08_scalar_min", "select c_custkey, (select min(o_orderpriority) from orders where o_custkey = c_custkey) as best from customer")
def j08(spark, sf_dir):
    best = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderpriority").alias("best"))
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(best, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "best")


@query(
    "j10_distinct_list",
    "select o_custkey, string_agg(distinct o_orderpriority, ',' order by o_orderpriority) as priorities from orders group by 1",
)
def j10(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ",").alias("priorities"))


@query(
    "j14_fallback_key",
    """with m as (select p_brand, p_size, min(p_partkey) as k from part group by 1, 2), f as (select p_brand, min(p_partkey) as k, count(distinct p_size) as n from part group by 1),
       q as (select s_suppkey, 'Brand#' || (10 + s_suppkey % 40)::varchar as brand, (s_suppkey % 60)::int as size from supplier)
       select s_suppkey, coalesce(m.k, case when f.n = 1 then f.k end) as part from q left join m on m.p_brand = brand and m.p_size = size left join f on f.p_brand = brand""",
)
def j14(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    exact = p.groupBy("p_brand", "p_size").agg(F.min("p_partkey").alias("k"))
    loose = p.groupBy("p_brand").agg(F.min("p_partkey").alias("k1"), F.countDistinct("p_size").alias("n")).filter("n = 1").select(F.col("p_brand").alias("b1"), "k1")
    q = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Brand#"), (10 + F.col("s_suppkey") % 40).cast("string")).alias("brand"), (F.col("s_suppkey") % 60).cast("int").alias("size"))
    j = q.join(exact, (F.col("p_brand") == F.col("brand")) & (F.col("p_size") == F.col("size")), "left").join(loose, F.col("b1") == F.col("brand"), "left")
    return j.select("s_suppkey", F.coalesce("k", "k1").alias("part"))


@query(
    "j20_full_outer",
    """with a as (select doc_id, quality from labels where doc_id % 3 <> 0), b as (select doc_id, toxic as quality from labels where doc_id % 3 <> 1)
       select coalesce(a.doc_id, b.doc_id) as doc_id, a.quality as v1, b.quality as v2, a.quality is distinct from b.quality as differs from a full outer join b on a.doc_id = b.doc_id""",
)
def j20(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    a = labels.filter("doc_id % 3 <> 0").select("doc_id", F.col("quality").alias("v1"))
    b = labels.filter("doc_id % 3 <> 1").select("doc_id", F.col("toxic").alias("v2"))
    return a.join(b, "doc_id", "full_outer").select("doc_id", "v1", "v2", (~F.col("v1").eqNullSafe(F.col("v2"))).alias("differs"))


@query("j21_array_membership", """select event_id from events where json_extract_string(props, '$.k')::int in (3, 7)""")
def j21(spark, sf_dir):
    wanted = F.array(F.lit(3), F.lit(7))
    return table(spark, sf_dir, "events").filter(F.array_contains(wanted, F.get_json_object("props", "$.k").cast("int"))).select("event_id")


@query(
    "j22_substring_probe",
    """select distinct a.p_partkey from part a join part b on a.p_brand = b.p_brand and a.p_partkey <> b.p_partkey and a.p_size = b.p_size where contains(a.p_name, b.p_name) or contains(b.p_name, a.p_name)""",
)
def j22(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_name").alias("name"))
    return matching.substring_partners(p, "p_partkey", "name", "brand", "size")


# ---- windows, sorts, sets


@query(
    "w01_top1_per_key",
    "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderpriority, o_orderdate desc, o_orderkey) = 1",
)
def w01(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return coverage.top_k(o, ["o_custkey"], 1, "o_orderpriority", F.desc("o_orderdate"), "o_orderkey").select("o_custkey", "o_orderkey")


@query("w02_topk_per_stratum", "select lang, doc_id from documents qualify row_number() over (partition by lang order by n_chars desc, doc_id) <= 2")
def w02(spark, sf_dir):
    return coverage.top_k(table(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars"), ["lang"], 2, F.desc("n_chars"), "doc_id").select("lang", "doc_id")


@query(
    "w04_margin_winner",
    """with t as (select user_id, event_type, sum(value) as s from events group by 1, 2),
       r as (select *, row_number() over (partition by user_id order by s desc, event_type) as k, lead(s) over (partition by user_id order by s desc, event_type) as next from t)
       select user_id, event_type from r where k = 1 and (next is null or s - next >= 0.5)""",
)
def w04(spark, sf_dir):
    t = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("s"), coverage.exact_sum("value").alias("exact"))
    return coverage.clear_winner(t, "user_id", "event_type", 0.5)


@query("w05_strict_maximum", """with t as (select user_id, event_type, count(*) as n from events group by 1, 2), m as (select user_id, max(n) as top from t group by 1)
    select t.user_id, min(event_type) as owner from t join m on t.user_id = m.user_id and n = top group by 1 having count(*) = 1""")
def w05(spark, sf_dir):
    t = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    w = Window.partitionBy("user_id")
    tops = t.withColumn("top", F.max("n").over(w)).filter("n = top").groupBy("user_id").agg(F.min("event_type").alias("owner"), F.count("*").alias("k"))
    return tops.filter("k = 1").select("user_id", "owner")


@query("w09_latest_k", "select user_id, event_id from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) <= 5")
def w09(spark, sf_dir):
    return coverage.top_k(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], 5, F.desc("ts"), F.desc("event_id")).select("user_id", "event_id")


@query("w10_round_robin", "select s_suppkey, ((row_number() over (order by s_name, s_suppkey) - 1) % 4)::int as batch from supplier where s_acctbal > 5000")
def w10(spark, sf_dir):
    picked = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select("s_suppkey", "s_name")
    return audit.with_batches(picked, 4, F.col("s_name"), F.col("s_suppkey")).select("s_suppkey", "batch")


@query("w11_lowest_of_list", """select o_custkey, list_min(list(substr(o_orderpriority, 1, 1)::int)) as lowest from orders group by 1""")
def w11(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.collect_set(F.left("o_orderpriority", F.lit(1))), ",").alias("list"))
    return joined.select("o_custkey", F.array_min(F.transform(F.split("list", ","), lambda x: x.cast("int"))).alias("lowest"))


LISTING = """c_acctbal > 0 and c_mktsegment in ('BUILDING', 'MACHINERY') and (c_nationkey is null or c_nationkey <> 3)
  and (case when c_acctbal > 100 then 1 else 0 end + case when c_nationkey > 5 then 1 else 0 end + case when c_name like '%1%' then 1 else 0 end) >= 2"""


@query("f01_dynamic_listing", f"select c_custkey, c_name, c_mktsegment from customer where {LISTING} and c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')")
def f01(spark, sf_dir):
    found = coverage.listing(table(spark, sf_dir, "customer"), minimum=0, segments=["BUILDING", "MACHINERY"], not_nation=3, least_score=2)
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey")
    return found.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name", "c_mktsegment")


@query("l01_page", "select doc_id, source from documents order by source, doc_id limit 30 offset 60")
def l01(spark, sf_dir):
    # The page is the feature; a total order makes it the same everywhere.
    return table(spark, sf_dir, "documents").select("doc_id", "source").orderBy("source", "doc_id").offset(60).limit(30)


@query("l02_growing_prefix", "select doc_id, n_chars from documents order by n_chars desc nulls last, doc_id limit 120")
def l02(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.desc_nulls_last("n_chars"), "doc_id").limit(120)


@query("l07_best_or_none", "select user_id, case when max(value) > 50 then arg_max(event_id, (value, event_id)) end as best from events group by 1")
def l07(spark, sf_dir):
    best = F.max_by("event_id", F.struct("value", "event_id"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.when(F.max("value") > 50, best).alias("best"))


@query(
    "t01_union_urls",
    """select '<url><loc>' || replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</loc></url>' as entry
       from (select url from pages union all select '/lang/' || lang from (select distinct lang from documents) union all select '/source/' || source from (select distinct source from documents))""",
)
def t01(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    part = lambda c: d.select(c).distinct().select(F.concat(F.lit(f"/{c}/"), c).alias("url"))
    return snapshots.sitemap_urls(table(spark, sf_dir, "pages").select("url"), part("lang"), part("source"))


@query("t02_distinct", "select distinct lang, source from documents")
def t02(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("lang", "source").distinct()


@query("t03_difference", "select l_suppkey as k from lineitem except select s_suppkey from supplier where s_suppkey % 2 = 0")
def t03(spark, sf_dir):
    known = table(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("k"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k")).distinct().join(known, "k", "left_anti")


@query("t04_composite_keys", "select p_partkey from part where (p_brand, p_size) not in (select p_brand, p_size from part where p_partkey <= 100)")
def t04(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return p.join(p.filter("p_partkey <= 100"), ["p_brand", "p_size"], "left_anti").select("p_partkey")


# ---- exports, graph


@query(
    "k01_denormalised",
    """select o_orderkey, o_custkey, string_agg(l_linenumber::varchar, '|' order by l_linenumber) as lines, count(*)::bigint as n
       from orders join lineitem on l_orderkey = o_orderkey group by 1, 2""",
)
def k01(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list("l_linenumber")), lambda x: x.cast("string")), "|").alias("lines"), F.count("*").alias("n"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return o.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_custkey", "lines", "n")


@query(
    "k04_nested_docs",
    """select conv_id, '[' || string_agg('{"turn":' || turn || ',"role":"' || role || '"}', ',' order by turn, role) || ']' as turns from conversations group by 1""",
)
def k04(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return c.groupBy("conv_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("turn", "role")))).alias("turns"))


@query("k03_compact_json", """select doc_id, '{"doc_id":' || doc_id || ',"lang":"' || lang || '"' || coalesce(',"quality":' || quality, '') || '}' as doc from documents left join labels using (doc_id)""")
def k03(spark, sf_dir):
    return docs_with_labels(spark, sf_dir).select("doc_id", snapshots.compact_json("doc_id", F.nullif("lang", F.lit("")).alias("lang"), "quality").alias("doc"))


@query(
    "k16_geojson",
    """select s_suppkey, '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || (13 + s_suppkey % 7) || ',' || (42 + s_suppkey % 5) || ']},"properties":{"tier":' || (s_nationkey % 8 + 1) || '}}' as feature from supplier""",
)
def k16(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", snapshots.geojson_feature(42 + F.col("s_suppkey") % 5, 13 + F.col("s_suppkey") % 7, tier=F.col("s_nationkey") % 8 + 1).alias("feature"))


@query("k17_label_map", "select o_orderkey, case left(o_orderpriority, 1) when '1' then 'first' when '2' then 'second' else 'other' end as label from orders")
def k17(spark, sf_dir):
    labels = F.create_map(F.lit("1"), F.lit("first"), F.lit("2"), F.lit("second"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.try_element_at(labels, F.left("o_orderpriority", F.lit(1))), F.lit("other")).alias("label"))


@query(
    "n01_reachability",
    """with recursive e as (select distinct 's' || l_suppkey as a, 'p' || l_partkey as b from lineitem), x as (select a, b from e union all select b, a from e),
       r(node) as (select 's' || min(l_suppkey) from lineitem union select x.b from r join x on x.a = r.node) select node from r""",
)
def n01(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    s, p = F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("p"), "l_partkey")
    edges = e.select(F.explode(F.array(F.struct(s.alias("src"), p.alias("dst")), F.struct(p.alias("src"), s.alias("dst")))).alias("x")).select("x.*")
    start = e.agg(F.min("l_suppkey").alias("k")).select(F.concat(F.lit("s"), "k").alias("node"))
    return graph.reach(edges, start).select("node")
