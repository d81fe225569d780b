"""URL filters: rules by host and path, and trust propagated over the host graph (DataFrame functions only).

A rule fits its host and all subdomains where the url's path starts with the rule's; the longest wins. Where no rule
fits, the host decides: trust flows by personalised PageRank from hosts that the rules mostly allow, along links;
distrust flows from hosts that the rules mostly block, along reversed links, to those that link to them. Either flow
starts with a mass of one, in equal parts at its seeds, and what moves is added up until no more than TOLERANCE of it is
still moving; after k rounds that is DAMPING ** k at most, so the number of rounds has a bound, too. A host is blocked
where distrust is more than SHARE of its trust and distrust together and more than FLOOR of a host's equal part of the mass:
both hold at any size of the graph, however many hosts share what a seed gives back. A host that is no seed is
blocked only if, besides, LINKS of its own links or more lead to such hosts: one bad link among many is no reason. Edges are links from a page's
host to another host, and a host and its parent domain in both directions (down to PARENT_LABELS labels); equal links
count once per page.

Rules are a parameter list that a person maintains; they become expressions, not a table.

Defined cases: a null url or one without `://` has an empty host and path, fits no rule and is allowed; null or empty
html has no links; very long html is read whole; repeated rows are judged alike; a tie of trust and distrust is
allowed; an empty table gives an empty result; no other column is looked at, whatever its name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.llm.common import ascii_lower, discard, stored

# Fixed values: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING, TOLERANCE = 0.85, 1e-4
SHARE, FLOOR, LINKS = 0.5, 0.01, 0.25
#: No more than TOLERANCE can be moving after so many rounds.
ROUNDS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
#: A host is a seed where more than this share of its pages is allowed, or blocked, by rules.
SEED_SHARE = 0.5
PARENT_LABELS = 3
_LINK = r"(?i)(?:href|src)\x20*=\x20*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\x20\x09-\x0D>]+)"


def parts(url: Column) -> tuple[Column, Column]:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """Add host, path, rule (`host/path`, null where none fits) and by_rule (its verdict)."""
    host, path = parts(F.col("url"))
    df = pages.withColumns({"host": host, "path": path})
    longest = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [(F.col("host") == h) | F.col("host").endswith("." + h) for h, _, _ in longest]
    starts = [F.col("path").startswith(p) for _, p, _ in longest]
    pick = lambda value: F.coalesce(*[F.when(f & s, F.lit(value(r))) for f, s, r in zip(fits, starts, longest, strict=True)], F.lit(None).cast("string"))
    return df.withColumns({"rule": pick(lambda r: r[0] + r[1]), "by_rule": pick(lambda r: r[2])})


def edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) of the host graph from (host, html); pre-aggregated per page and per partition before any shuffle."""
    links = pages.select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)))).alias("dst"))
    links = links.select(F.col("host").alias("src"), ascii_lower(F.col("dst")).alias("dst")).filter("src <> '' and dst <> '' and src <> dst")
    links = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("n"))
    hosts = pages.select("host").distinct().unionByName(links.select(F.col("dst").alias("host"))).distinct()
    parent = hosts.filter(F.size(F.split("host", r"\.")) > PARENT_LABELS).select("host", F.regexp_extract("host", r"^[^.]*\.(.*)$", 1).alias("up"))
    both = parent.select(F.explode(F.array(F.struct(F.col("host").alias("src"), F.col("up").alias("dst")), F.struct(F.col("up").alias("src"), F.col("host").alias("dst")))).alias("e"))
    return links.unionByName(both.select("e.src", "e.dst", F.lit(1.0).alias("n"))).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(graph: DataFrame, seeds: DataFrame) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust: 0 or 1), exact but for TOLERANCE of the mass.

    One edge table holds both flows: trust from src to dst by src's shares, distrust from dst to src by dst's. Shares are
    aggregates joined back, so a host with a third of all links is no single task. Only the mass that moved last travels.
    """
    out = graph.groupBy("src").agg(F.sum("n").alias("out"))
    back = graph.groupBy("dst").agg(F.sum("n").alias("back"))
    weighted = graph.join(out, "src").join(back, "dst")
    flows = weighted.select(F.explode(F.array(
        F.struct(F.col("src").alias("host"), F.col("dst").alias("to"), F.lit(True).alias("good"), (F.col("n") / F.col("out")).alias("share")),
        F.struct(F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(False).alias("good"), (F.col("n") / F.col("back")).alias("share")),
    )).alias("x")).select("x.*")
    flows = stored(flows, "flows")
    n = seeds.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
    part = lambda c, whole: (F.col(c) * F.lit((1 - DAMPING) / max(whole or 0.0, 1.0))).alias("mass")
    start = seeds.select("host", F.explode(F.array(F.struct(F.lit(True).alias("good"), part("trust", n.t)), F.struct(F.lit(False).alias("good"), part("distrust", n.d)))).alias("x"))
    moved = stored(start.select("host", "x.good", "x.mass").filter("mass > 0"), "moved")
    whole = [moved]
    for _ in range(ROUNDS):
        # Mass moved times what it still leads to: the most that later rounds can add.
        if (moved.agg(F.sum("mass")).first()[0] or 0.0) <= TOLERANCE * (1 - DAMPING):
            break
        step = flows.join(moved, ["host", "good"]).groupBy(F.col("to").alias("host"), "good")
        moved = stored(step.agg((F.sum(F.col("share") * F.col("mass")) * DAMPING).alias("mass")), "moved")
        whole.append(moved)
    every = whole[0]
    for w in whole[1:]:
        every = every.unionByName(w)
    of = lambda good: F.sum(F.when(F.col("good") == good, F.col("mass")).otherwise(0.0))
    ranks = stored(every.groupBy("host").agg(of(True).alias("trust"), of(False).alias("distrust")), "ranks")
    discard(flows, *whole)
    return ranks


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of (page_id, url, html)."""
    ruled = with_rules(pages.select("page_id", "url", "html"), rules)
    count = lambda v: F.count_if(F.col("by_rule") == v)
    seeds = stored(ruled.filter("host <> ''").groupBy("host").agg(
        (count("allow") > F.count("*") * SEED_SHARE).cast("double").alias("trust"), (count("block") > F.count("*") * SEED_SHARE).cast("double").alias("distrust")
    ), "seeds")
    hosts = seeds.count()
    graph = stored(edges(ruled.select("host", "html")), "graph")
    ranks = propagate(graph, seeds)
    doubtful = (F.col("distrust") > SHARE * (F.col("trust") + F.col("distrust"))) & (F.col("distrust") * hosts > FLOOR)
    reached = stored(ranks.filter(doubtful).select("host").join(seeds.filter("distrust > 0").select("host", F.lit(True).alias("seed")), "host", "left"), "reached")
    led = graph.join(reached.select(F.col("host").alias("dst"), F.lit(True).alias("hit")), "dst", "left").groupBy(F.col("src").alias("host"))
    led = led.agg((F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0.0)) / F.sum("n")).alias("led")).filter(F.col("led") >= LINKS)
    bad = stored(reached.join(led, "host", "left").filter("seed or led is not null").select("host", F.lit("block").alias("by_host")), "bad")
    discard(graph, ranks, reached)
    # Only blocked hosts travel; pages of a hot host are split by AQE.
    judged = ruled.drop("html").join(bad, "host", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict"))


def _oracle() -> str:
    longest = sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r))
    cases = lambda value: " ".join(f"when (host = '{r[0]}' or ends_with(host, '.{r[0]}')) and starts_with(path, '{r[1]}') then '{value(r)}'" for r in longest)
    link = _LINK.replace("'", "''")
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with recursive cut as (
  select page_id, html, {lower.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages),
ruled as (select *, case {cases(lambda r: r[0] + r[1])} end as rule, case {cases(lambda r: r[2])} end as by_rule from cut),
l as (select host as src, {lower.format("unnest(list_distinct(regexp_extract_all(html, '" + link + "', 1)))")} as dst from ruled),
links as (select src, dst, count(*)::double as n from l where src <> '' and dst <> '' and src <> dst group by all),
hosts as (select host from ruled union select dst from links),
up as (select host, regexp_extract(host, '^[^.]*\.(.*)$', 1) as up from hosts where len(string_split(host, '.')) > {PARENT_LABELS}),
graph as (
  select src, dst, sum(n) as n from (
    select * from links union all select host, up, 1.0 from up union all select up, host, 1.0 from up) group by all),
flows as (
  select src, dst, true as good, n / sum(n) over (partition by src) as share from graph
  union all select dst, src, false, n / sum(n) over (partition by dst) from graph),
seed as (
  select host, count_if(by_rule = 'allow') > count(*) * {SEED_SHARE} as trust, count_if(by_rule = 'block') > count(*) * {SEED_SHARE} as distrust
  from ruled where host <> '' group by host),
many as (select greatest(count_if(trust), 1) as t, greatest(count_if(distrust), 1) as d, count(*) as hosts from seed),
moved as (
  select 0 as k, host, true as good, (1 - {DAMPING}) / t as mass from seed, many where trust
  union all select 0, host, false, (1 - {DAMPING}) / d from seed, many where distrust),
walk as (
  select * from moved
  union all
  select k + 1, dst, good, sum(share * mass) * {DAMPING} from (
    select walk.k, flows.dst, walk.good, share, mass from walk join flows on flows.src = walk.host and flows.good = walk.good where walk.k < {ROUNDS})
  group by all),
reached as (
  select host from walk, many group by host, hosts
  having sum(case when good then 0 else mass end) > {SHARE} * sum(mass) and sum(case when good then 0 else mass end) * hosts > {FLOOR}),
bad as (
  select host from reached where host in (select host from seed where distrust)
    or host in (select src from graph group by src having sum(case when dst in (select host from reached) then n else 0 end) >= {LINKS} * sum(n)))
select page_id, host, path, rule, coalesce(by_rule, case when host in (select host from bad) then 'block' else 'allow' end) as verdict
from ruled
"""


ORACLE_SQL = _oracle()
