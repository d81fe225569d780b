"""Cached answers of several shapes, read as VARIANT: one column `payload` of JSON text, one row per request.

Every reader tells a hit, a cached miss (a null or blank payload) and a broken payload apart in `status`, and keeps such rows;
fields of an unexpected type are null. Shapes are told apart by what is there, not by the source of the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBERS = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


def parsed(df: DataFrame) -> DataFrame:
    """Add v (the payload as VARIANT, null if there is none) and status; drops payload."""
    v = F.try_parse_json(F.col("payload"))
    status = F.when(F.trim(F.coalesce("payload", F.lit(""))) == "", "miss").when(v.isNull(), "broken").otherwise("hit")
    return df.withColumns({"status": status, "v": F.when(status == "hit", v)}).drop("payload")


def get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def number(v: Column, path: str) -> Column:
    """A number as double; numbers written as text are none."""
    at = get(v, path)
    return F.when(F.rlike(F.schema_of_variant(at), F.lit(_NUMBERS)), get(v, path, "double"))


def items(v: Column, *paths: str) -> Column:
    """The list at the first path that is there, as array<variant>; empty if none is."""
    return F.coalesce(*[get(v, p, "array<variant>") for p in paths], F.array().cast("array<variant>"))


def team_coordinates(df: DataFrame, key: str) -> DataFrame:
    """(key, status, team_id, lat, lng): a team by itself or below `team`; without both coordinates neither counts."""
    p = parsed(df.select(key, "payload")).withColumn("t", F.coalesce(get(F.col("v"), "$.team"), F.col("v")))
    lat, lng = (number(F.col("t"), f"$.venue.venueCoordinates.{c}") for c in ("latitude", "longitude"))
    both = lat.isNotNull() & lng.isNotNull()
    return p.select(key, "status", get(F.col("t"), "$.id", "long").alias("team_id"), F.when(both, lat).alias("lat"), F.when(both, lng).alias("lng"))


def county_leagues(df: DataFrame, key: str) -> DataFrame:
    """(key, county_id, county, priority, league, season_id, is_cup, hidden): a row for each league of each county of a payload."""
    county = parsed(df.select(key, "payload")).select(key, F.explode(items(F.col("v"), "$")).alias("c"))
    c = county.select(key, get(F.col("c"), "$.id", "long").alias("county_id"), get(F.col("c"), "$.name", "string").alias("county"), get(F.col("c"), "$.priority", "int").alias("priority"), F.explode(items(F.col("c"), "$.leagues")).alias("l"))
    flag = lambda n: F.coalesce(get(F.col("l"), f"$.{n}", "boolean"), F.lit(False)).alias
    return c.select(key, "county_id", "county", "priority", get(F.col("l"), "$.name", "string").alias("league"), get(F.col("l"), "$.seasonId", "long").alias("season_id"), flag("isCup")("is_cup"), flag("hidden")("hidden"))


def standings(df: DataFrame, key: str) -> DataFrame:
    """(key, team_id, team_name): the teams of a table, below teamStandings or as a bare list."""
    t = parsed(df.select(key, "payload")).select(key, F.explode(items(F.col("v"), "$.teamStandings", "$")).alias("t"))
    return t.select(key, get(F.col("t"), "$.teamId", "long").alias("team_id"), F.trim(get(F.col("t"), "$.teamName", "string")).alias("team_name")).filter("team_id is not null and team_name <> ''")


def only_hit(df: DataFrame, key: str, field: str) -> DataFrame:
    """(key, status, hits, id): the search hit's `field` where there is exactly one; status none, one, several, miss or broken."""
    p = parsed(df.select(key, "payload")).withColumn("d", items(F.col("v"), "$.data"))
    n = F.size("d")
    status = F.when(F.col("status") != "hit", F.col("status")).when(n == 0, "none").when(n == 1, "one").otherwise("several")
    return p.select(key, status.alias("status"), n.alias("hits"), F.when(status == "one", get(F.col("d")[0], f"$.{field}", "long")).alias("id"))


def request_key(kind: str, body: Column) -> Column:
    """The name under which an answer is cached: sixteen hexadecimal digits of the SHA-256 of kind and body."""
    return F.left(F.sha2(F.concat(F.lit(f"{kind}|"), body), 256), F.lit(16))


def search_key(query: Column, limit: Column) -> Column:
    """The name under which a web search is cached: sixteen hexadecimal digits of the SHA-256 of its JSON, names in order, a space after `:` and `,`."""
    text = F.regexp_extract(F.to_json(F.struct(query.alias("q"))), r'(?s)^\{"q":(.*)\}$', 1)
    key = F.left(F.sha2(F.concat(F.lit('{"limit": '), limit.cast("string"), F.lit(', "query": '), text, F.lit("}")), 256), F.lit(16))
    return F.when(query.isNotNull(), key)


def cached_searches(requests: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """(key, status, place, url, title) of requests (key, query, limit) against a cache (cache_key, payload): a row for each result of the answer,
    one without a place where there is none; a null query and one that was never asked are `unasked`."""
    asked = requests.select(key, search_key(F.col("query"), F.col("limit")).alias("cache_key"))
    found = parsed(cache.select("cache_key", "payload")).select("cache_key", "status", F.posexplode_outer(items(F.col("v"), "$.data.web")).alias("place", "r"))
    status = F.when(F.col("status").isNull(), "unasked").when((F.col("status") == "hit") & F.col("place").isNull(), "none").otherwise(F.col("status"))
    joined = asked.join(found, "cache_key", "left")
    return joined.select(key, status.alias("status"), "place", get(F.col("r"), "$.url", "string").alias("url"), get(F.col("r"), "$.title", "string").alias("title"))


def cached_places(requests: DataFrame, cache: DataFrame, key: str, kind: str) -> DataFrame:
    """(key, status, name, lat, lng) of requests (key, body) against a cache (cache_key, payload): the first place of the answer; `unasked` if there is none."""
    asked = requests.select(key, request_key(kind, F.col("body")).alias("cache_key"))
    found = parsed(cache.select("cache_key", "payload")).withColumn("p", F.try_element_at(items(F.col("v"), "$.places", "$.results"), F.lit(1)))
    # One answer has its place in `location`, the other in `geometry`.
    lat = F.coalesce(number(F.col("p"), "$.location.latitude"), number(F.col("p"), "$.geometry.location.lat"))
    lng = F.coalesce(number(F.col("p"), "$.location.longitude"), number(F.col("p"), "$.geometry.location.lng"))
    name = F.coalesce(get(F.col("p"), "$.displayName.text", "string"), get(F.col("p"), "$.formatted_address", "string"))
    status = F.when((F.col("status") == "hit") & F.col("p").isNull(), "none").otherwise(F.col("status"))
    answers = found.select("cache_key", status.alias("status"), name.alias("name"), lat.alias("lat"), lng.alias("lng"))
    return asked.join(answers, "cache_key", "left").select(key, F.coalesce("status", F.lit("unasked")).alias("status"), "name", "lat", "lng")


def page_images(df: DataFrame, key: str) -> DataFrame:
    """(key, status, title, source): of the pages of an answer, an object by page id, the first by id that has an image."""
    p = parsed(df.select(key, "payload"))
    pages = F.coalesce(get(F.col("v"), "$.query.pages", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    with_image = F.filter(F.map_values(pages), lambda x: get(x, "$.original.source", "string").isNotNull())
    first = F.try_element_at(with_image, F.lit(1))
    status = F.when((F.col("status") == "hit") & first.isNull(), "none").otherwise(F.col("status"))
    return p.select(key, status.alias("status"), get(first, "$.title", "string").alias("title"), get(first, "$.original.source", "string").alias("source"))
