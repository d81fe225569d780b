"""Landing data: cached API payloads, dumps and lists as typed DataFrames. Fetching stays outside of Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXTRACTION = T.StructType([T.StructField(n, T.IntegerType() if n in ("stadium_capacity", "founded_year") else T.StringType()) for n in (
    "email", "phone", "address", "website", "facebook_url", "instagram_url", "twitter_url", "president_name", "stadium_name", "stadium_capacity", "founded_year", "city")])
TEAM = "team struct<id:long,shortName:string,foundationDateTimestamp:long,venue:struct<name:string,capacity:int,city:struct<name:string>,venueCoordinates:struct<latitude:double,longitude:double>>>"
FEATURES = "elements array<struct<type:string,id:long,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>>"


def cached_json(spark: SparkSession, path: str, schema: str, by_line: bool = False) -> DataFrame:
    """One payload per file, or per line of files that were packed together, which Spark can split."""
    return spark.read.schema(schema).option("multiLine", not by_line).json(path)


def teams(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """(team_id, short_name, founded, venue, capacity, city, lat, lng) from team payloads."""
    t = cached_json(spark, path, TEAM, by_line).select("team.*")
    return t.select(
        F.col("id").alias("team_id"), F.col("shortName").alias("short_name"), F.year(F.timestamp_seconds("foundationDateTimestamp")).alias("founded"), F.col("venue.name").alias("venue"),
        F.col("venue.capacity").alias("capacity"), F.col("venue.city.name").alias("city"), F.col("venue.venueCoordinates.latitude").alias("lat"), F.col("venue.venueCoordinates.longitude").alias("lng"),
    )


def features(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """(kind, osm_type, osm_id, lat, lng, sport, surface, capacity, tags) from geodata payloads; a centre counts before an own point."""
    e = cached_json(spark, path, FEATURES, by_line).select(F.explode("elements").alias("e")).select("e.*")
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    at = lambda c: F.coalesce(F.nullif(F.col(f"center.{c}"), F.lit(0.0)), F.col(c))
    kind = F.when(tag("leisure") == "stadium", "stadium").otherwise("pitch")
    return e.select(kind.alias("kind"), F.col("type").alias("osm_type"), F.col("id").alias("osm_id"), at("lat").alias("lat"), at("lon").alias("lng"), tag("sport").alias("sport"), tag("surface").alias("surface"), tag("capacity").try_cast("int").alias("capacity"), "tags")


def grounds(found: DataFrame) -> DataFrame:
    """Features that are stadiums, or pitches for football, and have a place; only stadiums keep a capacity. Of a repeated (type, id) one stays."""
    sport = F.coalesce(F.col("sport"), F.lit(""))
    pitch = (F.try_element_at("tags", F.lit("leisure")) == "pitch") & (sport.contains("soccer") | sport.contains("football"))
    kept = found.filter((F.col("kind") == "stadium") | pitch).dropna(subset=["lat", "lng"])
    return kept.withColumn("capacity", F.when(F.col("kind") == "stadium", F.col("capacity"))).dropDuplicates(["osm_type", "osm_id"])


def dump(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV dump with a header and fields of any length."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("maxCharsPerColumn", -1).csv(path)
    return df.select(*columns) if columns else df


def restored(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The columns, as texts, of what snapshots.write_dump wrote, all of its values as they were."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": "\\N", "emptyValue": "", "lineSep": "\n"}
    df = spark.read.options(header=True, multiLine=True, escape='"', maxCharsPerColumn=-1, **kept).schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    return df.select(*[F.when(F.startswith(c, F.lit("\\")), F.substr(c, F.lit(2))).otherwise(F.col(c)).alias(c) for c in columns])


def persons(spark: SparkSession, path: str) -> DataFrame:
    """(udr_id, first_name, last_name, capacity, role, place) of a dump of persons; place is their order: files by name, rows as they stand."""
    d = dump(spark, path, ["UDR_ID", "IME", "PREZIME", "SVOJSTVO", "FUNKCIJA"]).toDF("udr_id", "first_name", "last_name", "capacity", "role")
    return d.withColumn("place", F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """One trimmed value per line, blanks and # comments dropped."""
    return spark.read.text(path).select(F.trim("value").alias("value")).filter("value <> '' and not startswith(value, '#')")


def pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, html), a row per file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("html"))


def payload_key(payload: Column) -> Column:
    """Cache key of a request."""
    return F.left(F.sha2(F.to_json(payload), 256), F.lit(16))


def first_hit(requests: DataFrame, key: str, ladder: Column, cache: DataFrame) -> DataFrame:
    """The first rung of an ordered ladder of queries that the cache (query, hit) answers: (key, query, pos, hit)."""
    rungs = requests.select(key, F.posexplode(F.array_distinct(F.array_compact(ladder))).alias("pos", "query"))
    found = rungs.join(cache.filter("hit is not null"), "query")
    return found.groupBy(key).agg(F.min_by(F.struct("query", "pos", "hit"), "pos").alias("b")).select(key, "b.*")


def place_ladder(name: Column, city: Column, county: Column, address: Column) -> Column:
    """Queries for a place from the narrowest to the widest, each with the match type it would give: name with city and county, the address, the bare name."""
    town, region, street = (F.trim(F.coalesce(c, F.lit(""))) for c in (city, F.replace(county, F.lit(" županija"), F.lit("")), address))
    land = F.lit("Hrvatska")
    shapes = F.array(F.when((town != "") & (region != ""), F.concat_ws(", ", name, town, region, land)), F.when(town != "", F.concat_ws(", ", name, town, land)), F.when(region != "", F.concat_ws(", ", name, region, land)), F.concat_ws(", ", name, land))
    known = F.when(street != "", F.when(F.lower(street).contains("hrvatska"), street).otherwise(F.concat_ws(", ", street, land)))
    rungs = {"places_textsearch": shapes, "geocoding_address": F.array(known), "places_name_only": F.array(F.concat(name, F.lit(" nogometni klub Hrvatska")))}
    tagged = lambda q, tag: F.transform(F.array_distinct(F.array_compact(q)), lambda x: F.struct(x.alias("query"), F.lit(tag).alias("match_type")))
    return F.concat(*[tagged(q, tag) for tag, q in rungs.items()])


def first_tagged_hit(requests: DataFrame, key: str, ladder: Column, cache: DataFrame) -> DataFrame:
    """As first_hit, for rungs (query, match_type): (key, query, match_type, hit). A query of two types counts as the earlier rung's."""
    rungs = requests.select(key, F.posexplode(ladder).alias("pos", "rung")).select(key, "pos", "rung.*")
    found = rungs.join(cache.filter("hit is not null"), "query")
    return found.groupBy(key).agg(F.min_by(F.struct("query", "match_type", "hit"), "pos").alias("b")).select(key, "b.*")


def seed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def overridden(df: DataFrame, corrections: DataFrame, key: str) -> DataFrame:
    """Manual corrections win where they say something."""
    fixed = corrections.select(key, *[F.col(c).alias(f"_o_{c}") for c in corrections.columns if c != key])
    cols = [F.coalesce(F.col(f"_o_{c}"), F.col(c)).alias(c) if c in corrections.columns and c != key else F.col(c) for c in df.columns]
    return df.join(fixed, key, "left").select(*cols)


def answered(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """Registry answers: an empty payload is a cached miss, told apart by `found`; the fields of others by schema."""
    read = df.withColumns({"found": F.coalesce(F.col(payload) != "", F.lit(False)), "_p": F.from_json(F.nullif(payload, F.lit("")), schema)})
    return read.select(*[c for c in df.columns if c != payload], "found", "_p.*")
