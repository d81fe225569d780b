"""Prefix search over an inverted index, with phrases for terms that hold punctuation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.functions.text import fold

_SPLIT = "[^\\p{L}\\p{N}]+"


def build_index(docs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, pos, token): one row per word of every field, folded."""
    one = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.filter(F.split(fold(F.col(f)), _SPLIT), lambda w: w != "").alias("words")) for f in fields]))
    return docs.select(key, one.alias("f")).select(key, "f.field", F.posexplode("f.words").alias("pos", "token"))


def _letter(token):
    """The folder of a token: its first character."""
    return F.left(token, F.lit(1))


def write_index(index: DataFrame, path: str) -> None:
    """The index on disk: a folder for each first letter, files of ranges of tokens, sorted. A prefix is read from one folder, and from its row groups that hold it."""
    index.withColumn("letter", _letter(F.col("token"))).repartitionByRange("token", "pos").sortWithinPartitions("letter", "token").write.partitionBy("letter").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    known = spark.read.parquet(path)
    return spark.read.schema(known.drop("letter").schema.add("letter", "string")).parquet(path)


def refreshed_index(index: DataFrame, changed: DataFrame, key: str, fields: list[str], gone: DataFrame | None = None) -> DataFrame:
    """The index after some documents changed or (gone: key) went: only these are read again. Write it to a new folder."""
    out = changed.select(key) if gone is None else changed.select(key).unionByName(gone.select(key))
    kept = index.drop("letter").join(out.distinct(), key, "left_anti")
    return kept.unionByName(build_index(changed, key, fields))


def search(index: DataFrame, key: str, query: str) -> DataFrame:
    """Keys that have every term as a prefix of a word, in any field. A term with punctuation is a phrase whose last word is a prefix.

    A query that is empty after folding finds nothing. An index with folders by letter is read from those of the terms alone.
    """
    import re

    from kartoteka.functions.text import _FROM, _TO

    low = query.translate(str.maketrans("đĐ" + _FROM, "dD" + _TO)).lower()
    terms = [[w for w in re.split(r"[\W_]+", t) if w] for t in low.split()]
    terms = [t for t in terms if t]
    if not terms:
        return index.select(key).filter(F.lit(False))
    held = lambda w: index.filter(F.col("letter") == w[0]) if "letter" in index.columns else index
    hits = []
    for words in terms:
        *exact, last = words
        found = held(last).filter(F.col("token").startswith(last)).select(key, "field", (F.col("pos") - len(exact)).alias("at"))
        for k, w in enumerate(exact):
            found = found.join(held(w).filter(F.col("token") == w).select(key, "field", (F.col("pos") - k).alias("at")), [key, "field", "at"], "left_semi")
        hits.append(found.select(key).distinct())
    return reduce(lambda a, b: a.join(b, key, "left_semi"), hits)


def substring_search(docs: DataFrame, fields: list[str], query: str) -> DataFrame:
    """The client-side search: the folded query inside any of the fields."""
    from kartoteka.functions.text import deburr

    blob = F.concat_ws(" ", *[deburr(F.col(f)) for f in fields])
    return docs.filter(blob.contains(deburr(F.lit(query))))


def client_filter(clubs: DataFrame, query: str = "", tier: int | None = None, county: str | None = None, mobile: bool = False, landline: bool = False, email: bool = False, full: bool = False) -> DataFrame:
    """What the browser shows of clubs (canonical_name, short_name, city, county, top_tier, phone_kind, phone, email, website, ...): the club's best league counts as its tier, the query may stand anywhere."""
    some = lambda *cs: F.greatest(*[F.coalesce(F.col(c) != "", F.lit(False)) for c in cs]) if len(cs) > 1 else F.coalesce(F.col(cs[0]) != "", F.lit(False))
    rules = [
        (tier, F.col("top_tier") == F.lit(tier)), (county, F.col("county") == F.lit(county)), (mobile, F.col("phone_kind") == "mobile"), (landline, F.col("phone_kind") == "landline"),
        (email, some("email")), (full, (F.col("phone_kind") == "mobile") & some("phone") & some("email") & some("address") & some("website", "fb_url", "ig_url")),
    ]
    for wanted, rule in rules:
        if wanted:
            clubs = clubs.filter(F.coalesce(rule, F.lit(False)))
    return substring_search(clubs, ["canonical_name", "short_name", "city", "county"], query.strip()) if query.strip() else clubs
