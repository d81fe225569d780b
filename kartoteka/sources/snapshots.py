"""Sinks: CSV, JSON, GeoJSON, sitemap and versioned snapshots."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.operators.shared import versions


def compact_json(*columns: Column | str) -> Column:
    """An object without nulls; wrap texts in nullif(x, '') to drop empty ones."""
    return F.to_json(F.struct(*columns))


def write_csv(df: DataFrame, path: str, empty: bool = False) -> None:
    """Nulls as empty fields; `empty` fills texts first, as a download does."""
    (df.na.fill("") if empty else df).write.option("header", True).option("nullValue", "").csv(path)


def write_dump(df: DataFrame, path: str) -> None:
    """All values as quoted texts of a CSV that landing.restored reads back unchanged: null is \\N, a text that starts with a backslash gets one more; blanks, empty texts and line ends of any kind stay."""
    told = lambda c: F.coalesce(F.when(F.startswith(c, F.lit("\\")), F.concat(F.lit("\\"), c)).otherwise(c), F.lit("\\N"))
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": "", "lineSep": "\n"}
    df.select(*[told(F.col(c).cast("string")).alias(c) for c in df.columns]).write.options(header=True, escape='"', quoteAll=True, **kept).csv(path)


def write_documents(df: DataFrame, path: str, key: str) -> None:
    """One JSON document per key, in folders by key."""
    df.write.partitionBy(key).json(path)


def sitemap_urls(*parts: DataFrame) -> DataFrame:
    """UNION ALL of (url), escaped, as sitemap entries."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    safe = F.replace(F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return out.select(F.concat(F.lit("<url><loc>"), safe, F.lit("</loc></url>")).alias("entry"))


def path_part(c: Column) -> Column:
    """A name as part of a path: percent-encoded but for letters, digits, `-._~` and `/`."""
    out = F.url_encode(c)
    for coded, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(coded), F.lit(plain))
    return out


def sitemap_lines(pages: DataFrame, site: str, day: str) -> DataFrame:
    """(file, place, line) of sitemap.xml for pages (path, priority, freq), and of the robots.txt that names it.

    Place orders the lines: 0 for what opens a file, 1 for entries, 2 for what closes it.
    """
    safe = F.replace(F.replace(F.replace(F.col("path"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    entry = F.concat(F.lit(f"<url><loc>{site}"), safe, F.lit(f"</loc><lastmod>{day}</lastmod><changefreq>"), "freq", F.lit("</changefreq><priority>"), "priority", F.lit("</priority></url>"))
    frame = [
        ("sitemap.xml", 0, '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), ("sitemap.xml", 2, "</urlset>"),
        ("robots.txt", 0, "User-agent: *\nAllow: /"), ("robots.txt", 2, f"\nSitemap: {site}/sitemap.xml"),
    ]
    return pages.select(F.lit("sitemap.xml").alias("file"), F.lit(1).alias("place"), entry.alias("line")).unionAll(pages.sparkSession.createDataFrame(frame, "file string, place int, line string"))


def write_lines(lines: DataFrame, path: str, *order: str) -> None:
    """The texts of `line` in the order, ranges of it as files one after the other, in a folder per `file`."""
    lines.repartitionByRange("file", *order).sortWithinPartitions("file", *order).select("file", "line").write.partitionBy("file").text(path)


def geojson_feature(lat: Column, lng: Column, **properties: Column) -> Column:
    geometry = F.struct(F.lit("Point").alias("type"), F.array(lng, lat).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*[v.alias(k) for k, v in properties.items()]).alias("properties")))


def manifest(counts: dict[str, int], generated_at: str, version: int = 1) -> str:
    return json.dumps({"schema_version": version, "generated_at": generated_at, "counts": counts}, sort_keys=True)


def versioned_path(base: str, stamp: str) -> str:
    """A new folder for every snapshot; nothing is overwritten in place."""
    return f"{base}/v={stamp}"


def rebuild(df: DataFrame, base: str) -> DataFrame:
    """A derived table dropped and built again: written to a new version below base, which is read from then on; older versions go once it is finished.

    A run that breaks off leaves the version before it in place.
    """
    spark = df.sparkSession
    before = versions(spark, base)
    df.write.parquet(versioned_path(base, f"{len(before) and int(before[-1]) + 1:010d}"))
    Path = spark._jvm.org.apache.hadoop.fs.Path
    for old in before:
        path = Path(versioned_path(base, old))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return spark.read.schema(df.schema).parquet(versioned_path(base, versions(spark, base)[-1]))
