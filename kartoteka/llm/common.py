"""What the operators share: input columns, shared tables, hashing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whitespace as the contracts name it: space and 0x09-0x0D.
SPACES = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, one of our own on a local master (tests), an error on a cluster."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="kartoteka-"))
        found = context.getCheckpointDir()
    return found


def stored(df: DataFrame, name: str, by: tuple[str, ...] = (), codec: str = "snappy") -> DataFrame:
    """Cut lineage: write df as a table in the shared folder (in folders by the columns `by`) and read it again.

    A lost executor then costs no more than its running tasks.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).partitionBy(*by).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete tables that `stored` wrote and no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_names(wanted: list[str], taken: list[str]) -> list[str]:
    """The wanted names, each with as many underscores after it as it takes to be apart from those taken (Spark's names ignore case)."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def words(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % n


def settled(df: DataFrame) -> DataFrame:
    """df as it is, computed once per row: a filter on one of its columns is not rewritten in terms of what lies below.

    The optimizer would put the whole of a costly expression into such a filter, once for every mention.
    """
    return df.select(F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("_x")).select("_x.*")
