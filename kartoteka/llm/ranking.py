"""Ranked lexical search by TPUT (three-phase uniform threshold) over term-partitioned postings.

Documents are read once into rows of (terms, counts), from which Spark counts the statistics of the collection. Postings
(term, row, v), where v is all of a posting's score but the weight of its term, are written as a table in folders by term;
within these, every list is cut into shards by document (buckets), as many as the counted postings ask for. So a list of
any length is spread over all tasks, and sums by document need no shuffle: the shards of one bucket meet in one task.

1. Heads: the K highest postings of every list. Sums over the lists of an item give a lower bound of its K-th score.
2. One threshold for all lists of an item, that bound divided by their number: every list sends what reaches it. What a
   document lacks is below the threshold in each list that did not send it, so its sum has an upper bound. The
   K-th highest sum is a better lower bound, and documents whose upper bound reaches it are candidates.
3. Candidates are looked up in all lists of their item, for exact scores.

Bounds are inclusive, so ties are settled on exact scores. Sums are never stored: the second phase runs once for the
bound and once for the candidates, each time within a scan of the postings.

Terms are told apart by 64-bit hashes. Postings of terms that no item has are not written. While items have at most
MOST_KEYS terms this is decided at the scan, beyond that by a join; lists of more than MOST_LISTS (item, term) pairs and
more candidates than that are joined by a shuffle instead of a broadcast.

Defined cases: null and empty texts have no terms: such documents are not counted, such items have no rows; every row is
a document of its own, also when ids repeat; rows that repeat an item_id are one item with the terms of all of them;
null ids are ids, last among equal scores; texts of any length are read whole; empty tables give an empty result; other
columns are not looked at, whatever their names.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kartoteka.llm import tokens
from kartoteka.llm.common import discard, shared_dir, stored

K = 10
#: Folders by term, and postings in a bucket.
PARTS, BUCKET_ROWS = 4, 2_000_000
MOST_KEYS, MOST_LISTS = 1 << 20, 1 << 20
#: Letters of any script, digits; A-Z after lower-casing.
WORD = tokens.WORD


def term_counts(df: DataFrame, name: str, keys: np.ndarray | None = None) -> DataFrame:
    """(name, n, keys, tfs) of the rows of (name, text) with at least one term: n terms with repeats, the distinct ones (of `keys`, if given) by hash, their counts."""
    kind = df.schema[name].dataType.simpleString()
    known = None if keys is None else df.sparkSession.sparkContext.broadcast(np.sort(keys.view(np.uint64)))

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in tokens.slices(batch.column("text")):
                data = tokens.LOWER[data]
                starts, ends, first = tokens.spans(data, offsets, WORD)
                n = np.diff(first)
                h, text = tokens.hashes(data, starts, ends), np.repeat(np.arange(end - row), n)
                if known is not None:
                    at = np.minimum(np.searchsorted(known.value, h), max(len(known.value) - 1, 0))
                    held = known.value[at] == h if len(known.value) else np.zeros(len(h), bool)
                    h, text = h[held], text[held]
                order = np.lexsort((h, text))
                h, text = h[order], text[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                spot = np.flatnonzero(new)
                tf = np.diff(np.r_[spot, len(h)]).astype(np.int32)
                full = np.flatnonzero(n)
                edges = pa.array(np.searchsorted(text[spot], np.r_[full, end - row]).astype(np.int32))
                columns = [batch.column(name).slice(row, end - row).take(pa.array(full)), pa.array(n[full]), pa.ListArray.from_arrays(edges, pa.array(h[spot].view(np.int64))), pa.ListArray.from_arrays(edges, pa.array(tf))]
                yield pa.record_batch(columns, [name, "n", "keys", "tfs"])

    return df.select(name, "text").mapInArrow(run, f"{name} {kind}, n long, keys array<long>, tfs array<int>")


def _highest(rows: DataFrame, by: str, *order) -> DataFrame:
    """The K first rows of each `by`, with `place`; Spark keeps no more than K of a task before it shuffles."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("place") <= K)


def _kth(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(item, name): the K-th highest value of each item that has as many."""
    return _highest(rows, "item", F.col(value).desc()).filter(F.col("place") == K).select("item", F.col(value).alias(name))


class Postings:
    """The written index: `table` (key, row, doc_id, v; folders by `part`, buckets by row), and statistics of the collection."""

    def __init__(self, docs: DataFrame, keys: np.ndarray | None = None):
        spark = docs.sparkSession
        # Row numbers stay, as the table is written once.
        rows = stored(term_counts(docs, "doc_id", keys).withColumn("row", F.monotonically_increasing_id()), "terms")
        self.n, self.length, postings = (x or 0 for x in rows.agg(F.count("*"), F.sum("n"), F.sum(F.size("keys"))).first())
        self.buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings // BUCKET_ROWS))
        m = F.lit(10) + F.floor(F.expr(f"(90 * n * {self.n}) div {max(self.length, 1)}"))
        apart = rows.select("row", "doc_id", m.alias("m"), "keys", "tfs").repartition(self.buckets, "row").select("row", "doc_id", "m", F.explode(F.arrays_zip("keys", "tfs")).alias("t"))
        out = apart.select(F.col("t.keys").alias("key"), "row", "doc_id", F.expr("(1000000000L * t.tfs) div (1000L * t.tfs + 8 * m)").alias("v"), F.expr(f"pmod(t.keys, {PARTS})").alias("part"))
        self.name, path = f"postings_{uuid.uuid4().hex}", f"{shared_dir(spark)}/postings-{uuid.uuid4().hex}"
        out.write.option("path", path).partitionBy("part").bucketBy(self.buckets, "row").sortBy("key").saveAsTable(self.name)
        discard(rows)
        self.table = spark.table(self.name)
        self.table._stored_at = path

    def close(self) -> None:
        self.table.sparkSession.sql(f"drop table {self.name}")
        discard(self.table)


def item_terms(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, item_id), and (item, key): each term of an item once."""
    pairs = stored(term_counts(items, "item_id").select("item_id", F.explode("keys").alias("key")).distinct(), "item_terms")
    ids = stored(pairs.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    return ids, pairs.join(ids, pairs.item_id.eqNullSafe(ids.item_id)).select("item", "key")


def _few(df: DataFrame) -> DataFrame:
    """df for broadcast, if a count shows it to be small."""
    return F.broadcast(df) if df.count() <= MOST_LISTS else df


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): the K best documents of each item."""
    ids, terms = item_terms(items)
    few = terms.select("key").distinct()
    keys = np.array([r.key for r in few.collect()], np.int64) if few.count() <= MOST_KEYS else None
    index = Postings(docs, keys)
    postings = index.table

    weight = F.floor(1000 * F.log(F.lit(2.0 * index.n + 2) / (2 * F.col("df") + 1))).cast("long")
    df = postings.groupBy("key").agg(F.count("*").alias("df"))
    lists = stored(terms.join(df, "key").select("item", "key", weight.alias("w")).filter("w > 0"), "lists")
    heads = _highest(postings.select("key", "row", "v"), "key", F.col("v").desc(), "row")
    # First phase: sums of heads.
    sums = heads.join(_few(lists), "key").groupBy("item", "row").agg(F.sum(F.col("w") * F.col("v")).alias("s"))
    low = lists.groupBy("item").agg(F.count("*").alias("m")).join(_kth(sums, "s", "low"), "item", "left").fillna(0, ["low"])
    bounds = stored(low.withColumn("least", F.expr("greatest(1, (low + m - 1) div m)")), "bounds")
    # Second phase: what reaches the threshold of all lists of an item.
    sent = _few(lists.join(bounds, "item").select("item", "key", "w", "least"))
    seen = postings.select("key", "row", "v").join(sent, "key").filter(F.col("w") * F.col("v") >= F.col("least"))
    sums = seen.groupBy("item", "row").agg(F.sum(F.col("w") * F.col("v")).alias("s"), F.count("*").alias("c"))
    better = _kth(sums.join(_few(bounds), "item").filter("s >= low").select("item", "s"), "s", "found")
    better = stored(bounds.join(better, "item", "left").select("item", "m", "least", F.greatest("low", F.coalesce("found", F.lit(0))).alias("low")), "better")
    near = stored(sums.join(_few(better), "item").filter("s + (m - c) * (least - 1) >= low").select("item", "row"), "candidates")
    # Third phase: exact scores of candidates.
    exact = postings.join(_few(near), "row").join(_few(lists), ["item", "key"]).groupBy("item", "row").agg(F.sum(F.col("w") * F.col("v")).alias("score"), F.first("doc_id").alias("doc_id"))
    best = _highest(exact.filter("score > 0"), "item", F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    found = stored(best.join(ids, "item").select("item_id", F.col("place").alias("rank"), "doc_id", "score"), "ranking")
    index.close()
    discard(lists, bounds, better, near)
    return found


ORACLE_SQL = r"""
with docs as (select row_number() over () as r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
tf as (select r, doc_id, term, count(*) as tf from docs group by all),
size as (select r, sum(tf)::bigint as n from tf group by r),
total as (select count(*)::bigint as n_docs, sum(n)::bigint as len from size),
weight as (select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, total group by term),
item as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
scored as (select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // len))))::bigint as score
  from item join weight using (term) join tf using (term) join size using (r), total group by item_id, r, doc_id),
placed as (select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from placed where rank <= 10
"""


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest."""
    return search(docs, items)
