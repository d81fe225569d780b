"""Benchmark decontamination with suffix arrays of the training texts.

Each shard (a run of whole documents inside one Spark partition) gets a suffix array over its words. Every suffix of
every benchmark item is searched in it by binary search: the neighbours of its place give the longest verbatim match
and its location. Where that is a window or more (10 words, or the whole of a shorter item), the interval of the window
gives all its occurrences. Documents inside such an occurrence are affected and removed; their longest verbatim match is
read off the items' suffixes around each such place.

Texts are compared as words: A-Z lower-cased, then runs of a-z, 0-9 and anything beyond ASCII. Words are compared by
64-bit hashes against the benchmark's vocabulary; words outside of it match nothing and end a match.

The benchmark is written once, in blocks of at most about BLOCK_BYTES by a hash of the item. Each block is read to the
driver and broadcast by itself. One block (nearly all benchmarks) is searched in one pass over the texts; with more,
every pass writes the marks of the rows that it hits, and its broadcast goes before the next comes, so the benchmark's
size is not bounded by memory.

Defined cases: null and empty texts have no words; items without words have no windows; equal items each count; a null
item id is skipped from the list of ids but its windows hit; repeated documents each get the same answer; a text of any
length is one part of one shard; of equally long matches the first place counts; empty tables give empty or unaffected
results. Other columns of the input are carried along by `remove`, whatever their names, and never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.llm import tokens
from kartoteka.llm.common import stored

WINDOW = 10
BLOCK_BYTES = 8 << 20
#: Words of a shard; one document is never split.
SHARD_BYTES = 6 << 20


@dataclass
class Tests:
    """Benchmark items as ranks of their words: vocabulary, all suffixes, and the windows among them."""

    vocabulary: np.ndarray  # sorted word hashes; rank = place + 1
    words: np.ndarray  # ranks of all items, one after the other, each closed by -1
    item: list  # item ids
    suffix: np.ndarray  # starts of all suffixes
    left: np.ndarray  # words from there to the end of the item
    suffix_item: np.ndarray
    window: np.ndarray  # starts of distinct windows
    length: np.ndarray
    window_items: list  # for each, indexes of items
    window_of: np.ndarray  # for each suffix the window that starts there, or -1
    sorted_suffix: np.ndarray  # suffixes in the order of their words


def prepare(rows: list[tuple]) -> Tests:
    texts = pa.array([r[1] for r in rows], pa.string())
    data, offsets = tokens.buffers(texts)
    data = tokens.LOWER[data[: offsets[-1]]] if len(data) else data
    starts, ends, first = tokens.spans(data, offsets, tokens.WORD)
    h = tokens.hashes(data, starts, ends)
    vocabulary = np.unique(h)
    rank = (np.searchsorted(vocabulary, h) + 1).astype(np.int64)
    words, suffix, left, owner, seen, window_of = [], [], [], [], {}, []
    at = 0
    for i in range(len(rows)):
        own = rank[first[i] : first[i + 1]]
        n, width = len(own), min(WINDOW, len(own))
        words += [own, [-1]]
        suffix += range(at, at + n)
        left += range(n, 0, -1)
        owner += [i] * n
        for j in range(n):
            if j + width > n:
                window_of.append(-1)
                continue
            spot = seen.setdefault(own[j : j + width].tobytes(), (len(seen), at + j, width, set()))
            spot[3].add(i)
            window_of.append(spot[0])
        at += n + 1
    spots = list(seen.values())
    ints = lambda x: np.array(x, dtype=np.int64)
    flat, left = np.concatenate([ints([]), *map(ints, words)]), ints(left)
    return Tests(
        vocabulary, flat, [r[0] for r in rows], ints(suffix), left, ints(owner), ints([x[1] for x in spots]), ints([x[2] for x in spots]), [sorted(x[3]) for x in spots],
        ints(window_of), suffix_array(np.maximum(flat, 0), int(max(left.max(initial=1), 1))),
    )


def suffix_array(rank: np.ndarray, depth: int) -> np.ndarray:
    """Places with rank > 0, sorted by the ranks from there on, to `depth` words or more, by prefix doubling.

    Foreign words (rank 0) get a rank of their own below all others, so ties end there.
    """
    n = len(rank)
    key = rank.copy()
    foreign = rank == 0
    key[foreign] = -np.arange(1, foreign.sum() + 1)
    order = np.flatnonzero(~foreign)
    if not len(order):
        return order
    order = order[np.argsort(key[order], kind="stable")]
    group = np.full(n + 1, -n - 2, dtype=np.int64)
    group[:-1] = key
    step = 1
    change = np.r_[True, key[order][1:] != key[order][:-1]]
    place = np.maximum.accumulate(np.where(change, np.arange(len(order)), 0))
    group[order] = place  # the first place of a group of equals names it
    while step < depth:
        size = np.diff(np.r_[np.flatnonzero(change), len(order)])
        open_ = np.repeat(size > 1, size)
        if not open_.any():
            break
        at = np.flatnonzero(open_)
        who = order[at]
        follow = group[np.minimum(who + step, n)]
        again = np.lexsort((follow, group[who]))
        who, follow = who[again], follow[again]
        order[at] = who
        fresh = np.r_[True, (group[who][1:] != group[who][:-1]) | (follow[1:] != follow[:-1])]
        change[at] |= fresh
        place = np.maximum.accumulate(np.where(change, np.arange(len(order)), 0))
        group[order] = place
        step *= 2
    return order


def _compare(train: np.ndarray, at: np.ndarray, words: np.ndarray, test: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sign of train suffix against test prefix of `limit` words, words in common)."""
    sign, common = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    live = np.flatnonzero(limit > 0)
    k = 0
    while len(live):
        a, b = train[np.minimum(at[live] + k, len(train) - 1)], words[test[live] + k]
        a = np.where(at[live] + k < len(train), a, 0)
        differs = a != b
        sign[live[differs]] = np.where(a[differs] < b[differs], -1, 1)
        live = live[~differs]
        k += 1
        common[live] = k
        live = live[limit[live] > k]
    return sign, common


def search(train: np.ndarray, order: np.ndarray, words: np.ndarray, test: np.ndarray, limit: np.ndarray, upper: bool = False) -> np.ndarray:
    """For every test suffix its first place in the suffix array (or the end of its equals), by binary search."""
    low, high = np.zeros(len(test), np.int64), np.full(len(test), len(order), np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        sign, _ = _compare(train, order[middle], words, test[live], limit[live])
        right = sign <= 0 if upper else sign < 0
        low[live[right]] = middle[right] + 1
        high[live[~right]] = middle[~right]


@dataclass
class Found:
    """What a shard's suffix array tells."""

    counts: np.ndarray  # words of each document
    heads: np.ndarray  # first word of each document
    hit: np.ndarray  # mask over all words
    pairs: np.ndarray  # (2, n): document and window
    length: np.ndarray  # of every test suffix the longest match ...
    doc: np.ndarray  # ... its document
    word: np.ndarray  # ... and the word there
    longest: np.ndarray  # of each document with a hit the longest match
    longest_at: np.ndarray  # and its first place, in words


def shard(data: np.ndarray, offsets: np.ndarray, t: Tests) -> Found:
    data = tokens.LOWER[data]
    starts, ends, first = tokens.spans(data, offsets, tokens.WORD)
    h = tokens.hashes(data, starts, ends)
    counts = np.diff(first)
    # One foreign word stands between documents, so no match crosses from one to the next.
    doc = np.repeat(np.arange(len(counts)), counts)
    rank = np.zeros(len(h) + len(counts), dtype=np.int64)
    if len(t.vocabulary):
        place = np.minimum(np.searchsorted(t.vocabulary, h), len(t.vocabulary) - 1)
        rank[np.arange(len(h)) + doc] = np.where(t.vocabulary[place] == h, place + 1, 0)
    heads = first[:-1] + np.arange(len(counts))
    order = suffix_array(rank, int(max(t.left.max(initial=1), 1)))
    spot = search(rank, order, t.words, t.suffix, t.left)
    length, where = _nearest(rank, order, spot, t.words, t.suffix, t.left)
    own = np.where(length > 0, np.searchsorted(heads, where, "right") - 1, -1)
    word = np.where(length > 0, where - heads[own], -1)
    # Windows that occur, by the suffixes that start with them.
    able = np.flatnonzero(t.window_of >= 0)
    able = np.unique(t.window_of[able[length[able] >= t.length[t.window_of[able]]]])
    low = search(rank, order, t.words, t.window[able], t.length[able])
    n = search(rank, order, t.words, t.window[able], t.length[able], upper=True) - low
    which = np.repeat(able, n)
    at = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
    delta = np.zeros(len(rank) + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + t.length[which], -1)
    hit = np.cumsum(delta[:-1]) > 0
    pair_doc = np.searchsorted(heads, at, "right") - 1
    pairs = np.unique(np.stack([pair_doc, which]), axis=1) if len(at) else np.zeros((2, 0), np.int64)
    # The longest match from each of these places on: its neighbours among the items' own suffixes, or a whole short item.
    longest, longest_at = np.zeros(len(counts), np.int64), np.full(len(counts), -1)
    places = np.unique(at)
    if len(places):
        mine = np.searchsorted(heads, places, "right") - 1
        rest = heads[mine] + counts[mine] - places
        size, _ = _nearest(t.words, t.sorted_suffix, search(t.words, t.sorted_suffix, rank, places, rest), rank, places, rest)
        short = np.zeros(len(places), np.int64)
        np.maximum.at(short, np.searchsorted(places, at), t.length[which])
        size = np.where(size >= WINDOW, size, short)
        first_best = np.lexsort((places, -size, mine))
        keep = first_best[np.r_[True, mine[first_best][1:] != mine[first_best][:-1]]]
        longest[mine[keep]], longest_at[mine[keep]] = size[keep], places[keep] - heads[mine[keep]]
    return Found(counts, heads, hit, pairs, length, own, word, longest, longest_at)


def _nearest(text: np.ndarray, order: np.ndarray, spot: np.ndarray, words: np.ndarray, test: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words in common, place in text) of the longest match among the two neighbours of each suffix's place in order."""
    size, place = np.zeros(len(spot), np.int64), np.zeros(len(spot), np.int64)
    for near in (spot - 1, spot) if len(order) else ():
        ok = (near >= 0) & (near < len(order))
        where = order[np.clip(near, 0, len(order) - 1)]
        _, common = _compare(text, where, words, test, np.where(ok, limit, 0))
        better = common > size
        size[better], place[better] = common[better], where[better]
    return size, place


def blocks(bench: DataFrame) -> tuple[DataFrame, int]:
    """(item_id, text, block) written in folders by block, and the number of blocks."""
    cut = bench.select("item_id", "text")
    size = cut.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES) or 1
    return stored(cut.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int")), "benchmark", by=("block",)), n


def _load(cut: DataFrame, block: int) -> Tests:
    return prepare([tuple(r) for r in cut.filter(F.col("block") == block).select("item_id", "text").toLocalIterator()])


_MARKS = "n long, hits array<long>, items array<string>, longest long, longest_at long"


def _scan(shared, column: str, only_hits: bool):
    """Rows with marks (hits as disjoint runs of words) put beside their columns; `column` is dropped, and so are rows without a hit if asked for."""

    def scan(batches):
        for batch in batches:
            for row, end, data, offsets in tokens.slices(batch.column(column), SHARD_BYTES):
                found, t = shard(data, offsets, shared.value), shared.value
                items, hits = [set() for _ in found.counts], [[] for _ in found.counts]
                for d, w in found.pairs.T:
                    items[d].update(str(t.item[i]) for i in t.window_items[w] if t.item[i] is not None)
                for d in np.unique(found.pairs[0]):
                    own = np.r_[False, found.hit[found.heads[d] : found.heads[d] + found.counts[d]], False]
                    hits[d] = np.flatnonzero(own[1:] != own[:-1]).tolist()
                marks = [pa.array(found.counts, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(found.longest), pa.array(found.longest_at)]
                part = batch.slice(row, end - row)
                part = part.drop_columns([column]) if only_hits else part
                out = pa.record_batch([*part.columns, *marks], [*part.schema.names, "n", "hits", "items", "longest", "longest_at"])
                yield out.filter(pa.array(found.longest > 0)) if only_hits else out

    return scan


def marked(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """docs (columns that start with `_`, a text in `_text`) and for each row its words `n`, `hits` as (start, end) one after the other, `items`, `longest` and `longest_at`."""
    spark = docs.sparkSession
    cut, n_blocks = blocks(bench)
    fields = lambda d: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema)
    if n_blocks == 1:
        return docs.mapInArrow(_scan(spark.sparkContext.broadcast(_load(cut, 0)), "_text", False), f"{fields(docs)}, {_MARKS}")
    own = stored(docs.withColumn("_rid", F.monotonically_increasing_id()), "documents")
    parts = []
    for block in range(n_blocks):
        shared = spark.sparkContext.broadcast(_load(cut, block))
        ids = own.select("_rid", "_text")
        parts.append(stored(ids.mapInArrow(_scan(shared, "_text", True), f"_rid long, {_MARKS}"), "marks"))
        shared.destroy()
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    runs = F.transform("hits", lambda x, i: F.when(i % 2 == 0, F.struct(x.alias("s"), F.get("hits", i + 1).alias("e"))))
    best = F.max(F.struct("longest", (-F.col("longest_at")).alias("at")))
    merged = every.withColumn("runs", F.array_compact(runs)).groupBy("_rid").agg(
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), best.alias("best")
    )
    none = F.expr("array()")
    empty = prepare([])  # counts words alike
    counted = own.mapInArrow(_scan(spark.sparkContext.broadcast(empty), "_text", False), f"{fields(own)}, {_MARKS}").drop("hits", "items", "longest", "longest_at")
    joined = counted.join(merged, "_rid", "left")
    grown = F.expr("""aggregate(runs, array() :: array<long>, (a, x) -> if(size(a) > 0 and x.s <= a[size(a) - 1],
        concat(slice(a, 1, size(a) - 1), array(greatest(a[size(a) - 1], x.e))), concat(a, array(x.s, x.e))))""")
    return joined.select(
        *docs.columns, "n", F.coalesce(grown, none).alias("hits"), F.coalesce(F.array_sort("items"), none).alias("items"),
        F.coalesce("best.longest", F.lit(0)).alias("longest"), F.coalesce(-F.col("best.at"), F.lit(-1)).alias("longest_at"),
    )


def report(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The digest: one row per document, its longest verbatim match of a window or more (0: none) and where that starts, in words from 0."""
    found = marked(docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")), bench)
    n_hit = F.aggregate(F.transform("hits", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        F.col("_id").alias("doc_id"), F.col("n").alias("n_words"), n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"), "longest", "longest_at",
    )


def remove(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents that no window touches, with all their columns."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # the input may have any names
    own = docs.toDF(*names).withColumn("_text", F.col(names[docs.columns.index("text")]))
    return marked(own, bench).filter(F.size("hits") == 0).select(*names).toDF(*docs.columns)


def longest_matches(docs: DataFrame, bench: DataFrame, least: int = 2) -> DataFrame:
    """The longest verbatim match of every test suffix over all shards: item_id, item_word, length, doc_id, doc_word.

    Ties go to the smaller document id, then place. The item's and the document's ids are integers or strings.
    """
    spark = docs.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in [*bench.select("item_id").schema, *docs.select("doc_id").schema]}
    schema = f"item_id {kinds['item_id']}, item_word long, length long, doc_id {kinds['doc_id']}, doc_word long"
    parts = []
    cut, n_blocks = blocks(bench)
    for block in range(n_blocks):
        shared = spark.sparkContext.broadcast(_load(cut, block))

        def scan(batches, shared=shared):
            t = shared.value
            heads = np.r_[0, np.flatnonzero(t.words == -1)[:-1] + 1] if len(t.words) else np.zeros(0, np.int64)
            for batch in batches:
                for row, end, data, offsets in tokens.slices(batch.column("text"), SHARD_BYTES):
                    found = shard(data, offsets, t)
                    ok = np.flatnonzero(found.length >= least)
                    own = t.suffix_item[ok]
                    yield pa.record_batch({
                        "item_id": pa.array([t.item[i] for i in own], batch_type(kinds["item_id"])), "item_word": pa.array(t.suffix[ok] - heads[own], pa.int64()),
                        "length": pa.array(found.length[ok], pa.int64()), "doc_id": batch.column("doc_id").slice(row, end - row).take(pa.array(found.doc[ok], pa.int64())), "doc_word": pa.array(found.word[ok], pa.int64()),
                    })

        parts.append(stored(docs.select("doc_id", "text").mapInArrow(scan, schema), "matches"))
        shared.destroy()
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    best = F.min_by(F.struct("length", "doc_id", "doc_word"), F.struct(-F.col("length"), F.col("doc_id"), F.col("doc_word")))
    return found.groupBy("item_id", "item_word").agg(best.alias("b")).select("item_id", "item_word", "b.length", "b.doc_id", "b.doc_word")


def batch_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


ORACLE_SQL = rf"""
with lower_docs as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark),
cut as (select item_id, ws, least({WINDOW}, len(ws)) as m, unnest(range(1, len(ws) - least({WINDOW}, len(ws)) + 2)) as i from items where len(ws) > 0),
win as (select distinct item_id, m, list_slice(ws, i, i + m - 1) as k from cut),
sizes as (select distinct m from win),
spot as (select r, m, ws, unnest(range(1, len(ws) - m + 2)) as i from lower_docs, sizes where len(ws) >= m),
hit as (select r, i, s.m, item_id from (select r, i, m, list_slice(ws, i, i + m - 1) as k from spot) s join win using (m, k)),
places as (select r, s.i, s.m, item_id, c.i as j from (select r, i, m, list_slice(ws, i, i + m - 1) as k from spot) s
  join (select item_id, m, i, list_slice(ws, i, i + m - 1) as k from cut) c using (m, k)),
island as (select *, i - row_number() over (partition by r, item_id, m, i - j order by i) as g from (select distinct * from places)),
run as (select r, min(i) as spot, max(i) - min(i) + any_value(m) as n from island group by r, item_id, m, i - j, g),
best as (select r, max(n) as longest, min(case when n = top then spot end) - 1 as longest_at from (select *, max(n) over (partition by r) as top from run) group by r),
word as (select r, count(distinct p) as n from (select r, unnest(range(i, i + m)) as p from hit) group by r),
item as (select r, count(distinct item_id) as n, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from hit group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(word.n, 0)::bigint as n_hit, coalesce(item.n, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(word.n, 0) > 0 as contaminated,
  coalesce(longest, 0)::bigint as longest, coalesce(longest_at, -1)::bigint as longest_at
from lower_docs left join word using (r) left join item using (r) left join best using (r)
"""
