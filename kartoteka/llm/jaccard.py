"""N-gram Jaccard self-join by chosen paths.

A document is the set of its 5-word shingles (words are maximal runs without whitespace; a text of 1 to 4 words is one
shingle of all it has). Texts with equal sets form a class; one representative goes on with the number of copies.

In each run a set walks down a path: at every level it chooses the token that a shared random order puts first, so
two sets with similarity J choose the same with probability J. A bucket (sets with one path) of at most SMALL sets is
compared by brute force; a larger one splits on another token, down to DEPTH levels, and what is then still large (a
large group of near copies) is compared in blocks of some BLOCK_BYTES of sets, each two blocks once, a tile of TILE sets
at a time: what a task holds is bounded by bytes, and a set travels once per block, not once per partner. Sizes of
buckets are joined back by a shuffle, whose hot keys Spark's skewed joins split; most sets are alone in their bucket, and
a bitmap of fixed size keeps these out of it, so nothing that grows with the sets passes through the driver. Runs repeat
until a pair at the threshold is met with probability RECALL. Buckets with the same members as one of an earlier run are not compared again, and a pair counts in the first
run that brings it together, so links are counted once and no pair is ever emitted: a bucket gives, for each member,
its links and the smallest member it is connected with.

Defined cases: texts without words (null, empty, blank) have no set, link to nothing and are classes of their own;
rows that repeat an id are different documents; null ids are kept; an empty table gives an empty result; other
columns are carried by `keep_one`, whatever their names, and never looked at; a very long text is one set, held whole. Similarity is exact on 64-bit shingle hashes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.llm import tokens
from kartoteka.llm.common import discard, stored

SHINGLE = 5
#: The threshold as a fraction: similarity >= NUM / DEN.
NUM, DEN = 4, 5
SMALL, DEPTH = 256, 3
#: Bytes of the sets of a block (one set may be larger), sets compared at once.
BLOCK_BYTES, TILE = 8 << 20, 512
#: Buckets whose sizes (some 150 bytes each where they are broadcast) go to all tasks.
BROADCAST_BUCKETS = 20_000
#: Bits of the bitmap that tells buckets of one set from others: 8 MB in all, in rows of MAP_BITS (fixed by Spark's bitmap functions).
FILTER_BITS, MAP_BITS = 1 << 26, 1 << 15
RECALL = 0.9999
#: Rounds of the components loop; min labels with pointer jumping need about log2 of the longest chain.
ROUNDS = 60


def runs(recall: float = RECALL, depth: int = DEPTH, num: int = NUM, den: int = DEN) -> int:
    """Runs after which a pair at the threshold met in a bucket with probability `recall`, if all of its buckets lie deepest."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (num / den) ** depth))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, offsets)."""
    starts, ends, first = tokens.spans(data, offsets, tokens.NOT_SPACE)
    keys, docs = tokens.windows(tokens.hashes(data, starts, ends), first, k)
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    return keys[fresh], np.searchsorted(docs[fresh], np.arange(len(offsets)))


def _choice(n: int) -> np.ndarray:
    """Odd multipliers: each gives one random order of tokens."""
    return tokens.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def paths(keys: np.ndarray, offsets: np.ndarray, n_runs: int, depth: int) -> np.ndarray:
    """(texts, runs * depth) path hashes: level d of a run names the tokens chosen on levels 0 to d. Texts without shingles get 0."""
    some = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, n_runs * depth), dtype=np.uint64)
    if not len(some):
        return out
    odd = _choice(n_runs * depth)
    for c in range(n_runs * depth):
        least = np.minimum.reduceat(keys * odd[c], offsets[some])
        above = out[some, c - 1] if c % depth else np.uint64(0)
        out[some, c] = tokens.mix(least ^ tokens.mix(above + np.uint64(c + 1)))
    return out


def sketch(docs: DataFrame, n_runs: int, depth: int) -> DataFrame:
    """One row per document: rid, doc_id, text key, print (16 bytes, null without words), paths."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make(batches):
        for batch in batches:
            for row, end, data, offsets in tokens.slices(batch.column("text")):
                keys, at = shingle_sets(data, offsets)
                raw = keys.view(np.uint8)
                prints = [hashlib.md5(raw[a * 8 : b * 8]).digest() if b > a else None for a, b in zip(at[:-1], at[1:], strict=True)]
                p = paths(keys, at, n_runs, depth).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.reshape(-1), pa.int64()))
                own = batch.slice(row, end - row)
                yield pa.record_batch([own.column("doc_id"), own.column("tkey"), pa.array(prints, pa.binary()), pa.array(np.diff(at) * 8), lists], ["doc_id", "tkey", "print", "bytes", "paths"])

    schema = f"doc_id {kind}, tkey long, print binary, bytes long, paths array<long>"
    made = docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text").mapInArrow(make, schema)
    return made.withColumn("rid", F.monotonically_increasing_id())


def representatives(rows: DataFrame) -> DataFrame:
    """One row per class of equal sets: the row with the smallest (doc_id, rid), and copies."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))).alias("m")
    classes = rows.filter("print is not null").groupBy("print").agg(first, F.count("*").alias("copies")).select("m.rid", "copies")
    return rows.join(classes, "rid").select("rid", "doc_id", "tkey", "print", "bytes", "copies", "paths")


def _back(rows: DataFrame, few: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with `few`, one row per (run, term): broadcast where counting shows that it is short, else by a shuffle."""
    few = stored(few, "buckets")
    if few.count() <= BROADCAST_BUCKETS:
        return rows.join(F.broadcast(few), ["run", "term"], how)
    return (_maybe_in(rows, few) if how == "inner" else rows).join(few.hint("merge"), ["run", "term"], how)


def _maybe_in(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows whose (run, term) is listed, and a few others: a bitmap over hashes, 4 KB a row, is broadcast."""
    slot = F.pmod(F.xxhash64("run", "term"), F.lit(FILTER_BITS))
    at = {"_part": F.floor(slot / MAP_BITS), "_bit": F.pmod(slot, F.lit(MAP_BITS))}
    maps = listed.withColumns(at).groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    byte = F.conv(F.hex(F.expr("substring(_map, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    near = rows.withColumns(at).join(F.broadcast(maps), "_part")
    return near.filter(byte.bitwiseAND(F.pow(F.lit(2), F.pmod("_bit", F.lit(8))).cast("int")) != 0).select(*rows.columns)


def buckets(reps: DataFrame, n_runs: int, depth: int, small: int = SMALL) -> DataFrame:
    """(rid, bytes, run, term, size, weight): where each set ends in each run. Sets alone in their bucket are left out."""
    todo = reps.select("rid", "bytes", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(n_runs - 1)), lambda r: F.slice("paths", r * depth + 1, depth))).alias("run", "p"))
    done = []
    for level in range(depth):
        at = todo.withColumn("term", F.get("p", F.lit(level)))
        sizes = at.groupBy("run", "term").agg(F.count("*").alias("size"), F.sum("bytes").alias("weight")).filter("size > 1")
        deeper = F.when((F.col("size") > small) & F.lit(level < depth - 1), F.col("p")).alias("p")
        # Written in any case: a join that only a write follows can be split where a bucket is hot.
        found = stored(_back(at, sizes).select("rid", "bytes", "run", "term", "size", "weight", deeper), f"paths{level}")
        done.append((found if level == depth - 1 else found.filter(F.col("size") <= small)).select("rid", "bytes", "run", "term", "size", "weight"))
        todo = found.filter(F.col("size") > small).select("rid", "bytes", "run", "p")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _tasks(member: DataFrame, n_runs: int, block_bytes: int) -> DataFrame:
    """(rid, keys, terms): the comparisons a set takes part in. A bucket of more than `block_bytes` is cut by a hash into blocks, and each two blocks meet once."""
    # Buckets with the same members in a later run bring nothing new.
    names = member.groupBy("run", "term").agg(F.bit_xor(F.xxhash64("rid")).alias("who"), F.max("size").alias("size"))
    first = names.groupBy("who", "size").agg(F.min(F.struct("run", "term")).alias("f")).select("f.run", "f.term").withColumn("first", F.lit(True))
    n = F.least(F.ceil(F.col("weight") / block_bytes), F.col("size")).cast("int")
    at = F.pmod(F.xxhash64("rid", F.lit(7)), n).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda x: F.struct(F.col("run").alias("run"), F.xxhash64("term", F.least("at", x), F.greatest("at", x), "run").alias("key"), F.col("at").alias("at")))
    keyed = _back(member, first, "left").withColumn("at", at)
    keyed = keyed.withColumn("pairs", F.when(F.col("first"), pairs).otherwise(F.expr("array()")))
    slots = [F.max(F.when(F.col("run") == r, F.col("term"))).alias(f"t{r}") for r in range(n_runs)]
    gathered = keyed.groupBy("rid").agg(F.flatten(F.collect_list("pairs")).alias("pairs"), *slots)
    return gathered.filter(F.size("pairs") > 0).select("rid", "pairs", F.array(*[F.coalesce(f"t{r}", F.lit(0)) for r in range(n_runs)]).alias("terms"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set: a product of 0/1 matrices over the shingles that both sides have."""
    if len(left) == len(right) == 1:
        return np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]])
    sides = [(np.concatenate(x), np.repeat(np.arange(len(x)), [len(s) for s in x])) for x in (left, right)]
    shared = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float64)
    if not len(shared):
        return out.astype(np.int64)
    places = []
    for flat, owner in sides:
        at = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        use = np.flatnonzero(shared[at] == flat)
        use = use[np.argsort(at[use], kind="stable")]
        places.append((owner[use], at[use]))
    step = max(1, (4 << 20) // max(len(left), len(right)))
    for a in range(0, len(shared), step):
        parts = []
        for (owner, column), n in zip(places, out.shape, strict=True):
            s, e = np.searchsorted(column, (a, a + step))
            part = np.zeros((n, min(step, len(shared) - a)), np.float32)
            part[owner[s:e], column[s:e] - a] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


def compare(rid: np.ndarray, copies: np.ndarray, at: np.ndarray, terms: np.ndarray, run: int, sets: list[np.ndarray], tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """(links of each set counted with copies, smallest id each is connected with) for pairs that meet here first, a tile of pairs at a time."""
    size = np.array([len(s) for s in sets])
    links, label = np.zeros(len(rid), np.int64), rid.copy()
    two = at.min() != at.max()  # two blocks: pairs within one meet in its own task
    order = np.argsort(at, kind="stable")
    near: list[np.ndarray] = []
    parts = [order[a : a + tile] for a in range(0, len(order), tile)]
    for i, x in enumerate(parts):
        for y in parts[i:]:
            if two and at[x].max() == at[y].min() and at[x].min() == at[y].max():
                continue
            linked = (NUM + DEN) * _overlaps([sets[k] for k in x], [sets[k] for k in y]) >= NUM * (size[x][:, None] + size[y][None, :])
            linked &= x[:, None] != y[None, :]
            if two:
                linked &= at[x][:, None] != at[y][None, :]
            for r in range(run):
                linked &= (terms[x][:, None, r] != terms[y][None, :, r]) | (terms[x, r] == 0)[:, None]
            links[x] += linked @ copies[y]
            if x is not y:
                links[y] += copies[x] @ linked
            near += _spanning(linked, x, y)
    pairs = np.concatenate(near, axis=1) if near else np.zeros((2, 0), np.int64)
    while pairs.shape[1]:
        fresh = label.copy()
        np.minimum.at(fresh, pairs[0], label[pairs[1]])
        np.minimum.at(fresh, pairs[1], label[pairs[0]])
        if (fresh == label).all():
            break
        label = fresh
    return links, label


def _spanning(linked: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Links that connect what `linked` connects, no more than one for each of x and y: what is kept of a tile."""
    none = np.iinfo(np.int64).max
    a, b = np.where(linked.any(axis=1), x, none), np.where(linked.any(axis=0), y, none)
    ends = a < none, b < none
    while ends[0].any():
        c = np.minimum(a, np.where(linked, b[None, :], none).min(axis=1))
        d = np.minimum(b, np.where(linked, c[:, None], none).min(axis=0))
        if (c == a).all() and (d == b).all():
            break
        a, b = c, d
    return [np.stack([own[e], low[e]]) for own, low, e in ((x, a, ends[0]), (y, b, ends[1]))]


def _meet(batches):
    """Rows sorted by key: cut the texts into sets and compare one key's after the other, holding no more than one key's."""
    held: list[tuple] = []
    pending: dict[str, list] = {"rid": [], "links": [], "label": []}

    def close():
        own = held
        if len(own) > 1:
            rid = np.array([x[0] for x in own], np.int64)
            links, label = compare(rid, np.array([x[1] for x in own]), np.array([x[2] for x in own]), np.array([x[3] for x in own]), own[0][4], [x[5] for x in own])
            for i in np.flatnonzero(links):
                pending["rid"].append(int(rid[i]))
                pending["links"].append(int(links[i]))
                pending["label"].append(int(label[i]))

    def flush():
        out = pa.record_batch([pa.array(pending[k], pa.int64()) for k in pending], list(pending))
        for k in pending:
            pending[k].clear()
        return out

    now = None
    for batch in batches:
        for row, end, data, offsets in tokens.slices(batch.column("text"), tokens.SLICE_BYTES // 2):
            keys, cut = shingle_sets(data, offsets)
            own = batch.slice(row, end - row)
            columns = (own.column(c).to_pylist() for c in ("key", "rid", "copies", "at", "terms", "run"))
            for a, b, key, *rest in zip(cut[:-1], cut[1:], *columns, strict=True):
                if key != now:
                    close()
                    held, now = [], key
                held.append((*rest, keys[a:b].copy()))
        if len(pending["rid"]) > 5000:
            yield flush()
    close()
    yield flush()


def links(docs: DataFrame, reps: DataFrame, member: DataFrame, n_runs: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(rid, links, label) from every comparison; texts are read again, once for each (id, text). Those in some bucket travel to its tasks as texts,
    which compress, and are cut into sets (8 random bytes a shingle) where they meet."""
    todo = _tasks(member, n_runs, block_bytes).join(reps.select("rid", "doc_id", "tkey", "copies"), "rid")
    texts = docs.groupBy(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key")).agg(F.first("text").alias("text"))
    ready = todo.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tkey") == F.col("_key"))).select("rid", "copies", "pairs", "terms", "text")
    spread = ready.select("rid", "copies", "terms", "text", F.explode("pairs").alias("p"))
    dealt = spread.select(F.col("p.key").alias("key"), "rid", "copies", F.col("p.at").alias("at"), "terms", F.col("p.run").alias("run"), "text")
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_meet, "rid long, links long, label long")


def components(edges: DataFrame) -> DataFrame:
    """(rid, root): the smallest id of each node's component, by min labels and pointer jumping; every round is written."""
    both = edges.select(F.col("rid").alias("a"), F.col("label").alias("b")).filter("a <> b")
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")), "roots")
    before = label
    for _ in range(ROUNDS):
        near = both.join(label.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = label.join(near, "a").select("a", "root", F.least("root", "near").alias("next"))
        up = label.select(F.col("a").alias("next"), F.col("root").alias("up"))
        moved = stored(step.join(up, "next", "left").select("a", F.col("root").alias("old"), F.least("next", F.coalesce("up", "next")).alias("root")), "roots")
        done = moved.filter("old <> root").isEmpty()
        discard(before)
        label, before = moved.select("a", "root"), moved
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return label.withColumnRenamed("a", "rid")


def classes(docs: DataFrame, recall: float = RECALL, small: int = SMALL, block_bytes: int = BLOCK_BYTES, depth: int = DEPTH) -> DataFrame:
    """One row per document: rid, doc_id, tkey, class_id (the smallest id in its group), n_links, first (whether it is the row to keep)."""
    n_runs = runs(recall, depth)
    own = docs.select("doc_id", "text")
    rows = stored(sketch(own, n_runs, depth), "sketch")
    reps = stored(representatives(rows), "reps")
    found = stored(links(own, reps, buckets(reps, n_runs, depth, small), n_runs, block_bytes), "links")
    root = components(found.select("rid", "label"))
    total = found.groupBy("rid").agg(F.sum("links").alias("links"))
    named = reps.select("rid", "doc_id", "print", "copies").join(root, "rid", "left").join(total, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("rid")))
    heads = named.groupBy("root").agg(least.alias("head"))
    marked = named.join(heads, "root").select("print", F.col("head.id").alias("_class"), F.col("head.rid").alias("_head"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("_links"))
    out = rows.select("rid", "doc_id", "tkey", "print").join(marked, "print", "left")
    alone = F.col("print").isNull()
    return out.select("rid", "doc_id", "tkey", F.when(alone, F.col("doc_id")).otherwise(F.col("_class")).alias("class_id"), F.coalesce("_links", F.lit(0)).alias("n_links"), (alone | (F.col("rid") == F.col("_head"))).alias("first"))


def report(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with the smallest id. All columns stay; texts without words all stay."""
    named = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    text, doc_id = (F.col(f"_c{docs.columns.index(c)}") for c in ("text", "doc_id"))
    kept = classes(docs).filter("first").groupBy("doc_id", "tkey").agg(F.count("*").alias("n"))
    full = named.withColumns({"_id": doc_id, "_key": F.xxhash64(text)})
    joined = full.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tkey") == F.col("_key")))
    # An id with the same text twice: as many rows stay as the classes say.
    blank: Column = F.coalesce(text, F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")
    once = joined.filter(~blank).dropDuplicates(["_id", "_key"]).unionByName(joined.filter(blank))
    return once.select(*named.columns).toDF(*docs.columns)
