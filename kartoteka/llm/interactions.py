"""How filters interact: which of five filters removes a document first, in every order of them.

A document's failures are five bits. A fixed table of 32 rows and 120 columns holds, for each set of failures and each
order of the filters, the step that removes the document (or that none does). Tasks look up all 120 orders of a
batch at once and count (part, order, step, label) by bincount; they send counts by part, which Spark sums.

Failures of a text alone are found in one pass, by numpy over the bytes. Whether a text is a copy needs the smallest id
of its digest (SHA-256): the narrow rows of ids and digests are joined with the smallest ids of the repeated digests;
a digest with many copies is one key of that join, whose large partitions Spark splits.

Defined cases: null texts are empty; a null source is the part ''; rows with a null id are never copies and make none; rows
that repeat an id and a text are not smaller than each other, so the first ones all stay; several labels of an id count
by the highest, null ones not at all; every part has all 600 rows, zeros included; an empty table gives an
empty result; texts of any length are read whole; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.llm import tokens
from kartoteka.llm.common import discard, stored

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
SIGNS = "#$%&*|"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
#: Parts whose counts a task holds at once.
MOST_PARTS = 256
_ORDER = np.array([[FILTERS.index(f) for f in o] for o in ORDERS])
_SIGN = tokens.table(lambda b: chr(b) in SIGNS)
_CAPITAL = tokens.table(lambda b: 0x41 <= b <= 0x5A)
_POINT = tokens.table(lambda b: not 0x80 <= b < 0xC0)


def first_failures() -> np.ndarray:
    """The step (from 0) at which each set of failures is removed by each order; 5 if it is not."""
    fails = (np.arange(32)[:, None, None] >> _ORDER[None]) & 1
    return np.where(fails.any(2), fails.argmax(2), len(FILTERS))


TABLE = first_failures()


def failures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits 0 to 3 (A to D) of each text."""
    n = len(offsets) - 1
    starts, ends, first = tokens.spans(data, offsets, tokens.NOT_SPACE)
    words, text = np.diff(first), np.repeat(np.arange(n), np.diff(first))
    h = tokens.hashes(data, starts, ends)
    order = np.lexsort((h, text))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    distinct = np.bincount(text[order][new], minlength=n)
    capitals, points, signs = (np.diff(np.r_[0, np.cumsum(kind[data], dtype=np.int64)][offsets]) for kind in (_CAPITAL, _POINT, _SIGN))
    few, same, loud = words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * points
    return few + 2 * same + 4 * loud + 8 * (signs > 0)


def flags(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, bits) of every row: bits of the filters A to D, the text's SHA-256."""
    text = F.coalesce("text", F.lit(""))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in tokens.slices(batch.column("text")):
                own = batch.slice(row, end - row)
                yield pa.record_batch([own.column("doc_id"), own.column("part"), own.column("digest"), pa.array(failures(data, offsets))], ["doc_id", "part", "digest", "bits"])

    given = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    return given.mapInArrow(run, f"doc_id {kind}, part string, digest binary, bits long")


def _rows(sums: dict[str, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """600 rows of counts for each part, from counts by (order, step, label) and by failures."""
    out: dict[str, list] = {c: [] for c in COUNTS}
    for by_step, by_mask in sums.values():
        cells = by_step.reshape(len(ORDERS), 6, 4)
        removed, kept = cells.sum(2)[:, :5], cells.sum(2)[:, ::-1].cumsum(1)[:, ::-1][:, 1:]
        fails = np.array([by_mask[(np.arange(32) >> f) & 1 == 1].sum() for f in range(5)])
        share = np.bincount(_ORDER.ravel(), removed.ravel(), 5).astype(np.int64)
        unique = by_mask[1 << np.arange(5)]
        values = [kept, removed, fails[_ORDER] - removed, unique[_ORDER], cells[:, :5, [1, 3]].sum(2), cells[:, :5, [2, 3]].sum(2), share[_ORDER]]
        for c, v in zip(COUNTS, values, strict=True):
            out[c].append(v.ravel())
    n = len(sums)
    heads = [np.repeat(list(sums), 600), np.tile(np.repeat(ORDERS, 5), n), np.tile(np.arange(1, 6, dtype=np.int32), 120 * n)]
    return pa.record_batch([*map(pa.array, heads), *(pa.array(np.concatenate(out[c]).astype(np.int64)) for c in COUNTS)], ["part", "filter_order", "step", *COUNTS])


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(rows: DataFrame) -> DataFrame:
    """(part, filter_order, step, counts) from rows of (part, bits, label); label: 1 for good plus 2 for toxic."""

    def run(batches):
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            coded = batch.column("part").dictionary_encode()
            names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            bits, label = batch.column("bits").to_numpy(), batch.column("label").to_numpy()
            for least in range(0, len(names), MOST_PARTS):
                some = names[least : least + MOST_PARTS]
                held = np.flatnonzero((code >= least) & (code < least + len(some)))
                part, mask = code[held] - least, bits[held]
                cell = ((part[:, None] * 120 + np.arange(120)) * 6 + TABLE[mask]) * 4 + label[held][:, None]
                by_step = np.bincount(cell.ravel(), minlength=len(some) * 2880).reshape(len(some), -1)
                by_mask = np.bincount(part * 32 + mask, minlength=len(some) * 32).reshape(len(some), -1)
                for i, name in enumerate(some):
                    if name in sums:
                        sums[name] = sums[name][0] + by_step[i], sums[name][1] + by_mask[i]
                    else:
                        sums[name] = by_step[i].copy(), by_mask[i].copy()
                if len(sums) > MOST_PARTS:
                    yield _rows(sums)
                    sums = {}
        if sums:
            yield _rows(sums)

    counts = ", ".join(f"{c} long" for c in COUNTS)
    partial = rows.select("part", "bits", "label").mapInArrow(run, f"part string, filter_order string, step int, {counts}")
    return partial.groupBy("part", "filter_order", "step").agg(*(F.sum(c).alias(c) for c in COUNTS))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, label) of every row of docs, with all five bits."""
    rows = stored(flags(docs), "flags")
    firsts = stored(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"), "firsts")
    one = lambda c, value: F.when(F.max(F.when(F.col(c) == 1, 1)) == 1, value).otherwise(0)
    marks = stored(labels.groupBy("doc_id").agg((one("quality", 1) + one("toxic", 2)).alias("label")), "marks")
    copy = F.when(F.col("doc_id") > F.col("first"), 16).otherwise(0)
    known = rows.join(firsts, "digest", "left").select("doc_id", "part", (F.col("bits") + copy).alias("bits"))
    return known.join(marks, "doc_id", "left").select("part", "bits", F.coalesce("label", F.lit(0)).cast("long").alias("label"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest."""
    return audit(labelled(docs, labels))


ORACLE_SQL = rf"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, min(doc_id) over (partition by t) as first from d),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (select part, (len(ws) < {LEAST_WORDS})::int + 2 * (100 * len(list_distinct(ws)) < {LEAST_DISTINCT} * len(ws))::int + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t))::int
    + 8 * regexp_matches(t, '[{SIGNS}]')::int + 16 * coalesce(w.doc_id > first, false)::int as bits, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic from w left join l using (doc_id)),
g as (select part, bits, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, bits),
f as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
o as (select a.f || b.f || c.f || d.f || e.f as o from f a, f b, f c, f d, f e where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s as (select o, step, substr(o, step, 1) as f, 1 << (ascii(substr(o, step, 1)) - 65) as bit,
    list_sum(list_transform(range(1, step), lambda x: 1 << (ascii(substr(o, x, 1)) - 65)))::int as b from o, (select unnest(range(1, 6)) as step)),
q as (select part, o, step, f, bits, n, good, toxic, bits & bit <> 0 as fails, bits & coalesce(b, 0) <> 0 as gone, bits = bit as alone from g, s),
r as (select part, o as filter_order, step::int as step, f,
    coalesce(sum(n) filter (not fails and not gone), 0)::bigint as kept, coalesce(sum(n) filter (fails and not gone), 0)::bigint as removed, coalesce(sum(n) filter (fails and gone), 0)::bigint as redundant,
    coalesce(sum(n) filter (alone), 0)::bigint as unique_fails, coalesce(sum(good) filter (fails and not gone), 0)::bigint as good_lost, coalesce(sum(toxic) filter (fails and not gone), 0)::bigint as toxic_lost
  from q group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) over (partition by part, f)::bigint as shapley from r
"""
