"""Incremental secret scan over a content-addressed blob ledger (DataFrame functions only).

Every version of every path is addressed by the SHA-256 of its content. A ledger holds, for each (blob, rule
version) pair that was ever scanned, what was found. A run takes the distinct blobs, scans only the pairs the
ledger has not seen, and joins findings back to all paths and versions that hold the blob, so a text that was
copied a thousand times, or kept through a thousand versions, is read by the rules once.

Defined cases: null content counts as empty; an empty table gives empty results; repeated rows each get their
findings; ties in position order by kind as listed in RULES; very long texts and many matches in one are walked in
groups; other columns of the input are carried and not looked at, whatever their names: beside an input column `blob`
or `spans` the new one is called `blob_` or `spans_`.
Spans count code points, from 0, with an exclusive end. Texts are matched whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartoteka.llm.common import free_names, stored


@dataclass(frozen=True)
class Rule:
    """kind, version, pattern; `group` of the pattern must have `least` code points or more (0: the match)."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(x) for x in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
#: The three base rules. A run of at least n characters of one class is the maximal run where that has n or more.
BASE = (
    Rule("assign", 1, rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
#: Rules beyond the base: published formats of well-known credentials.
EXTRA = (
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + EXTRA
#: Matches walked at once; unseen blobs (some 200 bytes each) that are broadcast.
GROUP, BROADCAST_BLOBS = 256, 100_000
#: Bits of the bitmap that tells most seen blobs from unseen ones where these are many: 16 MB in all, in rows of MAP_BITS (fixed by Spark's bitmap functions).
FILTER_BITS, MAP_BITS = 1 << 27, 1 << 15
LEDGER_SCHEMA = "blob string, rule string, spans array<struct<start:int,kind:string,end:int>>"


def content_address(versions: DataFrame, content: str = "text") -> DataFrame:
    """(_row: all columns as _c0, _c1 ..., text, blob: the SHA-256 of the content)."""
    names = [f"_c{i}" for i in range(len(versions.columns))]
    text = F.coalesce(F.col(names[versions.columns.index(content)]).cast("string"), F.lit(""))
    return versions.toDF(*names).select(F.struct(*names).alias("_row"), text.alias("text"), F.sha2(text, 256).alias("blob"))


def _found(text: Column, rule: Rule) -> Column:
    """Spans of one rule: pieces between matches and the matches themselves alternate, so lengths give positions."""
    pattern = F.lit(rule.pattern)
    full = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    return F.when(
        F.rlike(text, pattern),
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("before"), full.alias("full"), part.alias("part")),
    )


def _spans(zipped: str, rule: Rule) -> Column:
    """From alternating pieces to (start, kind, end), failing matches dropped. The last piece has no match after it.

    Matches are walked in groups of GROUP, then the groups: appending to one array for each of m matches would take m * m steps.
    """
    kind = "array<struct<start:int,kind:string,end:int>>"
    walk = f"""aggregate(slice({zipped}, g * {GROUP} + 1, least({GROUP}, size({zipped}) - 1 - g * {GROUP})), struct(0 as pos, array() :: {kind} as out),
        (a, x) -> struct(a.pos + length(x.before) + length(x.full) as pos,
          if(length(x.part) >= {rule.least},
             array_append(a.out, struct(a.pos + length(x.before) as start, '{rule.kind}' as kind, a.pos + length(x.before) + length(x.full) as `end`)),
             a.out) as out))"""
    groups = f"transform(sequence(0, (size({zipped}) - 2) div {GROUP}), g -> {walk})"
    return F.expr(f"""if(size({zipped}) < 2, array() :: {kind}, aggregate({groups}, struct(0 as pos, array() :: array<{kind}> as out),
        (a, x) -> struct(a.pos + x.pos as pos, array_append(a.out, transform(x.out, s -> struct(s.start + a.pos as start, s.kind as kind, s.end + a.pos as `end`))) as out),
        a -> flatten(a.out)))""")


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan (blob, text, todo: rule keys) with the rules asked for; one ledger row for each pair."""
    df = blobs
    for n, r in enumerate(rules):
        df = df.withColumn(f"_z{n}", F.when(F.array_contains("todo", r.key), _found(F.col("text"), r)))
    df = df.drop("text")
    for n, r in enumerate(rules):
        df = df.withColumn(f"_s{n}", F.when(F.col(f"_z{n}").isNotNull(), _spans(f"_z{n}", r)).otherwise(F.expr("array()"))).drop(f"_z{n}")
    pairs = F.array(*[F.struct(F.lit(r.key).alias("rule"), F.col(f"_s{n}").alias("spans")) for n, r in enumerate(rules)])
    return df.select("blob", F.explode(F.filter(pairs, lambda p: F.array_contains("todo", p["rule"]))).alias("p")).select("blob", "p.rule", "p.spans")


def unseen(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, text, todo) of blobs with at least one pair that the ledger lacks; each text once.

    A short list of unseen blobs (the usual run) is broadcast, so seen texts never leave their scan. Beyond BROADCAST_BLOBS
    a bitmap of the unseen ones' hashes is, of FILTER_BITS whatever their number; texts that may be unseen are dealt by
    blob, one for each blob and partition, and meet the list there.
    """
    keys = F.array(*[F.lit(r.key) for r in rules])
    texts = versions.select("blob", "text")
    if ledger is None:
        return texts.groupBy("blob").agg(F.first("text").alias("text")).withColumn("todo", keys)
    done = ledger.groupBy("blob").agg(F.collect_set("rule").alias("done"))
    todo = stored(
        versions.select("blob").distinct().join(done, "blob", "left")
        .withColumn("todo", F.array_except(keys, F.coalesce("done", F.expr("array()"))))
        .filter(F.size("todo") > 0).select("blob", "todo"), "unseen",
    )
    if todo.count() <= BROADCAST_BLOBS:
        return texts.join(F.broadcast(todo), "blob").groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    return _maybe_in(texts, todo).groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")


def _maybe_in(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """The texts whose blob is listed, and a few others: a bitmap over hashes, 4 KB a row, is broadcast."""
    slot = F.pmod(F.xxhash64("blob"), F.lit(FILTER_BITS))
    at = {"_part": F.floor(slot / MAP_BITS), "_bit": F.pmod(slot, F.lit(MAP_BITS))}
    maps = listed.withColumns(at).groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    byte = F.conv(F.hex(F.expr("substring(_map, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    near = texts.withColumns(at).join(F.broadcast(maps), "_part")
    return near.filter(byte.bitwiseAND(F.pow(F.lit(2), F.pmod("_bit", F.lit(8))).cast("int")) != 0).select(*texts.columns)


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(rows of `versions` with `blob` and all `spans`, the ledger's new rows).

    versions has `text` and any path and version columns. The new rows are written to the shared folder, so they
    are computed once; append them to the ledger for the next run.
    """
    addressed = content_address(versions)
    fresh = stored(scan(unseen(addressed, ledger, rules), rules), "ledger")
    known = fresh if ledger is None else ledger.select(*fresh.columns).unionByName(fresh)
    # Most blobs hold no secret: only findings travel to the join, and paths of a hot blob are split by AQE.
    found = (
        known.filter(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0))
        .groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )
    joined = addressed.select("_row", "blob").join(found, "blob", "left")
    return joined.select("_row.*", "blob", "spans").toDF(*versions.columns, *free_names(["blob", "spans"], versions.columns)), fresh


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def scan_history(commits: list[DataFrame], rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(the last commit's rows with `blob` and `spans`, the whole ledger): each commit is scanned with the ledger that the ones before it left."""
    ledger, found = None, None
    for versions in commits:
        found, fresh = scan_versions(versions, ledger, rules)
        ledger = fresh if ledger is None else ledger.unionByName(fresh)
    return found, ledger


def report(docs: DataFrame) -> DataFrame:
    """The digest: one row per document. The table is read as a history of two commits: the first holds the ids whose hash is even, the second all."""
    own = docs.select("doc_id", "text")
    found, _ = scan_history([own.filter(F.coalesce(F.xxhash64("doc_id") % 2, F.lit(0)) == 0), own])
    order = F.create_map(*[x for n, r in enumerate(RULES) for x in (F.lit(r.kind), F.lit(n))])
    keyed = F.transform(F.coalesce("spans", F.expr("array()")), lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("n"), s["kind"].alias("kind"), s["end"].alias("end")))
    base = F.filter("_spans", lambda s: s["n"] < len(BASE))
    counts = [F.size(F.filter("_spans", _is(r.kind))).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return found.withColumn("_spans", F.array_sort(keyed)).select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans")
    )
