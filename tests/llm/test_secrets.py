import hashlib
import re

import pytest

from kartoteka.llm import secrets

SCHEMA = "doc_id long, text string, blob int"
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))
    return *[sum(x[2] == k for x in found) for k in ("assign", "access", "hex")], hashlib.sha256(joined.encode()).hexdigest()


TEXTS = [
    None,
    "",
    "plain words only",
    'é token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" then PASSWORD: hunter22',
    "secret: token: abcdefgh and secret=short and api_key==abcde apikey:'x/y+z=.-_'",
    "AKIA" + "A1" * 8 + " AKIAAKIA" + "B" * 12 + " AKIA1",
    "😀 passwd=😀secret=abcdef0123456789abcdef0123456789 " * 3,
    "toKen=abcdef" * 2000,
    "0123456789abcdef01234567",
    "0123456789abcdef01234567",
    "ſecret = longvalue toKen=another1",
    "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM and ghp_" + "a1" * 20,
]


def test_matches_brute_force(spark):
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: r for r in secrets.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex, got[i].base_sha256) == brute(text), text
    assert got[11].spans.startswith("jwt:0:") and "forge:" in got[11].spans
    assert got[0].spans == "" and got[8].spans == got[9].spans == "hex:0:24"


def test_only_unseen_pairs_are_scanned(spark):
    first = spark.createDataFrame([(1, "token=abcdefg", 0), (2, "no", 0)], SCHEMA)
    _, ledger = secrets.scan_versions(first, None, secrets.BASE)
    assert ledger.count() == 6
    second = spark.createDataFrame([(1, "token=abcdefg", 0), (3, "passwd=0123456", 0), (4, "token=abcdefg", 1)], SCHEMA)
    found, fresh = secrets.scan_versions(second, ledger, secrets.BASE)
    assert found.columns == ["doc_id", "text", "blob", "blob_", "spans"]
    assert {r.blob for r in fresh.collect()} == {r.blob_ for r in found.filter("doc_id = 3").collect()}
    assert all(len(r.spans) == 1 for r in found.collect())
    _, more = secrets.scan_versions(second, ledger.unionByName(fresh))
    assert {r.rule for r in more.collect()} == {r.key for r in secrets.EXTRA}


def test_history_scans_each_pair_once(spark, monkeypatch):
    rows = [(i, f"token=abcdef{i % 40}", 0) for i in range(200)] + [(None, None, 0), (None, "passwd=0123456", 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for most in (secrets.BROADCAST_BLOBS, 0):  # either way to the unseen texts
        monkeypatch.setattr(secrets, "BROADCAST_BLOBS", most)
        found, ledger = secrets.scan_history([frame.filter("doc_id < 20"), frame.filter("doc_id < 30"), frame])
        pairs = [(r.blob, r.rule) for r in ledger.collect()]
        assert len(pairs) == len(set(pairs)) == 42 * len(secrets.RULES)
        assert [len(r.spans) for r in found.filter("text is not null").collect()] == [1] * 201


def test_empty_table(spark):
    assert secrets.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bitmap_keeps_all_listed(spark):
    from pyspark.sql import functions as F

    texts = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("blob"), F.col("id").cast("string").alias("text"))
    listed = texts.filter("cast(text as int) % 3 = 0").select("blob")
    for n, bits in ((1334, secrets.FILTER_BITS), (4000, secrets.MAP_BITS)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(secrets, "FILTER_BITS", bits)
            near = secrets._maybe_in(texts, listed)
            assert near.columns == texts.columns and near.join(listed, "blob", "left_semi").count() == 1334 <= near.count() <= n
    assert secrets._maybe_in(texts, listed.limit(0)).count() == 0


def test_many_unseen_blobs_give_the_same(spark, monkeypatch):
    rows = [(i, f"password = abcdef{i % 40}" if i % 3 else None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = sorted(map(tuple, secrets.report(docs).collect()))
    monkeypatch.setattr(secrets, "BROADCAST_BLOBS", 0)
    assert sorted(map(tuple, secrets.report(docs).collect())) == few
