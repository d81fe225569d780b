import random
import re

import numpy as np

from kartoteka.llm import decontaminate as d
from kartoteka.llm import tokens

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return WORDS.findall("".join(c.lower() if c.isascii() else c for c in t or ""))


def brute(docs, bench):
    wins = {}
    for item, t in bench:
        w = lower(t)
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + m]), set()).add(item)
    out = {}
    for doc, t in docs:
        w, hit, items = lower(t), set(), set()
        for i in range(len(w)):
            for m in {len(k) for k in wins}:
                if i + m <= len(w) and (own := wins.get(tuple(w[i : i + m]))):
                    hit |= set(range(i, i + m))
                    items |= own
        out[doc] = (len(w), len(hit), len(items), bool(hit))
    return out


def texts(seed, n, vocabulary, length):
    r = random.Random(seed)
    return [" ".join(r.choice(vocabulary) for _ in range(r.randrange(length))) for _ in range(n)]


VOCAB = ["a", "B", "c", "dé", "É", "f1", "x-y"]
BENCH = [(i, t) for i, t in enumerate([*texts(1, 12, VOCAB[:3], 14), None, "", "É f1", *texts(2, 6, VOCAB, 30)])]
DOCS = [(i, t) for i, t in enumerate([None, "", "a", *texts(3, 60, VOCAB[:3], 80), *texts(4, 40, VOCAB, 60), "zz " * 3000 + BENCH[20][1], "A\x00b"])]


def test_report_and_removal(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in DOCS], "doc_id long, text string, _text string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in BENCH], "item_id long, text string, lang int")
    want = brute(DOCS, BENCH)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in d.report(docs, bench).collect()}
    assert got == want
    kept = d.remove(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, v in want.items() if not v[3]}


def longest(words, bench):
    best, at = 0, -1
    for _, t in bench:
        w = lower(t)
        m = min(10, len(w))
        for i in range(len(words)):
            for j in range(len(w) - m + 1 if w else 0):
                n = 0
                while i + n < len(words) and j + n < len(w) and words[i + n] == w[j + n]:
                    n += 1
                if n >= m and (n, -i) > (best, -at):
                    best, at = n, i
    return best, at


def test_longest_match_of_each_document(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    for items in (BENCH, [b for b in BENCH if len(lower(b[1])) > 4]):
        got = {r.doc_id: (r.longest, r.longest_at) for r in d.report(docs, bench.filter(bench.item_id.isin([i for i, _ in items]))).collect()}
        assert {i: x for i, x in got.items() if i != 103} == {i: longest(lower(t), items) for i, t in DOCS if i != 103}


def test_sql(spark, tmp_path):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parents[1]))
    from oracle import connect, differences

    spark.createDataFrame(DOCS, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([b for b in BENCH if b[1]], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    run = lambda s, f: d.report(s.read.parquet(f"{f}/documents.parquet"), s.read.parquet(f"{f}/benchmark.parquet"))
    assert not differences(spark, connect(tmp_path), tmp_path, run, d.ORACLE_SQL)


def test_clashing_columns_stay(spark):
    frame = spark.createDataFrame([(i, t, 1, "h", None) for i, t in DOCS], "doc_id long, text string, n int, hits string, items string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    kept = d.remove(frame, bench)
    assert kept.columns == frame.columns and {(r.n, r.hits, r["items"]) for r in kept.collect()} == {(1, "h", None)}


def test_blocks_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    whole = sorted(map(tuple, d.report(docs, bench).collect()))
    monkeypatch.setattr(d, "BLOCK_BYTES", 150)
    assert sorted(map(tuple, d.report(docs, bench).collect())) == whole


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert d.report(docs.limit(0), bench).count() == 0
    assert d.remove(docs, bench.limit(0)).count() == len(DOCS)


def test_longest_matches(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = {(r.item_id, r.item_word): (r.length, r.doc_id, r.doc_word) for r in d.longest_matches(docs, bench).collect()}
    known = {i: lower(t) for i, t in DOCS}
    for item, t in BENCH:
        w = lower(t)
        for i in range(len(w)):
            best = 0
            for o in known.values():
                for j in range(len(o)):
                    k = 0
                    while i + k < len(w) and j + k < len(o) and w[i + k] == o[j + k]:
                        k += 1
                    best = max(best, k)
            if best >= 2:
                n, doc, at = got[item, i]
                assert n == best and known[doc][at : at + n] == w[i : i + n]
            else:
                assert (item, i) not in got


def test_suffix_array():
    r = np.random.default_rng(0)
    rank = r.integers(0, 3, 300)
    order = d.suffix_array(rank, 300)
    key = rank.copy()
    key[rank == 0] = -np.arange(1, (rank == 0).sum() + 1)
    assert order.tolist() == sorted(np.flatnonzero(rank), key=lambda i: key[i:].tolist())


def test_word_hashes():
    data = "ab  cd ab é".encode() + b"ab"
    raw = np.frombuffer(data, np.uint8)
    starts, ends, first = tokens.spans(raw, np.array([0, len(data) - 2, len(data)]), tokens.NOT_SPACE)
    assert [data[s:e].decode() for s, e in zip(starts, ends)] == ["ab", "cd", "ab", "é", "ab"] and first.tolist() == [0, 4, 5]
    h = tokens.hashes(raw, starts, ends)
    assert h[0] == h[2] == h[4] == tokens.hash_word(b"ab") and len(set(h.tolist())) == 3
