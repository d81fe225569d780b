import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kartoteka.llm import jaccard as j


def shingles(t):
    w = [x for x in (t or "").split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    links, group = defaultdict(int), {i: i for i, _ in docs}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, (i, x) in enumerate(sets):
        for k, y in sets[:a]:
            if x and y and 5 * len(x & y) >= 4 * len(x | y):
                links[i] += 1
                links[k] += 1
                p, q = sorted((root(i), root(k)))
                group[q] = p
    return {i: (root(i), links[i]) for i, _ in docs}


def corpus(seed=5):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    base = [[word() for _ in range(r.randrange(1, 120))] for _ in range(60)]
    out = [None, "", "  ", "one", "one", "a b c d", "a b c d e"]
    passage = [word() for _ in range(30)]
    for b in base:
        for _ in range(r.randrange(1, 6)):
            t = list(b)
            for _ in range(r.randrange(0, 3)):
                t[r.randrange(len(t))] = word()
            out.append(" ".join(passage[: r.choice([0, 30])] + t))
    near = [word() for _ in range(200)]
    for _ in range(90):
        t = list(near)
        for _ in range(2):
            t[r.randrange(200)] = word()
        out.append(" ".join(t))
    out += [out[-1]] * 20
    return list(enumerate(out))


@pytest.mark.parametrize("most", [j.BROADCAST_BUCKETS, 0])
def test_matches_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(j, "BROADCAST_BUCKETS", most)
    docs = corpus()
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, rid string, run int").repartition(5)
    # Small limits, so that buckets split and blocks meet.
    got = {r.doc_id: (r.class_id, r.n_links) for r in j.classes(frame, small=8, block_bytes=16 * 1500).collect()}
    assert got == brute(docs)
    kept = j.keep_one(frame)
    assert kept.columns == frame.columns
    want = {c for c, _ in brute(docs).values()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_null_and_repeated_ids(spark):
    text = "the same words again and again in a row"
    rows = [(None, text), (None, text), (4, text), (4, text), (4, ""), (None, None), (9, "other words that are not like it at all")]
    got = j.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.class_id, r.n_links) for r in got if r.n_links) == [(4, 3)] * 4 and len(got) == 7
    kept = j.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept) == [(False, 4, ""), (False, 4, text), (False, 9, rows[-1][1]), (True, 0, "")]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert j.report(none).count() == 0 and j.keep_one(none).count() == 0


def test_runs_reach_the_recall():
    assert 1 - (1 - 0.8**3) ** j.runs() >= j.RECALL


def test_tiles_give_the_same():
    r = random.Random(3)
    sets, n = [], 70
    for _ in range(n):
        own = set(range(60)) - {r.randrange(60) for _ in range(r.randrange(9))} | {1000 + r.randrange(40) for _ in range(r.randrange(4))}
        sets.append(np.array(sorted(own), np.uint64))
    rid, copies = np.array(r.sample(range(1000), n)), np.array([r.randrange(1, 4) for _ in range(n)])
    terms = np.array([[r.randrange(3), 5] for _ in range(n)])
    for at in (np.zeros(n, int), np.array([i % 2 for i in range(n)])):
        want = [
            sum(
                int(copies[k]) for k in range(n)
                if k != i and (at.max() == 0 or at[i] != at[k]) and not (terms[i][0] == terms[k][0] != 0) and 5 * len(set(sets[i].tolist()) & set(sets[k].tolist())) >= 4 * len(set(sets[i].tolist()) | set(sets[k].tolist()))
            )
            for i in range(n)
        ]
        whole = j.compare(rid, copies, at, terms, 1, sets)
        assert whole[0].tolist() == want and sum(want)
        for tile in (7, 32):
            got = j.compare(rid, copies, at, terms, 1, sets, tile)
            assert got[0].tolist() == want and got[1].tolist() == whole[1].tolist()


def test_hot_repeated_row(spark):
    text = "one and the same text under one id many times over"
    rows = [(1, text)] * 500 + [(2, text + " again")] + [(3, "a text of its own that nobody has copied so far")]
    got = {(r.doc_id, r.class_id, r.n_links) for r in j.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {(1, 1, 500), (2, 1, 500), (3, 3, 0)} or got == {(1, 1, 499), (2, 2, 0), (3, 3, 0)}
    assert j.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() in (2, 3)


def test_lists_that_grow_are_not_broadcast(spark):
    """Sizes of 60,000 buckets meet their sets by a shuffle: the driver holds a bitmap of fixed size, and no row is lost."""
    few = spark.range(60_000).select((F.col("id") % 13).cast("int").alias("run"), F.col("id").alias("term"), F.lit(2).alias("size"))
    rows = spark.range(400_000).select(F.col("id").alias("rid"), (F.col("id") % 13).cast("int").alias("run"), F.col("id").alias("term"))
    for how, n in (("inner", 60_000), ("left", 400_000)):
        met = j._back(rows, few, how)
        got = met.agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.sum(F.when(F.col("size").isNotNull(), F.col("rid"))).alias("rid")).first()
        assert tuple(got) == (n, 120_000, 60_000 * 59_999 // 2)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "term" in line]
    near = j._maybe_in(rows, few)
    assert near.columns == rows.columns and near.filter("term < 60000").count() == 60_000 and near.count() < 62_000
    assert j._maybe_in(rows, few.limit(0)).count() == 0
