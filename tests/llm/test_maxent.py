import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from kartoteka.llm import maxent as m
from kartoteka.llm import tokens

SCHEMA = "doc_id long, text string, lang string, n long, tail int"


def words(t):
    return [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if w]


def corpus(n=700, seed=4):
    r = random.Random(seed)
    follow = {f"w{i}": [f"w{r.randrange(40)}" for _ in range(3)] for i in range(40)}
    out = []
    for i in range(n):
        t, w = [], f"w{r.randrange(40)}"
        for _ in range(r.randrange(1, 50)):
            t.append(w if r.random() < 0.9 else f"Rare{r.randrange(3000)}É")
            w = r.choice(follow[w])
        out.append((i, r.choice([" ", "\n", " \t"]).join(t)))
    return out + [(9000, None), (9001, ""), (9002, "  \n "), (9003, "w1 " * 9000), (9003, "w1 " * 9000), (None, "é x y")]


def held(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 7 == 2


def brute(docs):
    c = Counter()
    for i, t in docs:
        if not held(i):
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    return [(len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words(t), None])) for _, t in docs]


def check(spark, docs):
    frame = spark.createDataFrame([(i, t, "x", k, 1) for k, (i, t) in enumerate(docs)], SCHEMA).repartition(3)
    got = m.report(frame).collect()
    want = Counter((i, held(i), *w[:3], round(w[3], 6)) for (i, _), w in zip(docs, brute(docs)))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    return got


def test_base_scores_and_gain_on_held_out_texts(spark):
    got = check(spark, corpus())
    out = [r for r in got if r.held_out and r.n_tokens > 5]
    assert len(out) > 50 and sum(r.score for r in out) > 0.75 * sum(r.base_score for r in out)


def test_words_beyond_the_head(spark, monkeypatch):
    monkeypatch.setattr(m, "HEAD_COUNTS", 24)  # most words come by the join
    check(spark, corpus(200))


def test_scores_do_not_depend_on_partitions(spark):
    frame = spark.createDataFrame([(i, t, "x", 0, 1) for i, t in corpus(200)], SCHEMA)
    one, many = ({(r.doc_id, r.n_tokens): r.score for r in m.report(f).collect()} for f in (frame.coalesce(1), frame.repartition(7)))
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-3 * abs(one[k]) for k in one)


def test_gain_on_the_documents_table(spark):
    got = m.report(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > 0.9 * got["sum(base_score)"]  # both are negative


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(i, "some words", "x", 0, 1) for i in range(100)], SCHEMA)
    only = [r.doc_id for r in frame.collect() if held(r.doc_id)]
    got = m.report(frame.filter(frame.doc_id.isin(only))).collect()
    assert got and all(r.train_tokens == 0 and r.base_score == 0 and r.n_known == 0 for r in got)
    assert m.report(frame.limit(0)).count() == 0


def test_probabilities_add_up_to_one(monkeypatch):
    monkeypatch.setattr(m, "LEAST", 2)
    data, offsets = tokens.buffers(pa.array([t for _, t in corpus(300)], pa.string()))
    tok, heads, ending = m.stream(data, offsets)
    one, at, n = np.unique(tok, return_index=True, return_counts=True)
    end = ending[at]
    model = m.new_model(one, n.astype(float), end, np.bincount(end, n, m.TAIL), np.bincount(end, minlength=m.TAIL), len(tok))
    seen = np.zeros(int(model["size"].sum()) * m.WAYS, np.int64)
    before = m.run(m.weigh(model, seen), tok, heads, ending).mean()
    m.observe(model, tok, heads, ending, seen)
    model = m.weigh(model, seen)
    assert m.run(model, tok, heads, ending).mean() > before
    # The gradient by differences.
    slope = m.slopes(model, tok, heads, ending)
    for i, j in ((0, 0), (0, 3), (1, 1)):
        ends = []
        for step in (-0.01, 0.01):
            moved = model["strength"].copy()
            moved[i, j] += step
            ends.append(m.run(model | {"strength": moved}, tok, heads, ending).sum() * math.log(10))
        assert abs((ends[1] - ends[0]) / 0.02 - slope[i, j]) < 0.02 * abs(slope[i, j]) + 1
    # After one history: every known word and one unseen word of each ending.
    keys = [np.full(len(one), k[500]) for k in m.features(tok, heads, m.anchors(model, m.find(model, tok)[2]))]
    whole = lambda x: np.r_[0, len(x)]
    p = 10 ** m.run(model, one, whole(one), end, keys)
    rare = model["slot"] < 0
    p[rare] *= (n[rare] + 1) / 10 ** model["tail"][end[rare]]
    unseen = np.arange(1, m.TAIL + 1, dtype=np.uint64)
    more = 10 ** m.run(model, unseen, whole(unseen), np.arange(m.TAIL), [np.resize(k, m.TAIL) for k in keys]) / 10 ** model["tail"]
    assert rare.any() and abs(p.sum() + more.sum() - 1) < 1e-3


def test_gradients_move_every_weight(spark, monkeypatch):
    monkeypatch.setattr(m, "LEAST", 2)
    texts = [t for _, t in corpus(700, 4)]
    cut = tokens.buffers(pa.array(texts, pa.string()))
    tok, heads, ending = m.stream(*cut)
    one, at, n = np.unique(tok, return_index=True, return_counts=True)
    end = ending[at]
    make = lambda: m.new_model(one, n.astype(float), end, np.bincount(end, n, m.TAIL), np.bincount(end, minlength=m.TAIL), len(tok))
    where = m.find(make(), np.r_[tok, tok + np.uint64(1)])
    assert (where[1] == np.isin(np.r_[tok, tok + np.uint64(1)], one)).all() and (one[where[0][: len(tok)]] == tok).all()
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    trained = []
    for updates in (0, 1):
        plan, table, strength = m.train(frame, make(), updates)
        trained.append(plan.value | {"weights": table.value.copy(), "strength": strength})
    before, after = trained
    moved = (before["weights"] != after["weights"]).any(axis=1)
    seen = np.zeros(before["weights"].size, np.int64)
    late = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text").filter(f"pmod(xxhash64(text), {m.FOLDS}) = 0").toArrow()
    own = m.stream(*tokens.buffers(late.column("text").combine_chunks()))
    m.observe(before, *own, seen)
    assert moved[seen.reshape(-1, m.WAYS).any(axis=1)].mean() > 0.9  # the rows of the texts that gradients come from
    fresh = m.stream(*tokens.buffers(pa.array([t for _, t in corpus(300, 9)][:300], pa.string())))
    assert m.run(after, *own).mean() > m.run(before, *own).mean() and np.isfinite(m.run(after, *fresh)).all()
    # The gradient by differences.
    slope = np.zeros(before["weights"].shape, np.float32)
    m.lean(before, *own, slope)
    for r in np.argsort(np.abs(slope).max(axis=1))[-3:]:
        c, ends = int(np.abs(slope[r]).argmax()), []
        for step in (-0.05, 0.05):
            other = before["weights"].copy()
            other[r, c] += step
            ends.append(m.run(before | {"weights": other}, *own).sum() * math.log(10))
        assert abs((ends[1] - ends[0]) / 0.1 - slope[r, c]) < 0.05 * abs(slope[r, c]) + 0.05


def test_gradients_go_over_all_training_texts(spark, monkeypatch):
    texts = [(f"word{i % 7} word{i % 5} and w{i}",) for i in range(80)]
    docs = spark.createDataFrame(texts, "text string").selectExpr("row_number() over (order by text) as doc_id", "text")
    seen, summed = [], m._summed

    def noted(d, make):
        seen.append(d.count())
        return summed(d, make)

    monkeypatch.setattr(m, "_summed", noted)
    m.score(docs, docs).count()
    assert len(seen) == 3 and seen[0] + seen[1] == seen[2] == 80
