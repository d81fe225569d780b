import math
import random
import re
from collections import Counter

import pytest

from kartoteka.llm import ranking as r

DOCS, ITEMS = "doc_id long, text string, rank int, item string", "item_id string, text string, score long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items):
    bags = [(d, Counter(terms(t)), len(terms(t))) for d, t, *_ in docs if terms(t)]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    wanted = {}
    for i, t, *_ in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in wanted.items():
        scores = []
        for d, bag, n in bags:
            m = 10 + (90 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in ts if bag[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[: r.K])]
    return sorted(out, key=repr)


def found(spark, docs, items):
    rows = r.report(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    return sorted(((x.item_id, x["rank"], x.doc_id, x.score) for x in rows), key=repr)


def corpus(n=300, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ärger", "été", "ÉTÉ", "2nd", "a_b", "x-y"]
    text = lambda k: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=k))
    docs = [(i, text(rng.randint(1, 60)), 0, "") for i in range(n)]
    docs += [(7, docs[3][1], 0, ""), (3, docs[3][1], 0, ""), (None, docs[3][1], 0, ""), (900, None, 0, ""), (901, "", 1, "x"), (902, "--- !", 0, "")]
    docs += [(1000 + i, docs[5][1], 0, "") for i in range(40)] + [(2000, text(20000), 0, ""), (2001, "w0 W0 w0", 0, "")]
    items = [("a", text(12), 0), ("b", text(3), 0), ("c", docs[5][1], 0), ("d", docs[3][1], 0), ("e", "nowhere", 0), ("f", None, 0), ("g", "", 0), (None, "w1 w2", 0), ("h", "w5", 0), ("h", "été w5", 0)]
    return docs, items


@pytest.mark.parametrize("bounds", [(r.MOST_KEYS, r.MOST_LISTS), (0, 0)])
def test_against_brute_force(spark, monkeypatch, bounds):
    monkeypatch.setattr(r, "MOST_KEYS", bounds[0])
    monkeypatch.setattr(r, "MOST_LISTS", bounds[1])
    docs, items = corpus()
    assert found(spark, docs, items) == brute(docs, items)


def test_few_and_none(spark):
    docs, items = corpus(12)
    assert found(spark, docs[:3], items) == brute(docs[:3], items)
    assert found(spark, [], items) == [] == found(spark, docs, [])


def test_postings_are_cut_by_document_and_scanned_in_place(spark):
    docs, _ = corpus()
    index = r.Postings(spark.createDataFrame(docs, DOCS))
    plan = index.table.groupBy("key", "row").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert index.table.select("part").distinct().count() <= r.PARTS
    index.close()
