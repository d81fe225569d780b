import itertools
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa

from kartoteka.llm import interactions as x
from kartoteka.llm import tokens

DOCS, LABELS = "doc_id long, text string, source string, step int, part string", "doc_id long, quality int, toxic int, bits int"


def fails(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(ws) < 200) + 2 * (100 * len(set(ws)) < 50 * len(ws)) + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text)) + 8 * any(c in "#$%&*|" for c in text)


def brute(docs, labels):
    rows = []
    for d, t, s, *_ in docs:
        t = t or ""
        copy = d is not None and any(o is not None and o < d and (u or "") == t for o, u, *_ in docs)
        good, toxic = (any(r[0] == d is not None and r[i] == 1 for r in labels) for i in (1, 2))
        rows.append((s or "", {f for i, f in enumerate("ABCD") if fails(t) >> i & 1} | ({"E"} if copy else set()), good, toxic))
    out, taken = {}, defaultdict(int)
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                taken[part, f] += len(gone)
                redundant = sum(f in r[1] for r in own) - len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return sorted((*k, *v, taken[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def found(spark, docs, labels):
    rows = x.report(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    return sorted((r.part, r.filter_order, r.step, *(r[c] for c in x.COUNTS)) for r in rows)


def corpus():
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", "short one", long, long.upper(), "a b " * 150, f"{long} #", "A" * 50, "x y é 中 | z", "$ " * 300, long + " end", "ab\n" * 60000, "É" * 100 + "AB", "É" * 100 + "ABC"]
    docs = [(i, t, f"s{i % 3}", 1, "p") for i, t in enumerate(texts)]
    docs += [(100 + i, long, "s0", 0, "") for i in range(60)] + [(3, long, "s1", 0, ""), (3, long, "s1", 0, ""), (None, long, "s0", 0, ""), (2, long, "s2", 0, ""), (70, "x", None, 0, ""), (71, "y", "", 0, "")]
    labels = [(i, i % 2, i % 3 == 0, 0) for i in range(0, 160, 3)] + [(3, 1, 0, 0), (3, 0, 1, 0), (None, 1, 1, 0), (5, None, None, 0)]
    return docs, [(a, b, c if c is None else int(c), d) for a, b, c, d in labels]


def test_table():
    for mask, (j, order) in itertools.product(range(32), enumerate(x.ORDERS)):
        first = [k for k, f in enumerate(order) if mask >> "ABCDE".index(f) & 1]
        assert x.TABLE[mask, j] == (first[0] if first else 5)
    assert x.TABLE.shape == (32, 120)


def test_failures_of_texts():
    texts = [t or "" for _, t, *_ in corpus()[0]]
    data, offsets = tokens.buffers(pa.array(texts))
    assert x.failures(data, offsets).tolist() == [fails(t) for t in texts]
    assert x.failures(np.zeros(0, np.uint8), np.zeros(2, np.int64)).tolist() == [1]


def test_against_brute_force(spark, monkeypatch):
    docs, labels = corpus()
    want = brute(docs, labels)
    assert found(spark, docs, labels) == want
    monkeypatch.setattr(x, "MOST_PARTS", 1)  # tasks send what they hold more often
    assert found(spark, docs, labels) == want


def test_empty_tables(spark):
    docs, _ = corpus()
    assert found(spark, [], []) == []
    assert found(spark, docs, []) == brute(docs, [])
