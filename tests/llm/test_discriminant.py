import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kartoteka.llm import discriminant as q
from kartoteka.llm import tokens
from kartoteka.llm.common import read

DOCS, LABELS = "doc_id long, text string, x double, score string", "doc_id long, quality int, toxic int, good string"
SF = "/root/testdata/sf0.01"


def of(text):
    data, offsets = tokens.buffers(pa.array([text, "pad ding"]))
    return dict(zip(q.NAMES, q.statistics(data, offsets)[0], strict=True))


@pytest.mark.parametrize("text", ["", "one", "Two  words", "a a a b a a a", "ÉÀ été\n#x! 12.\t|", "ab cd ef " * 50, "word " * 3 + "Ä"])
def test_statistics_against_plain_counts(text):
    got, ws = of(text), text.split()
    raw = Counter(text.encode())
    total, k = sum(raw.values()), len(ws)
    triples = [tuple(ws[i : i + 3]) for i in range(k - 2)] or ([tuple(ws)] if ws else [])
    mean = sum(map(len, ws)) / max(k, 1)
    want = {
        "log_chars": math.log1p(len(text)),
        "log_words": math.log1p(k),
        "log_word_length": math.log1p(mean),
        "word_length_deviation": math.log1p(math.sqrt(max(sum(len(w) ** 2 for w in ws) / max(k, 1) - mean**2, 0))),
        "distinct": math.log((len(set(ws)) + q.MORE_WORDS) / (k + q.MORE_WORDS)),
        "twins": math.sqrt(sum(a == b for a, b in zip(ws, ws[1:], strict=False)) / (k + q.MORE_WORDS)),
        "repeated_triples": math.sqrt((len(triples) - len(set(triples))) / (len(triples) + q.MORE_WORDS)),
        "upper": math.sqrt(sum("A" <= c <= "Z" for c in text) / (len(text) + q.MORE_CHARS)),
        "digits": math.sqrt(sum("0" <= c <= "9" for c in text) / (len(text) + q.MORE_CHARS)),
        "symbols": math.sqrt(sum(c in "#$%&*|<>{}[]\\^~_=+@/`" for c in text) / (len(text) + q.MORE_CHARS)),
        "shouts": math.sqrt(sum(c in "!?" for c in text) / (len(text) + q.MORE_CHARS)),
        "stops": math.sqrt(sum(c in ".,;:" for c in text) / (len(text) + q.MORE_CHARS)),
        "beyond_ascii": math.sqrt(sum(ord(c) > 127 for c in text) / (len(text) + q.MORE_CHARS)),
        "entropy": -sum(v / total * math.log2(v / total) for v in raw.values()),
        "newlines": math.sqrt(text.count("\n") / (len(text) + q.MORE_CHARS)),
        "symbol_ends": math.sqrt(sum(w[-1] in "#$%&*|<>{}[]\\^~_=+@/`" for w in ws) / (k + q.MORE_WORDS)),
        "short_words": math.sqrt(sum(len(w) <= 3 for w in ws) / (k + q.MORE_WORDS)),
        "capital_words": math.sqrt(sum("A" <= w[0] <= "Z" for w in ws) / (k + q.MORE_WORDS)),
    }
    assert got == pytest.approx(want, abs=1e-6)


def test_solution_against_the_formula():
    rng = np.random.default_rng(1)
    z = {0: rng.normal(0.5, 1, (60, 3)) @ np.diag([1, 2, 0.5]), 1: rng.normal(-0.2, 1, (200, 3))}
    moments = {g: np.column_stack([np.ones(len(x)), x]).T @ np.column_stack([np.ones(len(x)), x]) for g, x in z.items()}
    parts = q.solve(moments, 0.3, 0.1)
    n = {g: len(x) for g, x in z.items()}
    cov = {g: np.cov(x.T, bias=True) for g, x in z.items()}
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / 260

    def density(g, x):
        c = 0.7 * cov[g] + 0.3 * pooled
        c = 0.9 * c + 0.1 * np.trace(c) / 3 * np.eye(3)
        d = x - z[g].mean(0)
        return math.log(n[g] / 260) - 0.5 * d @ np.linalg.inv(c) @ d - 0.5 * math.log(np.linalg.det(c))

    for x in rng.normal(0, 1, (20, 3)):
        assert q.logit(parts, x[None])[0] == pytest.approx(density(1, x) - density(0, x), abs=1e-8)


def synthetic(n=600, seed=2):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        ws, good = rng.choices(words, k=rng.randint(5, 200)), int(rng.random() < 0.7)
        if not good:
            ws = [w + rng.choice(["###", "$$$", "%%%"]) for w in ws]
        docs.append((i, " ".join(ws) + ".", 0.0, ""))
        labels.append((i, good, 0, ""))
    return docs, labels


def test_held_out_and_odd_rows(spark):
    docs, labels = synthetic()
    odd = [(None, "some words", 0.0, ""), (5000, None, 0.0, ""), (5001, "", 0.0, ""), (5002, "long " * 400_000, 0.0, ""), docs[0], docs[0]]
    got = q.report(spark.createDataFrame(docs + odd, DOCS), spark.createDataFrame(labels + [(0, None, 1, ""), (1, None, None, ""), (None, 1, 0, "")], LABELS)).collect()
    assert len(got) == len(docs) + len(odd) and got[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
    truth = dict(row[:2] for row in labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and all(r.predicted == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= q.THRESHOLD) for r in got)
    assert len({r.score for r in got if r.doc_id == 0}) == 1 and len({r.score for r in got if r.doc_id in (5000, 5001)}) == 1


def test_without_both_classes(spark):
    docs, labels = synthetic(30)
    frame = spark.createDataFrame(docs, DOCS)
    assert {r.score for r in q.report(frame, spark.createDataFrame([(i, 1, 0, "") for i in range(30)], LABELS)).collect()} == {1.0}
    assert {r.score for r in q.report(frame, spark.createDataFrame([], LABELS)).collect()} == {0.0}
    assert q.report(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0


def test_given_documents(spark):
    got = q.report(read(spark, SF, "documents"), read(spark, SF, "labels")).filter("held_out").join(read(spark, SF, "labels"), "doc_id").collect()
    assert len(got) > 50 and sum(r.predicted == r.quality for r in got) >= 0.97 * len(got)
