import random
from functools import cache

import numpy as np
import pyarrow as pa

from kartoteka.llm import tokens
from kartoteka.llm import toxicity as x

SCHEMA = "doc_id long, text string, lang string, score int"


def letters(t):
    data, offsets = tokens.buffers(pa.array([t]))
    flat, heads, _ = x.units(data, offsets)
    return [bytes(flat[a:b].tolist()) for a, b in zip(heads[:-1], heads[1:])]


def word(t):
    return bytes([x.START, *[ord(c) - 97 for c in t]])


def test_units():
    assert letters("ab  C.d, i d i o t x1 zz") == [word(w) for w in ("ab", "cd", "idiot", "xi", "zz")]
    assert letters("é")[0] == letters("É")[0] and len(letters("é")[0]) == 2
    assert [len(u) for u in letters("a" * 50)] == [25, 25, 25, 15]
    assert letters("") == letters("123!! 12")[2:] == []


def test_kernel_against_recursion():
    def features(u):
        @cache
        def grow(at, left):
            if not left:
                return {(): 1.0}
            out = {}
            for g in range(1, x.GAP + 1):
                if at + g < len(u):
                    for k, w in grow(at + g, left - 1).items():
                        out[(u[at + g], *k)] = out.get((u[at + g], *k), 0) + w * x.LAMBDA**g
            return out

        total = {}
        for i in range(len(u)):
            for k, w in grow(i, 2).items():
                total[(u[i], *k)] = total.get((u[i], *k), 0) + w
        return total

    words = [word(w) for w in ("idiot", "idxiot", "banana", "ab", "iidiioott")]
    got = x.kernel(words, words)
    norm = x._norm(np.array([len(w) for w in words]))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            fa, fb = features(a), features(b)
            assert abs(got[i, j] - sum(w * fb.get(k, 0) for k, w in fa.items()) / norm[i] / norm[j]) < 1e-5
    assert got[0, 1] > 0.5 * got[0, 0] > got[0, 2]


def data(n=1200, seed=3):
    r = random.Random(seed)
    plain = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9))) for _ in range(900)]
    bad = ["idiot", "moron", "scumbag", "pathetic"]
    out = []
    for i in range(n):
        ws = [r.choice(plain) for _ in range(r.randrange(3, 60))]
        toxic = int(r.random() < 0.2)
        if toxic:
            for _ in range(r.randrange(1, 4)):
                w = r.choice(bad)
                at = r.randrange(1, len(w))
                w = r.choice([w, w, w, w[:at] + r.choice("xqz") + w[at:], ".".join(w), " ".join(w)])
                ws.insert(r.randrange(len(ws) + 1), w)
        out.append((i, " ".join(ws), toxic))
    return out


def test_learns_from_labels(spark):
    rows = data()
    docs = [(i, t, "en", 1) for i, t, _ in rows] + [(5000, None, None, 1), (5001, "", None, 1), (5002, "fine " * 9000 + "id.iot", None, 1), (None, "same", None, 1), (5001, "", None, 1)]
    labels = [(i, 1, y) for i, _, y in rows] + [(0, 0, None), (7000, 0, 1)]
    got = x.report(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) and all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3) for g in got)
    by = {g.doc_id: g for g in got}
    held = [(by[i].predicted, y) for i, _, y in rows if by[i].held_out]
    assert len(held) > 200
    right = sum(p == y == 1 for p, y in held)
    assert right > 0.85 * sum(y for _, y in held) and right > 0.85 * sum(p for p, _ in held)


def test_labels_of_one_kind_or_none(spark):
    docs = spark.createDataFrame([(i, "text", "en", 1) for i in range(20)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {g.score for g in x.report(docs, labels).collect()} == {0.0}
    assert {g.score for g in x.report(docs, labels.limit(0)).collect()} == {0.0}
    assert x.report(docs.limit(0), labels).count() == 0


def test_learns_from_the_whole_sample(spark):
    docs = spark.range(6200).selectExpr("id as doc_id", "concat('text ', id) as text")
    labels = spark.range(6200).selectExpr("id as doc_id", "cast(id < 1600 as int) as toxic")
    found = x.sample(docs, labels)
    assert [sum(y == k for _, y in found) for k in (1, 0)] == [1500, 4500]


def test_letters_of_other_scripts():
    alphabets = ["абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψως", "ąćęłńśźż", "ğış", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "傻瓜", "𐐨𐐩"]
    for a in alphabets:
        (unit,) = letters(a[: x.LONG])
        assert len(set(unit)) == len(unit)
        codes = [letters(f"{c}b")[0][1] for c in a]
        assert len(set(codes)) == len(a) and min(codes) >= x.OTHER and max(codes) < x.LETTERS
    assert letters("ДУРАК") == letters("дурак") != letters("книга") and letters("ŁĄ") == letters("łą")
    assert letters("aд") != letters("дa") and letters("дa, é") == letters("Дa é")
