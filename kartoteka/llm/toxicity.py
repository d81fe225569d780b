"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

Texts are sentences of units: words reduced to their letters (so `i.d.i.o.t` is one), runs of one-letter words joined
(`i d i o t`), digits read as the letters they stand for, long ones seen through overlapping windows. The kernel of
two units sums over their common subsequences of three letters (the start of a unit counts as one), each with gaps of
up to GAP - 1 inserted letters and weight LAMBDA to the power of its span, normalized by length. Landmarks are the
units that tell labelled toxic texts from others, and the most common ones of clean texts; a squared-hinge machine is
solved in their whitened kernel space. A labelled text enters by its telling units (multiple instances). A linear machine
over subsequences is a table of weights by letter triple, so scoring adds up table entries for every letter of every
text. The units of a text are pooled (the three highest values, hits, length) by a logistic model.

Learned on a bounded sample of labelled rows: at most TRAIN_TOXIC and TRAIN_CLEAN documents, those whose hashed ids
come first; negatives are mined from all their clean units. Scoring reads all texts whole.

Defined cases: null and empty texts get the score of a text without units; without labels of both kinds the score
is the share of toxic labels (0 if there are none); several labels of one id count by the highest, null ones not at
all; repeated rows get equal scores; ties among units go to the one that sorts first; very long texts are read whole, in
slices; an empty table gives an empty result; no other column is looked at, whatever its name.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kartoteka.llm import tokens
from kartoteka.llm.common import bucket

TRAIN_TOXIC, TRAIN_CLEAN = 1500, 4500
LANDMARKS, CLEAN_LANDMARKS, NEGATIVES = 160, 60, 20000
#: Rounds in which the hardest clean units join the negatives.
MINING = 3
GAP, LAMBDA, SHORT, LONG = 3, 0.6, 6, 24
THRESHOLD = 0.3
#: Letters: a-z, the start of a unit, the Latin-1 letters above ASCII, any other by its code point modulo HASHED: a prime, so
#: that the letters of one alphabet keep apart.
START, OTHER, HASHED = 26, 59, 67
LETTERS = OTHER + HASHED
_DROP = 255
# Digits and signs read as letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}
_PAIRS = [(a, b) for a in range(1, GAP + 1) for b in range(1, GAP + 1)]

_CODE = np.full(256, _DROP, np.uint8)
for _i in range(26):
    _CODE[97 + _i] = _CODE[65 + _i] = _i
for _c, _l in LEET.items():
    _CODE[ord(_c)] = ord(_l) - 97
_LOWER = np.array([ord(c) if len(c := chr(i).lower()) == 1 else i for i in range(1 << 16)], np.int32)


def letters(data: np.ndarray) -> np.ndarray:
    """A code per byte; _DROP for what is no letter. A Latin-1 letter sits on its second byte, others on their first."""
    code = _CODE[data]
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    latin = after & (data >= 0x80)
    code[latin] = 27 + (data[latin] & 0x1F)  # upper and lower case alike
    at = np.flatnonzero(data >= 0xC4)
    if len(at):
        lead, last = data[at], len(data) - 1
        size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        point = (lead & (0xFF >> (size + 1)).astype(np.uint8)).astype(np.int32)
        for k in range(1, 4):
            more = size > k
            point[more] = point[more] << 6 | (data[np.minimum(at[more] + k, last)] & 0x3F)
        basic = point < len(_LOWER)
        point[basic] = _LOWER[point[basic]]
        code[at] = OTHER + point % HASHED
    return code


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters of all units, each with START before it; first letter of each unit and the total; text of each unit)."""
    starts, ends, first = tokens.spans(data, offsets, tokens.NOT_SPACE)
    code = letters(data)
    at = np.flatnonzero(code != _DROP)
    edge = np.searchsorted(at, starts)
    size = np.searchsorted(at, ends) - edge
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    full = np.flatnonzero(size)
    edge, size, text = edge[full], size[full], text[full]
    if not len(full):
        return np.zeros(0, np.int32), np.zeros(1, np.int64), text
    fresh = np.ones(len(full), bool)
    fresh[1:] = ~((size[1:] == 1) & (size[:-1] == 1) & (text[1:] == text[:-1]))
    begin = np.flatnonzero(fresh)
    edge, text, size = edge[begin], text[begin], np.add.reduceat(size, begin)
    # Long units through windows of LONG letters, half a window apart.
    n = np.maximum(1, -(-(size - LONG // 2) // (LONG // 2)))
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    edge, whole, text = np.repeat(edge, n), np.repeat(size, n), np.repeat(text, n)
    begin = nth * (LONG // 2)
    size = np.minimum(LONG, whole - begin)
    edge = edge + begin
    heads = np.r_[0, np.cumsum(size + 1)]
    out = np.full(heads[-1], START, np.int32)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(heads[:-1], size) + 1 + place] = code[at[np.repeat(edge, size) + place]]
    return out, heads, text


def _triples(flat: np.ndarray, heads: np.ndarray):
    """For each pair of gaps: (places, letter triples, weight) of the subsequences inside units."""
    end = np.repeat(heads[1:], np.diff(heads))
    for a, b in _PAIRS:
        at = np.flatnonzero(np.arange(len(flat)) + a + b < end)
        yield at, (flat[at] * LETTERS + flat[at + a]) * LETTERS + flat[at + a + b], LAMBDA ** (a + b)


def _norm(size: np.ndarray) -> np.ndarray:
    """The length of a unit's feature vector if no triple came twice; very short units count as SHORT letters long."""
    total, size = np.zeros(len(size)), np.maximum(size, SHORT)
    for a, b in _PAIRS:
        total += np.maximum(size - a - b, 0) * LAMBDA ** (2 * (a + b))
    return np.sqrt(np.maximum(total, 1e-9))


def decide(flat: np.ndarray, heads: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """The machine's value for each unit."""
    if len(heads) < 2:
        return np.zeros(0)
    total = np.zeros(len(flat), np.float32)
    for at, triple, weight in _triples(flat, heads):
        total[at] += table[triple] * np.float32(weight)
    return np.add.reduceat(total, heads[:-1]) / _norm(np.diff(heads)) + bias


def _pack(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(words), np.uint8).astype(np.int32), np.r_[0, np.cumsum([len(w) for w in words], dtype=np.int64)]


def kernel(words: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """Subsequence kernel between units (a byte for each letter, START first) and landmarks."""
    l_flat, l_heads = _pack(landmarks)
    owner = np.repeat(np.arange(len(landmarks)), np.diff(l_heads))
    parts = [(owner[at], triple, weight) for at, triple, weight in _triples(l_flat, l_heads)]
    known = np.unique(np.concatenate([t for _, t, _ in parts]))
    index = np.full(LETTERS**3, len(known), np.int64)
    index[known] = np.arange(len(known))
    phi = np.zeros((len(known) + 1, len(landmarks)), np.float32)
    for who, triple, weight in parts:
        np.add.at(phi, (index[triple], who), weight)
    phi[-1] = 0
    phi /= _norm(np.diff(l_heads))[None, :]
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for a in range(0, len(words), 2000):
        flat, heads = _pack(words[a : a + 2000])
        total = np.zeros((len(flat), len(landmarks)), np.float32)
        for at, triple, weight in _triples(flat, heads):
            total[at] += phi[index[triple]] * np.float32(weight)
        out[a : a + 2000] = np.add.reduceat(total, heads[:-1], axis=0) / _norm(np.diff(heads))[:, None]
    return out


def _varied(word: bytes, r: np.random.Generator) -> bytes:
    """A unit with a letter put in or doubled."""
    at = int(r.integers(2, len(word) + 1))
    more = int(r.integers(0, 26)) if r.random() < 0.5 else word[at - 1]
    return word[:at] + bytes([more]) + word[at:]


def count_units(texts: list[str | None], y: np.ndarray) -> tuple[Counter, Counter]:
    """In how many toxic and how many clean texts each unit is."""
    bad, good = Counter(), Counter()
    for row, _, data, offsets in tokens.slices(pa.array(texts, pa.string()), 1 << 20):
        flat, heads, text = units(data, offsets)
        raw = flat.astype(np.uint8)
        h = tokens.hashes(raw, heads[:-1], heads[1:])
        order = np.lexsort((text, h))
        once = order[np.r_[True, (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])]] if len(h) else order
        _, at, which = np.unique(h[once], return_index=True, return_inverse=True)
        toxic = np.bincount(which, y[row + text[once]], len(at))
        for u, n, all_ in zip(once[at], toxic, np.bincount(which, minlength=len(at)), strict=True):
            w = raw[heads[u] : heads[u + 1]].tobytes()
            if n:
                bad[w] += int(n)
            if all_ > n:
                good[w] += int(all_ - n)
    return bad, good


def _hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (last: bias) of a squared-hinge machine in the primal, by Newton steps on the active set."""
    x = np.c_[z, np.ones(len(z))].astype(np.float32)
    ridge = np.eye(x.shape[1]) / c
    ridge[-1, -1] = 1e-6
    w, active = np.zeros(x.shape[1]), np.ones(len(y), bool)
    for turn in range(rounds):
        own = x[active]
        a = own * weight[active, None].astype(np.float32)
        fresh = np.linalg.solve(ridge + (a.T @ own).astype(float), a.T @ y[active])
        w = 0.5 * w + 0.5 * fresh if turn else fresh
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def pool(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Features of each text: its three highest values, hits, length."""
    top = np.full((n, 3), -1.5)
    high = np.flatnonzero(values > -1.5)
    order = high[np.lexsort((-values[high], text[high]))]
    rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
    for k in range(3):
        at = order[rank == k]
        top[text[at], k] = values[at]
    hits, size = np.bincount(text[values > 0], minlength=n), np.bincount(text, minlength=n)
    length = np.log1p(size)
    return np.c_[np.minimum(top, 1.5), np.log1p(hits), length, np.log1p(1000.0 * hits / np.maximum(size, 20))]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights with bias, mean, scale) by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-z @ w))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w = w + np.linalg.solve(h, z.T @ (y - p) - ridge * w)
    return w, mean, scale


def as_table(marks: list[bytes], alpha: np.ndarray) -> np.ndarray:
    """A machine over landmarks as one table over letter triples."""
    flat, heads = _pack(marks)
    owner = np.repeat(np.arange(len(marks)), np.diff(heads))
    scaled = alpha / _norm(np.diff(heads))
    table = np.zeros(LETTERS**3)
    for at, triple, weight in _triples(flat, heads):
        np.add.at(table, triple, scaled[owner[at]] * weight)
    return table.astype(np.float32)


def train(texts: list[str | None], toxic: list[int], seed: int = 5) -> dict:
    y = np.array(toxic, float)
    if not len(y) or y.min() == y.max():
        return {"share": float(y.mean()) if len(y) else 0.0}
    r = np.random.default_rng(seed)
    bad, good = count_units(texts, y)
    share = y.mean()
    telling = {}  # log-likelihood ratio against a unit that comes as often in either kind
    for w, n in bad.items():
        both = n + good[w]
        rest = good[w] * np.log(good[w] / (both * (1 - share))) if good[w] else 0.0
        telling[w] = (n * np.log(n / (both * share)) + rest) * (1 if n > both * share else -1)
    enough = np.log(len(telling) + len(good) + 1.0) + 1  # a unit must tell more than the best of as many by chance
    picked = [w for w in sorted(telling, key=lambda w: (-telling[w], w)) if telling[w] > enough and len(w) > 4]
    common = [w for w, _ in sorted(good.items(), key=lambda x: (-x[1], x[0]))]
    marks = picked[:LANDMARKS] + [w for w in common if w not in telling or telling[w] < 0][:CLEAN_LANDMARKS]
    if not picked or len(marks) < 2:
        return {"share": float(y.mean())}
    known = set(picked)
    common = [w for w in common if w not in known]
    clean = common if len(common) <= NEGATIVES else [common[i] for i in sorted(r.choice(len(common), NEGATIVES, replace=False))]
    more = [_varied(w, r) for w in picked for _ in range(3)]
    k = kernel(marks, marks).astype(float)
    values, vectors = np.linalg.eigh((k + k.T) / 2)
    ok = values > 1e-5 * values.max()
    white = vectors[:, ok] / np.sqrt(values[ok])
    white = white.astype(np.float32)
    positive = kernel(picked + more, marks) @ white
    negative = kernel(clean, marks) @ white
    count = np.array([bad[w] for w in picked], float)
    share = np.sqrt(np.r_[count, np.repeat(count, 3) / 2])
    used, taken = set(clean), list(clean)
    for turn in range(MINING + 1):
        n_pos, n_neg = len(positive), len(negative)
        often = np.array([1 + np.log(good[x]) for x in taken])
        weight = np.r_[share * often.sum() / share.sum() / 3, often]
        w = _hinge(np.r_[positive, negative], np.r_[np.ones(n_pos), -np.ones(n_neg)], weight)
        table = as_table(marks, white @ w[:-1])
        if turn < MINING:  # clean units that come too near join the negatives
            found = np.concatenate([decide(*_pack(common[i : i + 20000]), table, float(w[-1])) for i in range(0, len(common), 20000)])
            near = [common[i] for i in np.argsort(-found, kind="stable")[:NEGATIVES] if found[i] > -0.7 and common[i] not in used]
            used.update(near)
            taken += near
            negative = np.r_[negative, kernel(near, marks) @ white] if near else negative
    model = {"table": table, "bias": float(w[-1])}
    pooled = [_features(model, data, offsets) for _, _, data, offsets in tokens.slices(pa.array(texts, pa.string()), 1 << 20)]
    model["logit"] = _logistic(np.concatenate(pooled), y)
    return model


def _features(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    flat, heads, text = units(data, offsets)
    return pool(decide(flat, heads, model["table"], model["bias"]), text, len(offsets) - 1)


def probabilities(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    if "table" not in model:
        return np.full(n, model["share"])
    w, mean, scale = model["logit"]
    x = _features(model, data, offsets)
    return 1 / (1 + np.exp(-(((x - mean) / scale) @ w[:-1] + w[-1])))


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple]:
    """Bounded (text, toxic) pairs: one text for each chosen id. Ids are chosen before texts are touched; their number has a bound, so they are broadcast.

    Labelled ids are counted by class; only the share of each class that holds some four times as many as asked for is
    ranked, so no task ranks all labels of a class. Of an id with several texts the one with the smallest hash counts.
    """
    given = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("bad", F.col("toxic") == 1).withColumn("h", F.xxhash64("doc_id"))
    most = {True: TRAIN_TOXIC, False: TRAIN_CLEAN}
    sizes = {r.bad: r.n for r in given.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    limit = lambda of: F.when(F.col("bad"), F.lit(of(True))).otherwise(F.lit(of(False)))
    early = F.col("h").cast("double") / F.lit(2.0**64) + 0.5 <= limit(lambda k: min(1.0, max(4.0 * most[k], 200.0) / sizes.get(k, 1)))
    place = F.row_number().over(Window.partitionBy("bad").orderBy("h", "doc_id"))
    ids = given.filter(early).withColumn("n", place).filter(F.col("n") <= limit(lambda k: most[k])).select("doc_id", "toxic")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic"))
    return sorted({(r.text or "", int(r.toxic == 1)) for r in rows.collect()})


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of LETTERS**3 floats, whatever the corpus

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in tokens.slices(batch.column("text"), 2 << 20):
                p = probabilities(shared.value, data, offsets)
                yield pa.record_batch([batch.column("doc_id").slice(row, end - row), pa.array(p, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest: learns from labels whose bucket modulo 4 is not 2, scores all documents."""
    held = bucket(F.col("doc_id"), 4) == 2
    found = sample(docs, labels.filter(~held))
    model = train([t for t, _ in found], [x for _, x in found])
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
