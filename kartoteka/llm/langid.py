"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into segments of SEGMENT bytes (the last one of a text reaches back over the one before it, a shorter
text is padded), both directions run over every segment, every position gets a distribution over languages, and a
document's probabilities are the mean over all of its positions. The network is trained in numpy by backpropagation
through time on a bounded sample: at most TRAIN_DOCS texts of each language (the ones whose hashed ids come first)
and TRAIN_SEGMENTS segments of each, spread over the whole text. Scoring reads every byte of every text.

Defined cases: texts that are null, empty or have no letter (Unicode category L) are `und` with score 0; without any row to learn from, all are
`und`; null languages are not learned from; repeated rows get equal answers; ties go to the language that sorts
first; very long texts are read whole, in slices; a null id is kept; an empty table gives an empty result; other
columns are never looked at, whatever their names.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kartoteka.llm import tokens
from kartoteka.llm.common import bucket

HIDDEN, SEGMENT = 8, 64
#: Bounds of the training sample.
TRAIN_DOCS, TRAIN_SEGMENTS = 300, 12
STEPS, BATCH, RATE = 300, 384, 0.02
#: Segments worked on at once: their gates fit a core's cache.
ROWS = 4096
#: Letters, and a few signs of other categories that are told apart by `has_letter`.
_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether a code point is of Unicode category L; superscripts, fractions and circled or roman numerals are not."""
    return any(unicodedata.category(m[0])[0] == "L" for m in _WORDLIKE.finditer(text or ""))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def new_network(languages: list[str], seed: int = 3, hidden: int = HIDDEN) -> dict:
    r = np.random.default_rng(seed)
    net = {}
    for way in "fb":  # forward and backward
        net[f"in_{way}"] = r.normal(0, 0.1, (256, 3 * hidden))  # gates z, r and the candidate, by byte
        net[f"rec_{way}"] = r.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        net[f"out_{way}"] = r.normal(0, 0.3, (hidden, len(languages)))
    net["out_bias"] = np.zeros(len(languages))
    return {k: v.astype(np.float32) for k, v in net.items()} | {"languages": languages}


def _run(x: np.ndarray, inputs: np.ndarray, rec: np.ndarray, keep: bool):
    """States of one direction over x (steps, rows): h = (1 - z) * candidate + z * h before."""
    steps, rows = x.shape
    n = rec.shape[0]
    h = np.zeros((rows, n), np.float32)
    out = np.empty((steps, rows, n), np.float32)
    trail = []
    for t in range(steps):
        gates, back = inputs[x[t]], h @ rec
        zr = _sigmoid(gates[:, : 2 * n] + back[:, : 2 * n])
        z, r = zr[:, :n], zr[:, n:]
        cand = np.tanh(gates[:, 2 * n :] + r * back[:, 2 * n :])
        if keep:
            trail.append((h, z, r, cand, back[:, 2 * n :]))
        h = cand + z * (h - cand)
        out[t] = h
    return out, trail


def _run_back(x: np.ndarray, trail: list, rec: np.ndarray, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backpropagation through time of `_run`: gradients of inputs and rec."""
    n = rec.shape[0]
    d_in, d_rec = np.zeros((256, 3 * n), np.float32), np.zeros_like(rec)
    d_h = np.zeros_like(d_out[0])
    for t in range(len(trail) - 1, -1, -1):
        before, z, r, cand, back = trail[t]
        d_h = d_h + d_out[t]
        d_cand = d_h * (1 - z) * (1 - cand * cand)
        d_z = d_h * (before - cand) * z * (1 - z)
        d_r = d_cand * back * r * (1 - r)
        d_gates = np.concatenate([d_z, d_r, d_cand], axis=1)
        d_back = np.concatenate([d_z, d_r, d_cand * r], axis=1)
        np.add.at(d_in, x[t], d_gates)
        d_rec += before.T @ d_back
        d_h = d_h * z + d_back @ rec.T
    return d_in, d_rec


def position_probabilities(net: dict, x: np.ndarray, keep: bool = False):
    """(steps, rows, languages) for bytes x (steps, rows)."""
    f, f_trail = _run(x, net["in_f"], net["rec_f"], keep)
    b, b_trail = _run(x[::-1], net["in_b"], net["rec_b"], keep)
    logits = f @ net["out_f"] + b[::-1] @ net["out_b"] + net["out_bias"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    return (p, f, b, f_trail, b_trail) if keep else p


def gradients(net: dict, x: np.ndarray, weight: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over weighted positions, and its gradients."""
    p, f, b, f_trail, b_trail = position_probabilities(net, x, keep=True)
    rows = np.arange(x.shape[1])
    total = weight.sum()
    loss = float(-(np.log(p[:, rows, label] + 1e-9) * weight).sum() / total)
    d = p.copy()
    d[:, rows, label] -= 1
    d *= (weight / total)[:, :, None]
    grads = {"out_bias": d.sum(axis=(0, 1)), "out_f": np.tensordot(f, d, axes=([0, 1], [0, 1])), "out_b": np.tensordot(b[::-1], d, axes=([0, 1], [0, 1]))}
    grads["in_f"], grads["rec_f"] = _run_back(x, f_trail, net["rec_f"], d @ net["out_f"].T)
    grads["in_b"], grads["rec_b"] = _run_back(x[::-1], b_trail, net["rec_b"], (d @ net["out_b"].T)[::-1])
    return loss, grads


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, positions from which a segment's bytes are its own, text) so that every byte is owned once."""
    size = np.diff(offsets)
    n = -(-size // SEGMENT)
    text = np.repeat(np.arange(len(size)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    plain = nth * SEGMENT
    back = np.minimum(plain, np.maximum(size[text] - SEGMENT, 0))
    return offsets[text] + back, plain - back, text


def cut(data: np.ndarray, starts: np.ndarray, own: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (SEGMENT, rows), padded with spaces beyond `end`, and weights: 1 where a byte is the segment's own."""
    padded = np.concatenate([data, np.full(SEGMENT, 32, np.uint8)])
    x = np.lib.stride_tricks.sliding_window_view(padded, SEGMENT)[starts].T.copy()
    at = np.arange(SEGMENT)[:, None]
    beyond = at >= (end - starts)[None, :]
    x[beyond] = 32
    return x, ((at >= own[None, :]) & ~beyond).astype(np.float32)


def train(texts: list[str], labels: list[str], seed: int = 3) -> dict | None:
    """A network from texts and their languages."""
    languages = sorted(set(labels))
    if not languages:
        return None
    net = new_network(languages, seed)
    data, offsets = tokens.buffers(pa.array(texts, pa.string()))
    starts, own, text = segments(data, offsets)
    place = np.arange(len(text)) - np.searchsorted(text, text)
    count = np.bincount(text, minlength=len(texts))[text]
    chosen = np.flatnonzero(place % np.maximum(1, -(-count // TRAIN_SEGMENTS)) == 0)
    if not len(chosen):
        return None
    label = np.array([languages.index(x) for x in labels])[text]
    groups = [chosen[label[chosen] == k] for k in range(len(languages))]
    groups = [g for g in groups if len(g)]
    r = np.random.default_rng(seed)
    names = [k for k in net if k != "languages"]
    first, second = ({k: np.zeros_like(net[k]) for k in names} for _ in range(2))
    for step in range(1, STEPS + 1):
        pick = np.concatenate([r.choice(g, max(1, BATCH // len(groups))) for g in groups])  # languages in equal parts
        x, weight = cut(data, starts[pick], own[pick], offsets[text[pick] + 1])
        _, grads = gradients(net, x, weight, label[pick])
        rate = RATE * (1 - 0.9 * step / STEPS)
        for k in names:  # Adam
            g = np.clip(grads[k], -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            net[k] = (net[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def pooled(net: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, languages): mean of position probabilities; zeros for empty texts."""
    starts, own, text = segments(data, offsets)
    total = np.zeros((len(offsets) - 1, len(net["languages"])), np.float64)
    for a in range(0, len(starts), ROWS):
        s = slice(a, a + ROWS)
        x, weight = cut(data, starts[s], own[s], offsets[text[s] + 1])
        mass = np.einsum("tbl,tb->bl", position_probabilities(net, x), weight)
        np.add.at(total, text[s], mass)
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def sample(docs: DataFrame, most: int = TRAIN_DOCS) -> list[tuple[str, str]]:
    """At most `most` (text, language) pairs of each language: those whose hashes come first.

    Different texts of each language are counted first (the network has outputs for each language, so they are few); then
    only the share of rows that holds some four times as many as asked for leaves the scan. Copies of a text have one hash
    and meet before they are ranked, so neither a language nor a text that a third of all rows repeat meets in one task.
    """
    own = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select("text", "lang", F.xxhash64("text").alias("h"))
    sizes = {r.lang: r.n for r in own.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not sizes:
        return []
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, max(4.0 * most, 200.0) / max(n, 1)))])
    early = F.col("h").cast("double") / F.lit(2.0**64) + 0.5 <= F.try_element_at(share, F.col("lang"))
    once = own.filter(early).groupBy("lang", "h").agg(F.first("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    rows = once.withColumn("n", place).filter(F.col("n") <= most)
    return sorted({(r.text, r.lang) for r in rows.collect()})  # a few hundred texts of each language


def predict(docs: DataFrame, net: dict | None) -> DataFrame:
    """(doc_id, lang_pred, score) of (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some 30 KB, whatever the corpus

    def score(batches):
        net = shared.value
        for batch in batches:
            for row, end, data, offsets in tokens.slices(batch.column("text")):
                own = batch.slice(row, end - row)
                lang, top = ["und"] * (end - row), np.zeros(end - row)
                if net:
                    p = pooled(net, data, offsets)
                    best = p.argmax(axis=1)
                    for i, t in enumerate(own.column("text").to_pylist()):
                        if has_letter(t):
                            lang[i], top[i] = net["languages"][best[i]], min(1.0, float(p[i, best[i]]))
                yield pa.record_batch([own.column("doc_id"), pa.array(lang, pa.string()), pa.array(top, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")


def report(docs: DataFrame) -> DataFrame:
    """The digest: learns from documents whose bucket modulo 3 is not 1, predicts all."""
    held = bucket(F.col("doc_id"), 3) == 1
    found = sample(docs.filter(~held))
    net = train([t for t, _ in found], [x for _, x in found])
    return predict(docs, net).select("doc_id", held.alias("held_out"), "lang_pred", "score")
