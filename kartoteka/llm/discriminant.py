"""Quality by a regularised quadratic discriminant over transformed document statistics.

Every text becomes a vector of statistics (lengths, shares of kinds of characters, repetition, entropy), each pulled
towards a normal shape by a logarithm or a square root; shares are taken as of texts some words longer, so that one
sign in a text of one word is not a third of it. The vectors are written once, as a narrow table. Over the
labelled rows Spark sums counts, means and outer products by class; the driver gets those sums alone, whose size
follows the number of statistics and not the corpus. Statistics are put on one scale and held within CLIP deviations,
so that a text outside of what was learned, such as a very long one, is not thrown to the class of larger variance.

A class covariance is shrunk twice: towards that of both classes together (BETWEEN), then towards a multiple of the
identity (ROUND). Both shares are those with the smallest log loss on every FOLD-th labelled document, learned without
it; the model then learns from all. The driver caches the inverse of each Cholesky factor, and a score is the logistic
function of the difference of log densities (Mahalanobis distances and determinants) and of the log of the class ratio.

Learned from all labelled rows, no sample.

Defined cases: null and empty texts have zero statistics and a score as any other text; several labels of one id count
by the highest, null ones not at all; without labels of both classes the score is the share of good labels (0 if there
are none); repeated rows get equal scores; very long texts are read whole; an empty table gives an empty
result; no other column is looked at, whatever its name.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.llm import tokens
from kartoteka.llm.common import bucket, discard, stored

#: Shares of the shrinkage that are tried.
BETWEEN, ROUND = (0.05, 0.2, 0.5), (0.01, 0.05, 0.2)
CLIP, FOLD, THRESHOLD = 4.0, 4, 0.3
#: Characters and words added to the length of every text when shares are taken.
MORE_CHARS, MORE_WORDS = 40, 8
#: Statistics, in the order of a vector.
NAMES = [
    "log_chars", "log_words", "log_word_length", "word_length_deviation", "distinct", "twins", "repeated_triples", "upper", "digits",
    "symbols", "shouts", "stops", "beyond_ascii", "entropy", "newlines", "symbol_ends", "short_words", "capital_words",
]
_SYMBOL = tokens.table(lambda b: chr(b) in "#$%&*|<>{}[]\\^~_=+@/`")
_KINDS = np.array(
    [
        tokens.table(lambda b: 0x41 <= b <= 0x5A),
        tokens.table(lambda b: 0x30 <= b <= 0x39),
        _SYMBOL,
        tokens.table(lambda b: chr(b) in "!?"),
        tokens.table(lambda b: chr(b) in ".,;:"),
        tokens.table(lambda b: b >= 0xC0),
        tokens.table(lambda b: b == 0x0A),
    ]
)
_POINT = tokens.table(lambda b: not 0x80 <= b < 0xC0)


def _by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of a value per word over the words of each text."""
    return np.diff(np.r_[0.0, np.cumsum(values)][first])


def _fresh(keys: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each text."""
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    return np.bincount(t[new], minlength=n).astype(float)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of NAMES for each text."""
    n = len(offsets) - 1
    bytes_ = np.zeros((n, 256))
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        bytes_[i] = np.bincount(data[a:b], minlength=256)
    chars = bytes_ @ _POINT
    share = np.sqrt((bytes_ @ _KINDS.T) / (chars + MORE_CHARS)[:, None])
    p = bytes_ / np.maximum(bytes_.sum(1), 1)[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)

    starts, ends, first = tokens.spans(data, offsets, tokens.NOT_SPACE)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    text = np.repeat(np.arange(n), np.diff(first))
    upto = np.r_[0, np.cumsum(_POINT[data], dtype=np.int64)]
    size = (upto[ends] - upto[starts]).astype(float)
    mean = _by_text(size, first) / some
    spread = np.sqrt(np.maximum(_by_text(size**2, first) / some - mean**2, 0))
    h = tokens.hashes(data, starts, ends)
    same = text[1:] == text[:-1]
    twins = np.r_[False, (h[1:] == h[:-1]) & same][: len(h)]
    triples, of = tokens.windows(h, first, 3)
    n_triples = np.bincount(of, minlength=n)
    return np.column_stack(
        [
            np.log1p(chars),
            np.log1p(words),
            np.log1p(mean),
            np.log1p(spread),
            np.log((_fresh(h, text, n) + MORE_WORDS) / (words + MORE_WORDS)),
            np.sqrt(_by_text(twins, first) / (words + MORE_WORDS)),
            np.sqrt((n_triples - _fresh(triples, of, n)) / (n_triples + MORE_WORDS)),
            share[:, :6],
            entropy,
            share[:, 6],
            np.sqrt(_by_text(_SYMBOL[data[ends - 1]], first) / (words + MORE_WORDS)),
            np.sqrt(_by_text(size <= 3, first) / (words + MORE_WORDS)),
            np.sqrt(_by_text(_KINDS[0][data[starts]], first) / (words + MORE_WORDS)),
        ]
    )


def vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row of (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in tokens.slices(batch.column("text")):
                x = statistics(data, offsets)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.record_batch([batch.column("doc_id").slice(row, end - row), flat], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of vectors."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _moments(rows: DataFrame, center: np.ndarray, scale: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """By (good, fold): sums of the outer products of (1, z), where z is x on one scale; summed in Spark, whatever the rows."""

    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = np.clip((matrix(batch.column("x")) - center) / scale, -CLIP, CLIP) if len(batch) else np.zeros((0, len(center)))
            x = np.column_stack([np.ones(len(x)), x])
            good, fold = (batch.column(c).to_numpy() for c in ("good", "fold"))
            for g, f in itertools.product((0, 1), (0, 1)):
                part = x[(good == g) & (fold == f)]
                sums[g, f] = sums.get((g, f), 0.0) + part.T @ part
        for (g, f), m in sums.items():
            if m[0, 0]:
                yield pa.record_batch([pa.array([g] * m.size), pa.array([f] * m.size), pa.array(np.arange(m.size)), pa.array(m.ravel())], ["g", "f", "at", "v"])

    summed = rows.mapInArrow(run, "g long, f long, at long, v double").groupBy("g", "f", "at").agg(F.sum("v").alias("v")).collect()
    k = len(center) + 1
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in summed:
        out.setdefault((r.g, r.f), np.zeros(k * k))[r.at] = r.v
    return {key: m.reshape(k, k) for key, m in out.items()}


def solve(moments: dict[int, np.ndarray], between: float, round_: float) -> dict:
    """Means, inverse Cholesky factors and constants of both classes from their moments."""
    n = {g: m[0, 0] for g, m in moments.items()}
    mean = {g: m[0, 1:] / n[g] for g, m in moments.items()}
    scatter = {g: m[1:, 1:] - n[g] * np.outer(mean[g], mean[g]) for g, m in moments.items()}
    pooled, parts = sum(scatter.values()) / sum(n.values()), {}
    for g in moments:
        cov = (1 - between) * scatter[g] / n[g] + between * pooled
        cov = (1 - round_) * cov + round_ * max(np.trace(cov) / len(cov), 1e-6) * np.eye(len(cov))
        low = np.linalg.cholesky(cov)
        parts[g] = (mean[g], np.linalg.inv(low), np.log(n[g] / sum(n.values())) - np.log(np.diag(low)).sum())
    return parts


def logit(parts: dict, z: np.ndarray) -> np.ndarray:
    """Log of the odds of class 1."""
    side = [const - 0.5 * (((z - mean) @ inv.T) ** 2).sum(1) for mean, inv, const in (parts[0], parts[1])]
    return np.clip(side[1] - side[0], -30, 30)


def _loss(rows: DataFrame, center, scale, tried: list[dict]) -> list[float]:
    """Log loss of every model over the rows set apart."""

    def run(batches):
        total = np.zeros(len(tried))
        for batch in batches:
            if len(batch):
                z, y = np.clip((matrix(batch.column("x")) - center) / scale, -CLIP, CLIP), batch.column("good").to_numpy()
                total += [np.logaddexp(0, np.where(y == 1, -1, 1) * logit(p, z)).sum() for p in tried]
        yield pa.record_batch([pa.array(np.arange(len(tried))), pa.array(total)], ["at", "v"])

    got = {r.at: r.v for r in rows.filter("fold = 1").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()}
    return [got.get(i, 0.0) for i in range(len(tried))]


def train(rows: DataFrame) -> dict:
    """The model of labelled rows (x, good, fold): counts, scales, one sum of moments and one of losses."""
    k = len(NAMES)
    counts = {r.good: r.n for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if set(counts) != {0, 1}:
        return {"share": 1.0 if counts.get(1) else 0.0}
    first = rows.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    center, scale = np.zeros(k), np.ones(k)
    for r in first:
        center[r.at], scale[r.at] = r.m, r.s if r.s > 1e-9 else 1.0
    by_fold = _moments(rows, center, scale)
    whole = {g: sum(m for (c, _), m in by_fold.items() if c == g) for g in (0, 1)}
    grid = list(itertools.product(BETWEEN, ROUND))
    best = grid[len(grid) // 2]
    if all((g, f) in by_fold for g in (0, 1) for f in (0, 1)):
        loss = _loss(rows, center, scale, [solve({g: by_fold[g, 0] for g in (0, 1)}, *x) for x in grid])
        best = grid[int(np.argmin(loss))]
    return {"center": center, "scale": scale, "shrinkage": best, "parts": solve(whole, *best)}


def probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    if "parts" not in model:
        return np.full(len(x), model["share"])
    z = np.clip((x - model["center"]) / model["scale"], -CLIP, CLIP)
    return 1 / (1 + np.exp(-logit(model["parts"], z)))


def score(features: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of (doc_id, x)."""
    kind = features.schema["doc_id"].dataType.simpleString()
    shared = features.sparkSession.sparkContext.broadcast(model)  # two small matrices, whatever the corpus

    def run(batches):
        for batch in batches:
            if len(batch):
                yield pa.record_batch([batch.column("doc_id"), pa.array(probabilities(shared.value, matrix(batch.column("x"))))], ["doc_id", "score"])

    return features.mapInArrow(run, f"doc_id {kind}, score double")


def labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, good, fold) of the rows whose id has a label."""
    given = labels.filter("quality is not null").groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"))
    fold = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(FOLD)) == 0, 1).otherwise(0).alias("fold")
    return features.join(given, "doc_id").select("x", "good", fold)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest: learns from labels whose bucket modulo 5 is not 0, scores all documents."""
    held = bucket(F.col("doc_id"), 5) == 0
    features = stored(vectors(docs), "statistics")
    rows = stored(labelled(features, labels.filter(~held)), "labelled")
    model = train(rows)
    discard(rows)
    return score(features, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
