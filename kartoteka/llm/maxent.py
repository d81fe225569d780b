"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

A token is predicted by a path of softmaxes over WAYS children each: from the root to a class, from there to classes in
it, down to the word. The ANCHORS most frequent words (mostly function words) are two steps down, further words three or
more: the deepest classes get as many levels as the counted vocabulary needs, so the model follows the corpus. Words
below LEAST tokens, and unseen ones, are in one of TAIL classes by their ending and have add-one unigram probabilities
there, so the model is a distribution over all words.

Every softmax is conditioned on hashed features of the text before: the last word, the last two (an n-gram), the last
anchor and the last two anchors at any distance (skips); below the root the last word and the last anchor. A feature at a node is a row of weights, one for each child, in
a table whose size follows the number of tokens; rows of a node are its own, in proportion to its tokens. Training is
order-free, so results do not depend on how texts are partitioned. Over seven eighths of the training texts every task adds up
how often each child followed each feature; the sums, met in Spark, give the weights by one update of iterative scaling
from zero, smoothed by SMOOTH. UPDATES rounds of distributed gradient updates follow: first of the strength of each kind of
feature, over the last eighth (chosen by a hash of the text), which the counts have not seen, then of every weight of every
feature, over all training texts. Tasks add up gradients (of strengths, curvatures too), Spark sums them, the driver takes the step.

Tokens are counted over all training texts. Words are told apart by 64-bit hashes. The HEAD_COUNTS most frequent
ones (a fixed bound) go to all tasks; the words of a text beyond these, none of which is frequent, are joined with
the counts by a shuffle. The table of weights has MOST_ROWS rows at most: both bounds keep a task's memory.

Defined cases: null and empty texts are one end token; without training texts every probability is uniform over
nothing seen (base score 0); repeated rows get equal scores; ties in frequency go to the smaller hash; very long texts
are cut into slices between texts only; a null id counts as the empty text for the split; an empty table gives an empty
result; no other column is looked at, whatever its name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.llm import tokens
from kartoteka.llm.common import bucket, stored

#: Children of a softmax; of the root: tail classes, classes of anchors, of three-step words, of deeper ones.
WAYS, TAILS, NEAR, MIDDLE = 32, 8, 12, 8
TAIL, ANCHORS, MIDDLES = TAILS * WAYS, NEAR * WAYS, MIDDLE * WAYS * WAYS
#: Tokens a word needs to be modelled, and weight of the prior in a row of weights.
LEAST, SMOOTH = 8, 16.0
HEAD_COUNTS = 1 << 19
#: Of a gradient step over all weights: its length, and counts added to the curvature.
STEP, DAMP = 1.0, 16.0
FEWEST_ROWS, USUAL_ROWS, MOST_ROWS = 1 << 13, 1 << 17, 1 << 20
UPDATES, FOLDS = 1, 8
#: Bits by which a word is looked up.
PREFIX = 20
#: Tokens whose steps are worked on at once: their arrays fit a core's cache.
CHUNK = 1 << 13
#: Counts travel in blocks of this many numbers, summed at once if no more than FEW partitions have some, else in FAN parts first.
BLOCK, FAN, FEW = 1 << 16, 4, 16
END, BEGIN = np.uint64(0x5DEECE66D1234567), np.uint64(0x1B873593CC9E2D51)
#: Kinds of features at the root and below it.
ROOT, BELOW = (0, 1, 2, 3), (0, 2)


def stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens with an end after each text, first token of each text and the total, tail class of each token)."""
    low = tokens.LOWER[data]
    starts, ends, first = tokens.spans(low, offsets, tokens.NOT_SPACE)
    n = len(offsets) - 1
    heads = first + np.arange(n + 1)
    out, ending = np.full(len(starts) + n, END), np.zeros(len(starts) + n, np.int64)
    at = np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(first))
    out[at] = tokens.hashes(low, starts, ends)
    last = low[ends - 1].astype(np.int64)
    ending[at] = (last * 31 + np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)], 7) * 17) % TAIL
    return out, heads, ending


def features(tok: np.ndarray, heads: np.ndarray, anchor: np.ndarray) -> list[np.ndarray]:
    """Keys of the last word, the last two, the last anchor, the last two anchors before each token; BEGIN before a text."""
    begin = np.repeat(heads[:-1], np.diff(heads))
    place = np.arange(len(tok)) - begin
    one, two = np.full(len(tok), BEGIN), np.full(len(tok), BEGIN)
    one[1:], two[2:] = tok[:-1], tok[:-2]
    one, two = np.where(place >= 1, one, BEGIN), np.where(place >= 2, two, BEGIN)
    last = np.maximum.accumulate(np.where(anchor, np.arange(len(tok)), -1)) if len(tok) else np.zeros(0, np.int64)
    last = np.r_[-1, last[:-1]][: len(tok)]
    seen = last >= begin
    before = np.where(seen, last[np.maximum(last, 0)], -1)
    near = np.where(seen, tok[np.maximum(last, 0)], BEGIN)
    far = np.where(before >= begin, tok[np.maximum(before, 0)], BEGIN)
    u = np.uint64
    return [tokens.mix(one + u(1)), tokens.mix(one * u(5) + tokens.mix(two)), tokens.mix(near + u(9)), tokens.mix(near * u(7) + tokens.mix(far))]


def _spread(codes: np.ndarray, depth: np.ndarray, ids: np.ndarray, first: int, classes: int, levels: int) -> None:
    """Give ids, in this order, evenly spread places below `classes` children of the root from `first` on."""
    if len(ids):
        place = np.arange(len(ids)) * (classes * WAYS**levels) // len(ids)
        codes[ids, 0] = first + place // WAYS**levels
        for k in range(levels):
            codes[ids, 1 + k] = place // WAYS ** (levels - 1 - k) % WAYS
        depth[ids] = 1 + levels


def new_model(words: np.ndarray, counts: np.ndarray, ending: np.ndarray, tail_n: np.ndarray, tail_v: np.ndarray, total: int) -> dict:
    """words: hashes of the most frequent words, sorted; tail_n, tail_v: tokens and words of each tail class over all words."""
    v = len(words)
    order = np.lexsort((words, -counts))
    order = order[counts[order] >= LEAST]
    deep, deeper = WAYS - TAILS - NEAR - MIDDLE, order[ANCHORS + MIDDLES :]
    levels = 1
    while deep * WAYS**levels < len(deeper):
        levels += 1
    codes, depth = np.zeros((v, 2 + levels), np.int64), np.full(v, 2)
    codes[:, 0], codes[:, 1] = ending // WAYS, ending % WAYS
    modelled, anchor = np.zeros(v, bool), np.zeros(v, bool)
    modelled[order], anchor[order[:ANCHORS]] = True, True
    rank = np.arange(len(order[:ANCHORS]))
    codes[order[:ANCHORS], 0], codes[order[:ANCHORS], 1] = TAILS + rank // WAYS, rank % WAYS
    by_ending = lambda ids: ids[np.lexsort((words[ids], ending[ids]))]  # noqa: E731  words of one ending share classes
    middle = by_ending(order[ANCHORS : ANCHORS + MIDDLES])
    _spread(codes, depth, middle, TAILS + NEAR, MIDDLE, 1 if len(middle) <= MIDDLE * WAYS else 2)
    _spread(codes, depth, by_ending(deeper), TAILS + NEAR + MIDDLE, deep, levels)
    tail_n, tail_v = tail_n.astype(float).copy(), tail_v.astype(float).copy()
    np.subtract.at(tail_n, ending[modelled], counts[modelled])
    np.subtract.at(tail_v, ending[modelled], 1)
    # Nodes by the path that leads to them; tail nodes are there even if nothing was seen in them.
    step = codes.shape[1]
    paths, path = np.full((v, step), -1), np.zeros(v, np.int64)
    for k in range(step):
        paths[:, k] = np.where(depth > k, path, -1)
        path = path * (WAYS + 1) + 1 + codes[:, k]
    names, place = np.unique(np.r_[0, 1 + np.arange(TAILS), paths[paths >= 0]], return_inverse=True)
    nodes = np.full((v, step), -1)
    nodes[paths >= 0] = place[1 + TAILS :]
    tail_nodes = place[1 : 1 + TAILS]
    mass = np.zeros((len(names), WAYS))
    for k in range(step):
        use = modelled & (depth > k)
        np.add.at(mass, (nodes[use, k], codes[use, k]), counts[use])
    mass[0, :TAILS] += tail_n.reshape(TAILS, WAYS).sum(axis=1)
    mass[tail_nodes] += tail_n.reshape(TAILS, WAYS)
    there = mass > 0
    there[0, :TAILS] = there[tail_nodes] = True
    prior = np.where(there, mass + 0.5, 0)
    prior /= prior.sum(axis=1, keepdims=True)
    rows = max(min(total / 16, USUAL_ROWS), total / 2048)
    rows = 1 << int(np.clip(round(np.log2(max(rows, 1))), np.log2(FEWEST_ROWS), np.log2(MOST_ROWS)))
    size = np.maximum(4, rows * mass.sum(axis=1) / max(mass.sum(), 1)).astype(np.int64)
    own = np.flatnonzero(modelled)
    # Hashes are even: of words by their first PREFIX bits there are one or two.
    near = np.searchsorted(words, np.arange(1 << PREFIX, dtype=np.uint64) << np.uint64(64 - PREFIX)).astype(np.int32)
    slot = np.full(v, -1, np.int32)
    slot[own] = np.arange(len(own))
    return {
        "words": words, "near": near, "logs": np.log10(counts + 1.0), "slot": slot, "codes": codes[own].astype(np.int8), "depth": depth[own].astype(np.int8), "nodes": nodes[own].astype(np.int32), "anchor": anchor[own], "tail_nodes": tail_nodes,
        "prior": np.log(np.maximum(prior, 1e-30)).astype(np.float32), "there": there, "size": size.astype(np.uint64), "salt": tokens.mix(np.arange(len(size), dtype=np.uint64)), "base": np.r_[0, np.cumsum(size)[:-1]],
        "tail": np.log10(np.maximum(tail_n, 0) + np.maximum(tail_v, 0) + 1), "weights": None, "strength": np.full((2, 4), 0.5, np.float32),
    }


def find(m: dict, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each token among the model's words, whether it is there, place among the modelled ones or -1)."""
    if not len(m["words"]):
        return np.zeros(len(tok), np.int64), np.zeros(len(tok), bool), np.full(len(tok), -1)
    words, last = m["words"], len(m["words"]) - 1
    at = np.minimum(m["near"][(tok >> np.uint64(64 - PREFIX)).astype(np.int64)].astype(np.int64), last)
    behind = np.flatnonzero((words[at] < tok) & (at < last))
    while len(behind):
        at[behind] += 1
        behind = behind[(words[at[behind]] < tok[behind]) & (at[behind] < last)]
    found = words[at] == tok
    return at, found, np.where(found, m["slot"][at], -1)


def anchors(m: dict, slot: np.ndarray) -> np.ndarray:
    """Whether tokens are anchors."""
    return m["anchor"][slot] & (slot >= 0) if len(m["anchor"]) else np.zeros(len(slot), bool)


def steps(m: dict, tok: np.ndarray, heads: np.ndarray, ending: np.ndarray, keys: list[np.ndarray] | None = None, slot: np.ndarray | None = None):
    """For each chunk of tokens and level: (first token of the chunk, tokens in it that go so far (None: all, at the root), their node, the child they take, rows of their features)."""
    slot = find(m, tok)[2] if slot is None else slot
    if not len(m["words"]):
        return
    if keys is None:
        keys = features(tok, heads, anchors(m, slot))
    for first in range(0, len(tok), CHUNK):
        part = slice(first, first + CHUNK)
        for use, node, child, rows in _chunk(m, slot[part], ending[part], [k[part] for k in keys]):
            yield first, use, node, child, rows


def _chunk(m: dict, slot: np.ndarray, ending: np.ndarray, keys: list[np.ndarray]):
    own = slot >= 0
    at = np.where(own, slot, 0)
    depth = np.where(own, m["depth"][at], 2) if len(m["depth"]) else np.full(len(slot), 2)
    half, odd = np.uint64(32), np.uint64(0x9E3779B97F4A7C15)
    for level in range(m["codes"].shape[1]):
        use = np.flatnonzero(depth > level)
        if not len(use):
            return
        mine, who = own[use], at[use]
        tail = ending[use] // WAYS if level == 0 else ending[use] % WAYS
        child, node = tail, np.zeros(len(use), np.int64) if level == 0 else m["tail_nodes"][ending[use] // WAYS]
        if len(m["codes"]):
            child, node = np.where(mine, m["codes"][who, level], child), np.where(mine, m["nodes"][who, level], node)
        salt, size, base = m["salt"][node], m["size"][node], m["base"][node]
        rows = []
        for f in ROOT if level == 0 else BELOW:
            hashed = ((keys[f][use] ^ (salt + np.uint64(f))) * odd) >> half
            rows.append(base + ((hashed * size) >> half).astype(np.int64))
        yield use if level else None, node, child, rows


def observe(m: dict, tok: np.ndarray, heads: np.ndarray, ending: np.ndarray, out: np.ndarray) -> None:
    """Add to out how often each child followed each row."""
    places = [r * WAYS + child for _, _, _, child, rows in steps(m, tok, heads, ending) for r in rows]
    if places:
        out += np.bincount(np.concatenate(places), minlength=len(out)).astype(out.dtype)


def weigh(m: dict, seen: np.ndarray) -> dict:
    """The model with weights from the counts of observe: one update of iterative scaling from zero, where a row expects its node's prior."""
    seen = seen.reshape(-1, WAYS)
    weights = np.empty(seen.shape, np.float32)
    node = np.repeat(np.arange(len(m["base"])), m["size"].astype(np.int64))
    for a in range(0, len(seen), CHUNK):
        s = slice(a, a + CHUNK)
        prior = m["prior"][node[s]]
        ratio = np.log((seen[s] + SMOOTH * np.exp(prior)) / (seen[s].sum(axis=1, keepdims=True) + SMOOTH)) - prior
        weights[s] = np.where(m["there"][node[s]], ratio, 0)
    return m | {"weights": weights, "mass": seen.sum(axis=1, dtype=np.float32) + np.float32(SMOOTH)}


def _together(plan, table, strength: np.ndarray) -> dict:
    """The model from its three parts: words and paths (a broadcast), weights (another) and strengths."""
    return plan.value | {"weights": table.value, "strength": strength}


def _parts(m: dict, node: np.ndarray, rows: list[np.ndarray], strength: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(probabilities of all children, weights of each feature)."""
    x = m["prior"].take(node, axis=0)
    own = [m["weights"].take(r, axis=0) for r in rows]
    for w, k in zip(own, strength, strict=True):
        x += w * k
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x, own


def _chances(m: dict, node: np.ndarray, child: np.ndarray, rows: list[np.ndarray], strength: np.ndarray) -> np.ndarray:
    """log10 of the probabilities of the children taken."""
    x, own = m["prior"].take(node, axis=0), np.empty((len(node), WAYS), np.float32)
    for r, k in zip(rows, strength, strict=True):
        np.take(m["weights"], r, axis=0, out=own, mode="clip")  # all rows are there; the mode spares a copy
        own *= k
        x += own
    taken = x[np.arange(len(x)), child]
    np.exp(x, out=own)
    whole = own @ np.ones(WAYS, np.float32)
    if len(x) and not (whole.min() > 1e-30 and whole.max() < 1e30):  # beyond what float32 holds well
        most = x.max(axis=1)
        whole, taken = np.exp(x - most[:, None]).sum(axis=1), taken - most
    return np.maximum((taken - np.log(whole)) * np.float32(1 / np.log(10)), -30)


def run(m: dict, tok: np.ndarray, heads: np.ndarray, ending: np.ndarray, keys: list[np.ndarray] | None = None, slot: np.ndarray | None = None) -> np.ndarray:
    """log10 of the model's probability of each token, without the word's share of its tail class."""
    out = np.zeros(len(tok))
    for first, use, node, child, rows in steps(m, tok, heads, ending, keys, slot):
        log = _chances(m, node, child, rows, m["strength"][0] if use is None else m["strength"][1, : len(BELOW)])
        if use is None:
            out[first : first + len(log)] = log
        else:
            out[first + use] += log
    return out


def slopes(m: dict, tok: np.ndarray, heads: np.ndarray, ending: np.ndarray) -> np.ndarray:
    """Gradient of the log likelihood by strength, and its curvature: (2, 4 + 16), a row for the root and one for all below."""
    out = np.zeros((2, 20))
    for _, use, node, child, rows in steps(m, tok, heads, ending):
        at, k = int(use is not None), len(rows)
        p, own = _parts(m, node, rows, m["strength"][at, :k])
        mean = [np.einsum("ij,ij->i", p, w) for w in own]
        for i in range(k):
            out[at, i] += (own[i][np.arange(len(p)), child] - mean[i]).sum(dtype=float)
            spread = p * own[i]
            for j in range(i, k):
                both = float(np.einsum("ij,ij->", spread, own[j]) - mean[i] @ mean[j])
                out[at, 4 + 4 * i + j] += both
                out[at, 4 + 4 * j + i] += both if i != j else 0.0
    return out


def lean(m: dict, tok: np.ndarray, heads: np.ndarray, ending: np.ndarray, out: np.ndarray) -> None:
    """Add to out, (rows, WAYS), the gradient of the log likelihood by every weight."""
    for _, use, node, child, rows in steps(m, tok, heads, ending):
        strength = m["strength"][0] if use is None else m["strength"][1, : len(BELOW)]
        p = -_parts(m, node, rows, strength)[0]
        p[np.arange(len(p)), child] += 1
        for r, k in zip(rows, strength, strict=True):
            order = np.argsort(r)
            own = r[order]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            out[own[first]] += k * np.add.reduceat(p[order], first, axis=0)


def stepped(m: dict, slope: np.ndarray) -> np.ndarray:
    """Weights after a step along the gradient, each by the curvature that the counted texts let expect, damped where there is little to learn from. Changes m's weights in place."""
    slope, weights = slope.reshape(-1, WAYS), m["weights"]
    node = np.repeat(np.arange(len(m["base"])), m["size"].astype(np.int64))
    for a in range(0, len(weights), CHUNK):
        s = slice(a, a + CHUNK)
        often = m["mass"][s, None] * np.exp(m["prior"][node[s]] + weights[s]) * (FOLDS / (FOLDS - 1))
        weights[s] += np.where(m["there"][node[s]], STEP * slope[s] / (often + DAMP), 0)
    return weights


def updated(strength: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Strengths after a Newton step, held near where they start where there is little to learn from."""
    out = strength.astype(float).copy()
    for at, k in ((0, len(ROOT)), (1, len(BELOW))):
        slope, bend = total[at, :k], total[at, 4:].reshape(4, 4)[:k, :k]
        out[at, :k] += np.linalg.solve(bend + 10.0 * np.eye(k), slope - 10.0 * (out[at, :k] - 0.5))
    return np.clip(out, 0, 1.5).astype(np.float32)


def count(docs: DataFrame) -> DataFrame:
    """(token, ending, n) over all texts: counted per slice, then per partition, then by a shuffle."""

    def partial(batches):
        for batch in batches:
            for _, _, data, offsets in tokens.slices(batch.column("text")):
                tok, _, ending = stream(data, offsets)
                one, at, n = np.unique(tok, return_index=True, return_counts=True)
                yield pa.record_batch([pa.array(one.view(np.int64)), pa.array(ending[at].astype(np.int32)), pa.array(n)], ["token", "ending", "n"])

    made = docs.select("text").mapInArrow(partial, "token long, ending int, n long")
    return made.groupBy("token").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


def _most(counts: DataFrame, most: int) -> int:
    """The smallest count that at most `most` tokens reach, from a histogram of some hundred bins."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    total, lowest = 0, None
    for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("n").alias("least")).orderBy(F.desc("level")).toLocalIterator():
        total += r.n
        if total > most:
            break
        lowest = r.least
    return lowest if lowest is not None else 1 << 62


def _summed(docs: DataFrame, make) -> np.ndarray | None:
    """The sum over all texts of what `make` (slices of tokens -> one flat array) gives for each partition, met block by block."""

    def tell(batches):
        """The array of one partition in blocks; blocks of zeros stay."""
        def cut():
            for batch in batches:
                for _, _, data, offsets in tokens.slices(batch.column("text")):
                    yield stream(data, offsets)

        whole = make(cut())
        for k, a in enumerate(range(0, len(whole), BLOCK)):
            if whole[a : a + BLOCK].any() or k == 0:
                yield pa.record_batch([pa.array([k]), pa.array([len(whole)]), pa.array([whole[a : a + BLOCK].tobytes()], pa.binary())], ["block", "size", "sum"])

    schema = "block long, size long, sum binary"
    kind = np.dtype(getattr(make, "kind", np.float64))

    def add(batches):
        """Running sums of the blocks of one partition; no more is held than one row for each."""
        held: dict[int, list] = {}
        for batch in batches:
            for k, size, raw in zip(*(batch.column(c).to_pylist() for c in ("block", "size", "sum")), strict=True):
                own = np.frombuffer(raw, kind)
                held[k] = [size, held[k][1] + own if k in held else own]
        for k, (size, v) in held.items():
            yield pa.record_batch([pa.array([k]), pa.array([size]), pa.array([v.tobytes()], pa.binary())], ["block", "size", "sum"])

    told = docs.select("text").mapInArrow(tell, schema)
    if docs.rdd.getNumPartitions() > FEW:
        told = told.withColumn("_deal", F.pmod(F.spark_partition_id(), F.lit(FAN))).repartition("block", "_deal").drop("_deal").mapInArrow(add, schema)
    out = None
    for r in told.repartition("block").mapInArrow(add, schema).toLocalIterator():  # one model
        out = np.zeros(r["size"], kind) if out is None else out
        own = np.frombuffer(r["sum"], kind)
        out[r["block"] * BLOCK : r["block"] * BLOCK + len(own)] = own
    return out


def train(docs: DataFrame, m: dict, updates: int = UPDATES):
    """(broadcast of words and paths, broadcast of weights, strengths): weights counted over most texts, strengths fitted over the rest, then all weights moved by gradients over all texts."""
    context = docs.sparkSession.sparkContext
    rows = int(m["size"].sum())
    late = F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == 0
    # All texts in a quarter of the partitions: each sends one array of the table's size.
    every = docs.coalesce(max(2, docs.rdd.getNumPartitions() // 4))
    plan = context.broadcast(m)

    def counted(parts):
        out = np.zeros(rows * WAYS, np.int32)
        for part in parts:
            observe(plan.value, *part, out)
        return out.astype(np.float32)

    counted.kind = np.float32
    seen = _summed(docs.filter(F.coalesce(~late, F.lit(True))), counted)
    model = weigh(m, np.zeros(rows * WAYS, np.float32) if seen is None else seen)
    del seen
    table, strength = context.broadcast(model["weights"]), m["strength"]
    for _ in range(updates):

        def bent(parts, table=table, strength=strength):
            out, now = np.zeros((2, 20)), _together(plan, table, strength)
            for part in parts:
                out += slopes(now, *part)
            return out.ravel()

        total = _summed(docs.filter(late), bent)
        if total is None:
            break
        strength = updated(strength, total.reshape(2, 20))

        def leant(parts, table=table, strength=strength):
            out, now = np.zeros((rows, WAYS), np.float32), _together(plan, table, strength)
            for part in parts:
                lean(now, *part, out)
            return out.ravel()

        leant.kind = np.float32
        model["weights"] = stepped(model, _summed(every, leant))
        table.destroy()
        table = context.broadcast(model["weights"])
    return plan, table, strength


def score(docs: DataFrame, learn_from: DataFrame, updates: int = UPDATES) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = stored(count(learn_from), "counts")
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    limit = _most(counts, HEAD_COUNTS)
    head = counts.filter(F.col("n") >= limit).toArrow()  # HEAD_COUNTS rows at most
    h_tok, h_n, h_end = head.column("token").to_numpy().view(np.uint64), head.column("n").to_numpy(), head.column("ending").to_numpy()
    order = np.argsort(h_tok)
    rare = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    tail_n, tail_v = np.zeros(TAIL), np.zeros(TAIL)
    for r in rare.collect():  # TAIL rows
        tail_n[r.ending], tail_v[r.ending] = r.n, r.v
    plan, table, strength = train(learn_from, new_model(h_tok[order], h_n[order], h_end[order], tail_n, tail_v, whole.n), updates)
    floor = float(np.log10(whole.n + whole.v + 1))

    def scan(batches):
        m = _together(plan, table, strength)
        for batch in batches:
            for row, end, data, offsets in tokens.slices(batch.column("text")):
                tok, heads, ending = stream(data, offsets)
                at, found, slot = find(m, tok)
                logs = np.zeros(len(tok))
                logs[found] = m["logs"][at[found]]
                p = run(m, tok, heads, ending, slot=slot)
                other = slot < 0
                p[other] += logs[other] - m["tail"][ending[other]]
                total = lambda x: np.add.reduceat(x, heads[:-1])  # noqa: E731  each text has its end token
                tail = np.flatnonzero(~found)
                cut = np.searchsorted(tail, heads)
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(tok[tail].view(np.int64)))
                yield pa.record_batch(
                    [batch.column("doc_id").slice(row, end - row), pa.array(np.diff(heads)), pa.array(total(found.astype(np.int64))), pa.array(total(logs)), pa.array(total(p)), lists],
                    ["doc_id", "n_tokens", "known", "logs", "p", "tail"],
                )

    rows = docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, n_tokens long, known long, logs double, p double, tail array<long>")
    rows = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "scores")
    # Words beyond the head: each text's are few, and none is frequent, so no key of this join is hot.
    tail = rows.select("rid", F.explode("tail").alias("token")).join(counts.filter(F.col("n") < limit).select("token", "n"), "token")
    more = tail.groupBy("rid").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("more_logs"))
    joined = rows.drop("tail").join(more, "rid", "left").fillna(0, ["more"]).fillna(0.0, ["more_logs"])
    return joined.select(
        "doc_id", "n_tokens", (F.col("known") + F.col("more")).alias("n_known"), F.lit(int(whole.n)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * floor).alias("base_score"), (F.col("p") + F.col("more_logs")).alias("score"),
    )


def report(docs: DataFrame) -> DataFrame:
    """The digest: learns from documents whose bucket modulo 7 is not 2, scores all."""
    held = bucket(F.col("doc_id"), 7) == 2
    own = docs.select("doc_id", "text")
    return score(own, own.filter(~held)).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
