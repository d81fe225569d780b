import random

import numpy as np

from kartoteka.llm import langid as g

SCHEMA = "doc_id long, text string, lang string, score int"


def test_gradients_match_differences():
    net = g.new_network(["a", "b", "c"], hidden=3)
    net = {k: v.astype(np.float64) if k != "languages" else v for k, v in net.items()}
    r = np.random.default_rng(1)
    x, label = r.integers(97, 103, (7, 4)), np.array([0, 1, 2, 1])
    weight = (r.random((7, 4)) > 0.2).astype(np.float64)
    _, grads = g.gradients(net, x, weight, label)
    for k in grads:
        for _ in range(5):
            at = tuple(r.integers(0, n) for n in net[k].shape)
            if k.startswith("in"):
                at = (int(r.integers(97, 103)), at[1])
            old, eps = net[k][at], 1e-3
            net[k][at] = old + eps
            up, _ = g.gradients(net, x, weight, label)
            net[k][at] = old - eps
            down, _ = g.gradients(net, x, weight, label)
            net[k][at] = old
            assert abs((up - down) / (2 * eps) - grads[k][at]) < 2e-3, k


def test_every_byte_is_owned_once():
    sizes = [0, 1, 63, 64, 65, 200, 128]
    offsets = np.r_[0, np.cumsum(sizes)]
    data = np.arange(offsets[-1], dtype=np.uint64).astype(np.uint8)
    starts, own, text = g.segments(data, offsets)
    x, w = g.cut(data, starts, own, offsets[text + 1])
    for i, n in enumerate(sizes):
        assert w[:, text == i].sum() == n
        owned = np.concatenate([x[w[:, k] > 0, k] for k in np.flatnonzero(text == i)] or [[]])
        assert owned.tolist() == data[offsets[i] : offsets[i + 1]].tolist()


def test_learns_and_handles_odd_rows(spark):
    r = random.Random(2)
    words = {"en": "the and thing heer ing with of".split(), "fr": "le élle èque tion une pas".split(), "de": "der ung schön heit über und".split()}
    rows = [(i, " ".join(r.choice(words[x]) for _ in range(r.randrange(3, 60))), x, 0) for i in range(600) for x in [r.choice(list(words))]]
    odd = [(9001, None, "en", 0), (9002, "", None, 0), (9003, "12 34 !!", "fr", 0), (9004, "der ung über " * 4000, None, 0), (None, "le tion une pas", None, 0), (9004, "der ung über " * 4000, None, 0)]
    got = g.report(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    assert len(got) == 606
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (9001, 9002, 9003, 9004, None)] == ["und", "und", "und", "de", "fr"]
    held = [x for x in rows if by[x[0]].held_out]
    assert 100 < len(held) and sum(by[i].lang_pred == x for i, _, x, _ in held) > 0.95 * len(held)
    assert all(0 <= x.score <= 1 for x in got)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, "some text", None, 0)], SCHEMA)
    assert g.report(none).collect()[0].lang_pred == "und"
    assert g.report(none.limit(0)).count() == 0


def test_only_letters_count():
    assert not any(map(g.has_letter, [None, "", "12 34", "\u00b2 \u00bd \u2460 \u2167 _ !", "\u0301"])) and all(map(g.has_letter, ["a", "\u00b2\u00e9", "\u6f22", "\u02b0"]))


def test_a_repeated_text_is_learned_from_once(spark):
    rows = [(i, "the same text", "en", 0) for i in range(3000)] + [(9000 + i, f"other text {i}", "en", 0) for i in range(50)]
    assert len(g.sample(spark.createDataFrame(rows, SCHEMA), 40)) == 40
    assert ("the same text", "en") in g.sample(spark.createDataFrame(rows, SCHEMA), 400)
