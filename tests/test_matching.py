import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from kartoteka.functions import fuzzy
from kartoteka.operators import blocking, matching


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if x == y else max(last[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial(a, b):
    if a == b:
        return 100.0
    if not a or not b:
        return 0.0
    ways = [(a, b), (b, a)] if len(a) == len(b) else [tuple(sorted((a, b), key=len))]
    return max(ratio(s, t[max(i, 0) : i + len(s)]) for s, t in ways for i in range(1 - len(s), len(t)))


def token_set(a, b):
    p, q = set(a.split()), set(b.split())
    if not p or not q:
        return 0.0
    if p & q and (p <= q or q <= p):
        return 100.0
    both, x, y = (" ".join(sorted(s)) for s in (p & q, p - q, q - p))
    gap = 1 if both else 0
    n, m = len(both) + gap + len(x), len(both) + gap + len(y)
    edits = lambda u, v: len(u) + len(v) - 2 * lcs(u, v)
    best = 100 * (1 - edits(x, y) / (n + m))
    if both:
        best = max(best, *(100 * (1 - (1 + len(z)) / (len(both) * 2 + 1 + len(z))) for z in (x, y)))
    return best


def weighted(a, b):
    if not a or not b:
        return 0.0
    longer, sa, sb = max(len(a), len(b)) / min(len(a), len(b)), " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    if longer < 1.5:
        return max(ratio(a, b), 0.95 * max(ratio(sa, sb), token_set(a, b)))
    scale, p, q = 0.9 if longer <= 8 else 0.6, set(a.split()), set(b.split())
    words = 0.0 if not p or not q else 100.0 if p & q else max(partial(sa, sb), partial(" ".join(sorted(p - q)), " ".join(sorted(q - p))))
    return max(ratio(a, b), scale * partial(a, b), scale * 0.95 * words)


def names(n, seed, letters="abcdč ", most=14):
    r = random.Random(seed)
    return ["".join(r.choices(letters, k=r.randint(0, most))).strip() for _ in range(n)]


def test_scores_against_quadratic_versions():
    xs = [*names(60, 1), *names(10, 2, most=90), "nk a b", "", "đ" * 64, "x" * 65, "a" * 64 + "b", "😀a"]
    pairs = [*product(xs[:25], xs[20:45]), *zip(xs, xs[::-1], strict=True), *product(xs[60:], xs[55:])]
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    for own, plain in ((fuzzy.ratios, ratio), (fuzzy.partial_ratios, partial), (fuzzy.token_set_ratios, token_set), (fuzzy.weighted_ratios, weighted)):
        np.testing.assert_allclose(own(a, b), [plain(*p) for p in pairs], atol=1e-9, err_msg=str(plain))


def test_score_columns(spark):
    got = spark.createDataFrame([("nk sloga", "sloga"), (None, "x"), (None, None), ("", "")], "a string, b string").select(fuzzy.ratio("a", "b"), fuzzy.partial_ratio("a", "b"), fuzzy.token_set_ratio("a", "b"), fuzzy.weighted_ratio("a", "b")).collect()
    assert [tuple(round(v, 3) for v in r) for r in got] == [tuple(round(f(a, b), 3) for f in (ratio, partial, token_set, weighted)) for a, b in (("nk sloga", "sloga"), ("", "x"), ("", ""), ("", ""))]


def test_no_pair_of_a_high_partial_ratio_is_missed(spark):
    words = [f"{a}{b}" for a in ("slo", "haj", "din", "rije") for b in ("ga", "duk", "amo", "ka")]
    r = random.Random(4)

    def typo(w):
        i = r.randrange(len(w) + 1)
        return r.choice([w, w, w[:i] + r.choice("xyz") + w[i:], w[:i] + w[i + 1 :], w[1:]])

    left = [(i, " ".join(typo(w) for w in r.choices(words, k=r.randint(1, 3)))) for i in range(90)] + [(900, "ab"), (901, "a"), (902, "abc"), (903, None), (904, ""), (90, "sloga")]
    right = [(i, " ".join(r.choices(words, k=r.randint(1, 4)))) for i in range(90)] + [(900, "ba cab"), (901, "xa"), (902, "ac"), (903, None), (904, "")]
    frame = lambda rows: spark.createDataFrame(rows, "id long, name string")
    got = {(x.l_id, x.r_id): x.score for x in blocking.partial_pairs(frame(left), frame(right)).collect()}
    want = {(i, j): partial(a, b) for (i, a), (j, b) in product(left, right) if a and b and partial(a, b) >= 80 - 1e-9}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())


def test_contained_pairs(spark):
    frame = lambda c, xs: spark.createDataFrame([(x,) for x in xs], f"{c} string")
    a, b = ["zagreb", "split", "sveti kriz", "", None, "zagreb"], ["zagreb", "novi zagreb", "kriz", "spli", "", None]
    got = {tuple(r) for r in blocking.contained_pairs(frame("a", a), frame("b", b)).collect()}
    assert got == {(x, y) for x, y in product(a, b) if x and y and (x in y or y in x)}


def football(n, seed):
    """Clubs and registry rows of 16 words, some named after their city, some of generic words."""
    r = random.Random(seed)
    words = [f"rijec{i}" for i in range(16)]
    cities = [("Zagreb", "Grad Zagreb"), ("Novi Zagreb", "Zagrebačka županija"), ("Split", "Splitsko-dalmatinska županija"), ("Osijek", "Osječko-baranjska županija")]
    status = ["AKTIVAN", "BRISAN", "PRESTANAK DJELOVANJA", None]

    def row(i, prefix, numbered):
        city, county = r.choice(cities)
        name = r.choice([" ".join(r.sample(words, r.randint(1, 3))), city, r.choice(words), "klub", "Sportski"])
        name += f" mat{r.randint(1, 30)}" if numbered and r.random() < 0.5 else ""
        return i, prefix + name, r.choice([city, None, city]), r.choice([county, None, county])

    clubs = [row(i, r.choice(["NK ", "HNK ", "", "N.K. "]), True) for i in range(n)] + [(n, None, None, None), (n + 1, "", "Split", "")]
    registry = [(i, name, f"Ulica {i}, 10000 {city or ''}", county, r.choice(status)) for i, name, city, county in (row(i, "Nogometni klub ", True) for i in range(n))]
    return clubs, registry + [(n, None, None, None, None)]


@pytest.mark.parametrize("score", [matching.edit_score, matching.weighted_score])
def test_match_against_all_pairs(spark, score):
    clubs, registry = football(150, 7)
    c, g = spark.createDataFrame(clubs, "id long, name string, city string, county string"), spark.createDataFrame(registry, "id long, naziv string, seat string, county string, status string")
    a, b = matching.prepared_clubs(c), matching.prepared_registry(g)
    every = a.crossJoin(b).withColumn("score", F.round(score(), 6)).collect()
    want = {}
    for r in every:
        fits = not r.l_county or not r.r_county or r.l_county == r.r_county
        clean, words = set(r.r_clean), set(r.l_words)
        shared = set(r.l_city_words if r.l_city_only else r.l_words) & set(r.r_words) or partial(r.l_short, r.r_short) >= 80 and r.l_short and r.r_short
        told = not clean - set(r.l_city_words) if r.l_city_only else set(r.l_distinct) & clean
        if fits and shared and told:
            city = bool(r.l_place) and bool(r.r_place) and (r.l_place in r.r_place or r.r_place in r.l_place)
            overlap = len((words if r.l_city_only else set(r.l_distinct)) & clean)
            want.setdefault(r.l_id, []).append((-int(city), -overlap, -r.r_rank, -r.score, r.r_id))
    want = {k: [x[4] for x in sorted(v)[:5]] for k, v in want.items()}
    got = {}
    for r in sorted(matching.registry_match(c, g, 5, score).collect(), key=lambda r: r.place):
        got.setdefault(r.id, []).append(r.registry_id)
    assert got == want


def test_pairs_of_sixteen_words_do_not_grow_with_the_square(spark):
    def made(n):
        clubs, registry = football(n, 3)
        a = matching.prepared_clubs(spark.createDataFrame(clubs, "id long, name string, city string, county string")).filter("not l_city_only and size(l_distinct) >= 3 and l_county <> ''")
        b = matching.prepared_registry(spark.createDataFrame(registry, "id long, naziv string, seat string, county string, status string"))
        return matching.registry_pairs(a, b, 5).count() / a.count()

    assert made(1200) < 2.5 * made(300)


def noted(monkeypatch):
    """Rows of the tables that matching stores, by name."""
    seen, put = {}, matching.stored

    def kept(df, name):
        out = put(df, name)
        seen.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(matching, "stored", kept)
    return seen


def test_copies_of_clubs_and_registry_rows_are_matched_once(spark, monkeypatch):
    clubs, registry = football(60, 5)
    shift = lambda rows, n: [(r[0] + 1000 * k, *r[1:]) for k in range(n) for r in rows]
    frames = lambda n: (spark.createDataFrame(shift(clubs, n), "id long, name string, city string, county string"), spark.createDataFrame(shift(registry, n), "id long, naziv string, seat string, county string, status string"))
    once = {}
    for r in matching.registry_match(*frames(1), 60).collect():
        once.setdefault(r.id, []).append((-r.city, -r.overlap, -r.status, -r.score, r.registry_id))
    seen = noted(monkeypatch)
    got = {}
    for r in sorted(matching.registry_match(*frames(6), 5).collect(), key=lambda r: r.place):
        got.setdefault(r.id, []).append(r.registry_id)
    want = {i: [x[4] for x in sorted((*x[:4], x[4] + 1000 * k) for x in rows for k in range(6))[:5]] for i, rows in once.items()}
    assert got == {i + 1000 * k: v for i, v in want.items() for k in range(6)}
    assert seen["profiles"][0] <= 62 and seen["forms"][0] <= 62 and seen["registry_kinds"][0] <= 61


def test_one_partner_by_rare_words(spark, monkeypatch):
    r = random.Random(3)
    row = lambda i: (i, r.choice(["x", "y", None]), r.choice([None, [], r.sample("abcdefg", r.randint(1, 5)), r.sample("abc", 2)]))
    left, right = [row(i) for i in range(150)], [row(i) for i in range(40)]
    left += [(1000 + i, "z", ["q", "r"]) for i in range(300)]
    right += [(1000, "z", ["q"]), *[(2000 + i, "z", ["s", "t"]) for i in range(300)]]
    fits = lambda a, b: a[1] and a[1] == b[1] and set(a[2] or []) & set(b[2] or []) and (set(a[2]) <= set(b[2]) or set(b[2]) <= set(a[2]))
    met = {a[0]: [b[0] for b in right if fits(a, b)] for a in left}
    seen = noted(monkeypatch)
    frame = lambda rows: spark.createDataFrame(rows, "id long, city string, words array<string>")
    assert {tuple(x) for x in matching.unique_by_city(frame(left), frame(right)).collect()} == {(i, v[0]) for i, v in met.items() if len(v) == 1}
    assert seen["kinds"][0] < 150 and seen["kinds"][1] < 45


def test_points_of_one_place_are_measured_once(spark, monkeypatch):
    r = random.Random(5)
    spots = [(45 + r.randrange(4) * 0.0007, 16 + r.randrange(3) * 0.0009) for _ in range(60)]
    rows = [(i, *spots[i]) for i in r.sample(range(60), 60)] + [(70, None, 16.0), (71, 45.0, None), (72, 0.0, -180.0), (73, -0.0, 180.0)]
    seen = noted(monkeypatch)
    frame = lambda rows: spark.createDataFrame(rows, "id long, lat double, lng double")
    got = sorted((x.id, x.near_id, round(x.metres, 3)) for x in matching.close_pairs(frame(rows), 120.0).collect())
    far = frame(rows[:60]).alias("a").crossJoin(frame(rows[:60]).alias("b")).filter("a.id < b.id").select(F.col("a.id"), F.col("b.id"), F.round(matching.place.haversine_m(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng")), 3))
    assert got == sorted([*(tuple(x) for x in far.collect() if x[2] <= 120), (72, 73, 0.0)])
    assert seen["near_places"][0] < 150
