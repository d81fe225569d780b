import math
import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from kartoteka.operators import audit, matching, state


def walk(pages, clubs):
    left, out = {}, {}
    for i, name, city in sorted(set(clubs)):
        if name:
            left.setdefault(name, []).append((i, city or None))
    for i, name, city in sorted(set(pages)):
        if not name or name not in left:
            out[i] = (None, "no_name_hit")
            continue
        cands = left[name]
        fit = [c for c in cands if city and c[1] == city]
        if len(fit) != 1:
            fit = cands if len(cands) == 1 and (not city or not cands[0][1]) else []
        if fit:
            out[i] = (fit[0][0], "matched")
            cands.remove(fit[0])
        else:
            out[i] = (None, "ambiguous")
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_one_to_one_against_the_walk(spark, seed):
    r = random.Random(seed)
    clubs, pages = [], []
    for g in range(250):  # groups of few clubs, in which every case comes up
        towns = r.choice([["a"], ["a", "b"], ["a", "b", None], ["a", "b", "c", None], ["a", "a", None]])
        clubs += [(len(clubs) + k, f"n{g}", r.choice(towns)) for k in range(r.randint(1, 4))]
        pages += [(r.randrange(10**6), f"n{g}", r.choice([*towns, None, "x"])) for _ in range(r.randint(0, 6))]
    pages = list({p[0]: p for p in pages}.values()) + [(-1, None, "a"), (-2, "", None), (-3, "unknown", "a")]
    clubs += [clubs[0], (10**7, None, "a"), (10**7 + 1, "", "b")]
    frame = lambda rows: spark.createDataFrame(rows, "id long, name string, city string")
    got = {x.page_id: (x.club_id, x.status) for x in matching.one_to_one(frame(pages + pages[:2]), frame(clubs)).collect()}
    assert got == walk(pages, clubs)
    assert matching.one_to_one(frame([]), frame(clubs)).count() == 0 and {x.status for x in matching.one_to_one(frame(pages[:3]), frame([])).collect()} == {"no_name_hit"}


def metres(a, b):
    x, y = (math.radians(v[0]) for v in (a, b))
    h = math.sin((y - x) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(h))


@pytest.mark.parametrize("lat,lng", [(0, 10), (53, 10), (65, 25), (85, -30), (-65, 179.999), (65, -179.9995), (89.999, 0), (-89.9999, 100)])
def test_close_pairs_at_any_latitude(spark, lat, lng):
    r = random.Random(9)
    wide = 0.004 / max(math.cos(math.radians(lat)), 1e-3)
    spots = [(max(-90.0, min(90.0, lat + r.uniform(-0.003, 0.003))), (lng + r.uniform(-wide, wide) + 180) % 360 - 180) for _ in range(90)]
    spots += [(lat, (lng + k * 112 / 111_195 / max(math.cos(math.radians(lat)), 1e-3) + 180) % 360 - 180) for k in range(6)]
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(spots)] + [(900, None, 1.0), (901, 1.0, None)]
    got = {(x.id, x.near_id) for x in matching.close_pairs(spark.createDataFrame(rows, "id long, lat double, lng double"), 120.0).collect()}
    want = {(i, j) for i, j in product(range(len(spots)), repeat=2) if i < j and metres(spots[i], spots[j]) <= 120 - 1e-6}
    assert want <= got and all(metres(spots[i], spots[j]) <= 120.5 for i, j in got) and len(want) > 20


def test_best_person(spark):
    rows = [(1, "Ana", "A", "član", "", 0), (1, "Iva", "B", "zamjenik predsjednika", None, 1), (1, "Eva", "C", None, "predsjednik", 2), (1, "Ivo", "D", "LIKVIDATOR", "predsjednik", 3), (2, " ", None, "predsjednik", "", 4), (3, "Jan", "E", "osoba ovlaštena", "", 6), (3, "Jon", "F", "OSOBA OVLASTENA", "", 5), (None, "N", "N", None, None, 7)]
    got = matching.best_person(spark.createDataFrame(rows, "udr_id long, first_name string, last_name string, capacity string, role string, at int"), F.col("at")).collect()
    assert {tuple(r) for r in got} == {(1, "Iva", "B", 0), (3, "Jon", "F", 1), (None, "N", "N", 99)}


def test_margin(spark):
    rows = [(1, 1, 2.0), (1, 2, 1.5), (2, 1, 2.0), (2, 2, 1.6), (3, 1, 0.3), (4, 9, 0.5)]
    got = {tuple(r) for r in matching.margin_match(spark.createDataFrame(rows, "l_id int, r_id int, score double")).collect()}
    assert got == {(1, 1, "matched"), (2, None, "ambiguous"), (3, None, "unmatched"), (4, 9, "matched")}


def test_upsert_by_external_id(spark):
    old = spark.createDataFrame([(1, "x", "One", "k"), (2, None, "Two", "k"), (5, "y", "Five", "k"), (7, "y", "Twin", "k")], "id int, ext string, name string, kept string")
    new = spark.createDataFrame([("z", "Z1", 0), ("y", "Y", 1), (None, "N", 2), ("z", "Z2", 3), (None, "N", 4), ("x", None, 5)], "ext string, name string, at int")
    got = sorted((tuple(r) for r in state.upsert_external(old, new.select("ext", "name", "at"), "ext", F.col("at")).select("id", "ext", "name", "kept").collect()), key=lambda r: r[0])
    assert got == [(1, "x", None, "k"), (2, None, "Two", "k"), (5, "y", "Y", "k"), (7, "y", "Twin", "k"), (8, "z", "Z2", None), (9, None, "N", None), (10, None, "N", None)]
    assert state.upsert_external(old.limit(0), new, "ext", F.col("at")).count() == 5


def test_rescaled():
    sizes = {1: 2, 2: 2, 3: 3, 4: 8}
    assert audit.rescaled(sizes, 15) == sizes and audit.rescaled(sizes, 3) == {1: 1, 2: 1, 3: 1, 4: 2} and sum(audit.rescaled(sizes, 150).values()) == 150
