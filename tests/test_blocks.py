import duckdb
import pytest
from pyspark.sql import functions as F

from kartoteka.operators import graph, resolve

FOLDER = "/root/testdata/sf0.001"


def test_reach_goes_to_the_fixpoint(spark):
    edges = spark.range(52).selectExpr("id as src", "id + 1 as dst").coalesce(1).cache()
    start = spark.range(1).selectExpr("id as node")
    assert sorted(r.node for r in graph.reach(edges, start).collect()) == list(range(53))
    with pytest.raises(RuntimeError):
        graph.reach(edges, start, most=3)


def test_reach_over_all_line_items(spark):
    pairs = duckdb.sql(f"select distinct l_suppkey, l_partkey from '{FOLDER}/lineitem.parquet'").fetchall()
    near = {}
    for s, p in pairs:
        near.setdefault(f"s{s}", set()).add(f"p{p}")
        near.setdefault(f"p{p}", set()).add(f"s{s}")
    seen, todo = {"s1"}, ["s1"]
    while todo:
        todo = [n for n in {m for x in todo for m in near[x]} if n not in seen]
        seen.update(todo)
    e = spark.createDataFrame([(a, b) for a, bs in near.items() for b in bs], "src string, dst string")
    got = graph.reach(e, spark.createDataFrame([("s1",)], "node string")).collect()
    assert len(got) == len(seen) and {r.node for r in got} == seen


@pytest.mark.parametrize("block", [1, 3, 10000])
def test_candidates_of_hot_keys(spark, monkeypatch, block):
    monkeypatch.setattr(resolve, "BLOCK", block)
    rows = [(i, ["hot", f"w{i % 5}", f"w{i % 3}"][i % 2 :], "x" if i % 4 else None) for i in range(24)] + [(90, [], "x"), (91, None, "x"), (92, ["hot", None, "hot"], None)]
    left, right = rows[::2] + rows[-2:], rows[1::2]
    frame = lambda r: spark.createDataFrame(r, "id long, words array<string>, city string")
    share = lambda a, b: {w for w in a[1] or [] if w} & {w for w in b[1] or [] if w}
    want = sorted((a[0], b[0]) for a in left for b in right if share(a, b) or (a[2] and a[2] == b[2]))
    assert sorted(tuple(r) for r in resolve.candidates(frame(left), frame(right)).select("l_id", "r_id").collect()) == want
    near = sorted((a[0], b[0]) for a in left for b in right if len(share(a, b)) > 1)
    keep = F.size(F.array_intersect(F.array_compact("l_words"), F.array_compact("r_words"))) > 1
    assert sorted(tuple(r) for r in resolve.candidates(frame(left), frame(right), keep).select("l_id", "r_id").collect()) == near


@pytest.mark.parametrize("most_m", [500.0, 10_000.0, 80_000.0])
def test_nearest_at_any_radius(spark, most_m):
    import math
    import random

    r = random.Random(4)
    spots = lambda n, at: [(at + i, r.uniform(42, 46.6), r.uniform(13.4, 19.5)) for i in range(n)]
    points, targets = spots(120, 0), spots(60, 1000)
    points += [(500, targets[0][1] + 0.0003, targets[0][2]), (501, 45.0, 16.0)]

    def metres(a, b):
        x = math.sin(math.radians(b[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6371000.0 * math.asin(math.sqrt(x))

    want = {p[0]: min((metres(p, t), t[0]) for t in targets)[1] for p in points if min(metres(p, t) for t in targets) <= most_m}
    frame = lambda rows: spark.createDataFrame(rows, "id long, lat double, lng double")
    assert {x.id: x.target_id for x in resolve.nearest(frame(points), frame(targets), most_m).collect()} == want


def test_reach_over_a_long_chain(spark):
    edges = spark.range(80).selectExpr("id as src", "id + 1 as dst")
    assert graph.reach(edges, spark.range(1).selectExpr("id as node")).count() == 81


def test_equal_rows_are_judged_once(spark):
    frame = lambda r: spark.createDataFrame(r, "id long, words array<string>, city string")
    kind = lambda i: (["a b", "a c", "d", "a d e"][i % 4].split(), "xy"[i % 3 > 0]) if i % 7 else ([], None)
    right = [(i, *kind(i)) for i in range(60)]
    left = right[::5]

    def score(a, b):
        shared = set(a[1]) & set(b[1])
        return len(shared) + 0.5 * (a[2] == b[2]) + 0.5 * (set(a[1]) <= set(b[1])) + 0.5 * (set(b[1]) <= set(a[1])) if shared else 0

    pairs = [(a[0], b[0], score(a, b)) for a in left for b in right if a[0] != b[0] and score(a, b)]
    overlap = F.arrays_overlap("l_words", "r_words")
    got = resolve.candidates(frame(left), frame(right), overlap, apart=True, score=resolve.overlap_score())
    assert sorted(tuple(r) for r in got.collect()) == sorted(pairs)
    two = sorted(p for a in left for p in sorted((p for p in pairs if p[0] == a[0]), key=lambda p: (-p[2], p[1]))[:2])
    assert sorted(tuple(r) for r in resolve.best_two(frame(left), frame(right), overlap, resolve.overlap_score()).collect()) == two
    # 400 million pairs of rows, four of kinds.
    many = spark.range(20_000).select("id", F.array(F.lit("hot"), (F.col("id") % 2).cast("string")).alias("words"), F.lit("x").alias("city"))
    best = resolve.best_two(many, many, overlap, resolve.overlap_score())
    got = sorted((r.l_id, r.r_id, r.score) for r in best.filter("l_id in (0, 1, 2, 5)").collect())
    assert got == [(0, 2, 3.5), (0, 4, 3.5), (1, 3, 3.5), (1, 5, 3.5), (2, 0, 3.5), (2, 4, 3.5), (5, 1, 3.5), (5, 3, 3.5)]
