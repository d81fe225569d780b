import colorsys
import itertools
import json
import re
import unicodedata

from pyspark.sql import functions as F

from kartoteka.functions import colour, markup, text
from kartoteka.operators import coverage, state
from kartoteka.operators.shared import versions
from kartoteka.sources import landing, snapshots


def test_marks_go_as_by_decomposition(spark):
    blocks = (range(0x20, 0x300), range(0x370, 0x530), range(0x1E00, 0x2190), range(0x2460, 0x24EB), range(0x3200, 0x3400), range(0xFB00, 0xFB07))
    seen = [chr(i) for b in blocks for i in b if unicodedata.category(chr(i)) != "Cn" and chr(i) not in "đĐ"]
    seen += ["½ kg", "Œuvre ﬁn", "ǆ i Ĳ", "été…", "№ 5 ™", "", "a b"]
    found = spark.createDataFrame([(x,) for x in seen], "x string").select("x", text.strip_marks(F.col("x")).alias("y")).collect()
    plain = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    assert [(r.x, r.y) for r in found if r.y != plain(r.x)] == []
    assert spark.range(1).select(text.strip_marks(F.lit("Đuro đak ½")), text.strip_marks(F.lit(None).cast("string"))).first()[:] == ("Duro dak 1⁄2", None)


def test_like_lists(spark):
    df = spark.createDataFrame([("https://Poslovna.hr/x",), ("a_b",), ("axb",), ("",), (None,), ("100%",)], "x string")
    hits = lambda *p: [r[0] for r in df.select(text.any_like(F.col("x"), p)).collect()]
    assert hits("%poslovna.hr%", "A\\_b") == [True, True, False, False, False, False]
    assert hits("a_b", "%\\%") == [False, True, True, False, False, True]
    assert hits() == [False] * 6


def test_same_place(spark):
    pairs = [("Bjelovar", "Bjelovarsko-bilogorska"), ("Zabok", "Krapinsko-zagorska"), ("Pula", "pula"), (None, "Pula"), ("", ""), ("grad Zagreb", "Zagrebačka")]
    df = spark.createDataFrame(pairs, "a string, b string").select(text.same_place(F.col("a"), F.col("b")))
    assert [r[0] for r in df.collect()] == [True, False, True, False, False, True]


def dark(rgb):
    def lum(c):
        x = [v / 255 / 12.92 if v / 255 <= 0.04045 else ((v / 255 + 0.055) / 1.055) ** 2.4 for v in c]
        return 0.2126 * x[0] + 0.7152 * x[1] + 0.0722 * x[2]

    if lum(rgb) < 0.6:
        return rgb
    h, _, s = colorsys.rgb_to_hls(*[v / 255 for v in rgb])
    for light in (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15):
        out = tuple(round(v * 255) for v in colorsys.hls_to_rgb(h, light, s))
        if lum(out) < 0.6:
            break
    return out


def test_dark_colours(spark):
    every = list(itertools.product((0, 1, 77, 128, 200, 254, 255), repeat=3))
    r, g, b = map(F.col, "rgb")
    found = spark.createDataFrame(every, "r int, g int, b int").select("r", "g", "b", colour.ensure_dark(r, g, b).alias("d")).collect()
    # Halves of a step (0.9 * 255) may fall to either side.
    assert len(found) == len(every) and all(abs(x - y) <= 1 for f in found for x, y in zip(f.d, dark((f.r, f.g, f.b)), strict=True))
    assert sum(tuple(f.d) != dark((f.r, f.g, f.b)) for f in found) <= 3


def test_contact_blocks_and_json_lists(spark):
    md = "# T\n## Contact info\nTel 1\n### more\n2\n## Websites and social links\nx.hr\n## End\n"
    pages = [md, "## Website\nx\n", "##Contact info", "none", ""]
    block = lambda heading, m: (f := re.search(rf"##\s*{heading}(.*?)(?=\n##\s|\Z)", m, re.S)) and f[1] or None
    found = spark.createDataFrame([(m,) for m in [*pages, None]], "m string").select(markup.contact_blocks(F.col("m")).alias("b")).collect()
    assert [tuple(r.b) for r in found] == [(block("Contact info", m), block(r"Websites?\s*(?:and social[^\n]*)?", m)) for m in pages] + [(None, None)]
    lists = spark.createDataFrame([('["b","a"]', '["a","č"]'), (None, '["x",null]'), ("{", "[]"), ("", None)], "a string, b string").select(markup.merged_json_lists(F.col("a"), F.col("b")))
    assert [json.loads(r[0]) for r in lists.collect()] == [["a", "b", "č"], ["x"], [], []]


def test_scopes(spark):
    todo = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, "b"), (None, None)], "id int, city string")
    done = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    ids = lambda **k: sorted((r.id for r in state.scoped(todo, "id", **k).collect()), key=lambda x: (x is None, x))
    assert ids(done=done) == [2, 4, None]
    assert ids(done=done, refresh=True, only=[1, 2]) == [1, 2]
    assert ids(missing=("city",)) == [2, 3, None]
    assert ids(done=done.limit(0), only=[1, 4], limit=1) == [1]


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "`a.b` int, place string")
    want = [("t", 1, "a.b", 1), ("t", 2, "place", 0)]
    assert sorted(map(tuple, coverage.profile(df, "t").collect())) == want
    assert [r.filled for r in coverage.profile(df.limit(0), "t").collect()] == [0, 0]


def test_rebuild_leaves_one_version(spark, tmp_path):
    base = str(tmp_path / "index")
    for n in (5, 2, 0):
        assert snapshots.rebuild(spark.range(n), base).count() == n
    assert len(versions(spark, base)) == 1
    # A run that broke off is no version; the next run goes on from the last that is whole.
    (tmp_path / "index" / "v=0000000009").mkdir()
    assert snapshots.rebuild(spark.range(3), base).count() == 3 and len(versions(spark, base)) == 1


def test_grounds(spark, tmp_path):
    at = {"lat": 45.0, "lon": 16.0}
    rows = [
        ("way", 1, {"center": at}, {"leisure": "stadium", "capacity": "5000"}), ("way", 2, {"center": at}, {"leisure": "pitch", "sport": "tennis"}), ("way", 3, at, {"leisure": "pitch", "sport": "soccer;tennis", "capacity": "7"}),
        ("way", 4, {}, {"leisure": "stadium"}), ("node", 1, at, {"leisure": "stadium", "capacity": "many"}), ("way", 5, at, {"sport": "soccer"}), ("way", 1, {"center": at}, {"leisure": "stadium", "capacity": "5000"}),
    ]
    (tmp_path / "x.json").write_text(json.dumps({"elements": [{"type": t, "id": i, **p, "tags": g} for t, i, p, g in rows]}))
    found = sorted((r.osm_type, r.osm_id, r.kind, r.capacity, r.lat) for r in landing.grounds(landing.features(spark, str(tmp_path))).collect())
    assert found == [("node", 1, "stadium", None, 45.0), ("way", 1, "stadium", 5000, 45.0), ("way", 3, "pitch", None, 45.0)]


def test_constant_reaches_the_scan(spark):
    from kartoteka.plans import registry

    plan = registry.QUERIES["j03_constant_side"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_orderpriority,1-URGENT\)", plan)


def test_csv_dump_keeps_every_text(spark, tmp_path):
    from oracle import connect, differences

    from kartoteka.plans import registry

    odd = [None, "", " ", " lead", "trail\t", "a\r\nb", "a\rb", "\n", "\r", '"', 'a"b', '",', "\\", "a\\", '\\"', "\\N", "\\\\N", "#c", "﻿x", "a\x00b", "null", "\x85", "🎉x" * 20000]
    docs = [(i * 4 + j, t, s) for i, t in enumerate(odd) for j, s in enumerate(("s", None, "", " x\r\n"))] + [(None, "n", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    name = "s11_csv_dump"
    assert not differences(spark, connect(tmp_path), tmp_path, registry.QUERIES[name], registry.ORACLES[name])
