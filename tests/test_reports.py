"""Reports, dumps and cached searches on small rows, against plain Python."""

import hashlib
import json
import re
from urllib.parse import quote

from pyspark.sql import functions as F

from kartoteka.functions import clubs
from kartoteka.operators import matching, reports, resolve
from kartoteka.sources import landing, payloads, snapshots


def files(path, end):
    return [p.read_text() for p in sorted(path.rglob(f"part-*{end}"))]


ENTITY = "id int, canonical_name string, city string, email string, registry_naziv string, semafor_url string"


def test_collision_rows_and_summary(spark, tmp_path):
    rows = [(1, "NK Iskra", 'Bu"je', "a@iskra.hr", None, "x"), (2, "NK Mladost (B)", None, "A@iskra.hr", None, None), (3, "NK Sloga", "Pula", "s@s.hr", None, None), (4, "X", None, None, None, None)]
    e = spark.createDataFrame(rows, ENTITY)
    judged = resolve.detect(e)
    found = reports.collision_rows(judged, e, ["canonical_name", "city"])
    assert [(r.group_key, r.id, r.city, r.verdict) for r in found.orderBy("id").collect()] == [("email:a@iskra.hr", 1, 'Bu"je', "owner"), ("email:a@iskra.hr", 2, "", "orphan")]
    assert all(sum(map(int, re.findall(r"\+(\d)", r.reasons))) == r.score for r in found.collect())
    reports.write_collisions(found, str(tmp_path / "rows"))
    back = landing.dump(spark, str(tmp_path / "rows"))
    assert [(r.id, r.city, r.verdict) for r in back.collect()] == [("1", 'Bu"je', "owner"), ("2", None, "orphan")]
    (one,) = reports.collision_summary(judged, e).collect()
    assert (one.clubs_total, one.groups_total, one.rows, one.clubs_with_any_orphan) == (4, 1, 2, 1)
    assert json.loads(one.by_field) == {"email": {"groups": 1, "owner": 1, "orphan": 1, "ambiguous": 0, "clubs_losing_value": 1}}
    (none,) = reports.collision_summary(judged.limit(0), e.limit(0)).collect()
    assert (none.clubs_total, none.groups_total, none.rows, none.by_field) == (0, 0, 0, "{}")


def test_cohort_reason_is_named(spark):
    rows = [(i, n, "Buje", "a@iskra.hr", None, None, f"Ulica {i // 3}") for i, n in ((1, "NK Iskra"), (2, "NK Mladost (B)"))]
    found = resolve.detect(spark.createDataFrame(rows, ENTITY + ", address string")).collect()
    assert {(r.field, r.id): "same members" in r.reasons for r in found} == {("address", 1): False, ("address", 2): False, ("email", 1): False, ("email", 2): False}
    assert all(sum(map(int, re.findall(r"\+(\d)", r.reasons))) == r.score for r in found)


def test_prompts_and_meta(spark):
    rows = [("b", "B", 2, "Pula", 0, 0.0, None), ("a", "A", 1, "", 120, 45.5, "T1: L (2025)"), ("c", "C", 3, None, None, -0.5, "")]
    sample = reports.batched(spark.createDataFrame(rows, "slug string, canonical_name string, tier int, city string, stadium_capacity int, lat double, leagues string"), 2, F.col("slug"))
    found = {r.batch: r.prompt for r in reports.prompts(sample, "I", "leagues").collect()}
    assert found == {
        "A": "I\n\n== CLUBS TO VERIFY ==\n\nCLUB: A (slug=a, tier=1)\n  stadium_capacity: 120\n  lat: 45.5\n  leagues: T1: L (2025)\n\nCLUB: C (slug=c, tier=3)\n  lat: -0.5\n",
        "B": "I\n\n== CLUBS TO VERIFY ==\n\nCLUB: B (slug=b, tier=2)\n  city: Pula\n",
    }
    meta = json.loads(reports.sample_meta(sample, 7, {1: 2, 3: 1}, 2).first().meta)
    assert meta == {"seed": 7, "strata": [[1, 2], [3, 1]], "batches": 2, "clubs": [{"slug": s, "tier": t, "batch": b} for s, t, b in (("a", 1, "A"), ("b", 2, "B"), ("c", 3, "A"))]}


def test_report_lines(spark):
    sample = spark.createDataFrame([("a", 1)], "slug string, tier int")
    results = spark.createDataFrame([("a", 0.5, "phone", 1.0, None), ("z", 1.0, None, 0.5, None)], "slug string, overall double, issues string, identity double, contact double")
    lines = [r.line for r in reports.report_lines(results, sample, ["identity", "contact"], "2025-01-01").orderBy("part", "rank", "slug").collect()]
    assert "Sample size: **2**" in lines[0] and "reliability: 75.0 / 100" in lines[0]
    assert lines[1:] == ["| identity | 75.0 | ★★★★★★★★ |", "| contact | n/a | — |", "| z | T? | 1.00 | — |", "| a | T1 | 0.50 | phone |"]
    none = [r.line for r in reports.report_lines(results.limit(0), sample, ["identity", "contact"], "2025-01-01").orderBy("part", "rank", "slug").collect()]
    assert "reliability: n/a / 100" in none[0] and len(none) == 1


def test_sitemap_files(spark, tmp_path):
    names = ["Grad Zagreb", "a/b~c*d+e", "Čakovec", "x-y_z.0"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(snapshots.path_part(F.col("n"))).collect()] == [quote(n) for n in names]
    pages = spark.createDataFrame([("/b?x=1&y=<2>", "0.5", "yearly"), ("/a", "1.0", "weekly")], "path string, priority string, freq string")
    snapshots.write_lines(snapshots.sitemap_lines(pages, "https://k.hr", "2025-01-01"), str(tmp_path / "map"), "place", "line")
    text = "".join(files(tmp_path / "map" / "file=sitemap.xml", ".txt"))
    tail = "</loc><lastmod>2025-01-01</lastmod><changefreq>"
    assert text.splitlines()[1:] == [
        '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', f"<url><loc>https://k.hr/a{tail}weekly</changefreq><priority>1.0</priority></url>",
        f"<url><loc>https://k.hr/b?x=1&amp;y=&lt;2&gt;{tail}yearly</changefreq><priority>0.5</priority></url>", "</urlset>",
    ]
    assert "".join(files(tmp_path / "map" / "file=robots.txt", ".txt")) == "User-agent: *\nAllow: /\n\nSitemap: https://k.hr/sitemap.xml\n"


def test_search_keys_are_those_of_sorted_json(spark):
    queries = ['NK "Iskra" \\ Buje', "Čakovec\tš\n", "", None]
    df = spark.createDataFrame([(q,) for q in queries], "q string").select(payloads.search_key(F.col("q"), F.lit(5)))
    want = [q if q is None else hashlib.sha256(json.dumps({"query": q, "limit": 5}, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16] for q in queries]
    assert [r[0] for r in df.collect()] == want


def test_persons_of_equal_rank_go_by_file_order(spark, tmp_path):
    head = "UDR_ID,IME,PREZIME,SVOJSTVO,FUNKCIJA\n"
    (tmp_path / "a.csv").write_text(head + '1,Ana,"A ""x"", B",Član,\n1,Iva,I,Predsjednik,\n1,Ivo,P,,predsjednik kluba\n2,,,Predsjednik,\n')
    (tmp_path / "b.csv").write_text(head + "1,Eva,E,PREDSJEDNIK,\n3,Lik,L,Likvidator,\n4,Ana,Z,,\n")
    found = matching.best_person(landing.persons(spark, str(tmp_path)), F.col("place"))
    assert sorted(tuple(r) for r in found.collect()) == [("1", "Iva", "I", 0), ("4", "Ana", "Z", 99)]


def test_registry_normal_form(spark):
    def plain(s):
        s = re.sub('[„«»`\'"]+', " ", s.lower())
        s = re.sub(r"\b([a-z])\.([a-z])\.", r"\1\2", s)
        s = re.sub(r"\b([a-z])\.([a-z])\.([a-z])\.", r"\1\2\3", s)
        return re.sub(r"\s+", " ", re.sub(r"[.,;:!?/\\()\[\]{}]+", " ", s)).strip()

    names = ["N.K. Iskra", "N. K. Iskra", "a.b.c. x", "A.B.C.D. y", "Dinamo-Zagreb", "„Sloga«, 1921. (B)", "x/y\\z [q]{w}", "", "H.N.K.Gorica 'G'"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(clubs.registry_norm(F.col("n"))).collect()] == [plain(n) for n in names]
