"""Scenarios of shared contacts, place evidence and merges."""

import pytest
from pyspark.sql import functions as F

from kartoteka.functions import contact, place, text, url
from kartoteka.operators import resolve, search, state

SCHEMA = "id long, canonical_name string, city string, phone string, email string, website string, oib string, registry_naziv string, semafor_url string"


def clubs(spark, rows):
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SCHEMA)


def verdicts(spark, rows):
    return {(r.field, r.id): r.verdict for r in resolve.detect(clubs(spark, rows)).collect()}


def test_cohort_with_one_owner(spark):
    own = dict(id=1, canonical_name="NK Jezero", city="Plitvica", website="https://www.nk-plitvica.hr/x", email="info@plitvica.hr", phone="091 234 5678", registry_naziv="NK Jezero Plitvica", semafor_url="u")
    others = [own | dict(id=k, canonical_name=f"NK Jezero ({k})", city="Drugo", registry_naziv="Udruga", semafor_url=None) for k in range(2, 7)]
    found = verdicts(spark, [own, *others])
    assert {found[f, 1] for f in ("website", "email", "phone")} == {"owner"}
    assert {found[f, k] for f in ("website", "email", "phone") for k in range(2, 7)} == {"orphan"}


def test_ties_and_no_evidence_are_ambiguous(spark):
    rows = [dict(id=1, canonical_name="NK A (X)", phone="01 2345678"), dict(id=2, canonical_name="NK B (Y)", phone="+385 1 234 5678")]
    assert set(verdicts(spark, rows).values()) == {"ambiguous"}
    rows = [dict(id=1, canonical_name="NK Prvi", city="Osijek", email="x@y.hr"), dict(id=2, canonical_name="NK Drugi", city="Split", email="X@Y.hr ")]
    assert set(verdicts(spark, rows).values()) == {"ambiguous"}


def test_no_group_without_sharing_and_empty_table(spark):
    assert verdicts(spark, [dict(id=1, canonical_name="A", phone="0912345678"), dict(id=2, canonical_name="B", phone="0912345679")]) == {}
    assert verdicts(spark, []) == {}


def test_shared_id_goes_to_the_registered_name(spark):
    rows = [dict(id=k, canonical_name=n, city=c, oib="12345678901", registry_naziv="Nogometni klub Sloga Kutina") for k, (n, c) in enumerate([("NK Sloga", "Kutina"), ("NK Sloga", "Gredelj"), ("NK Sloga", "Vrbanja"), ("NK Sloga (B)", "Hercegovac")])]
    found = verdicts(spark, rows)
    assert [found["oib", k] for k in range(4)] == ["owner", "orphan", "orphan", "orphan"]


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


@pytest.mark.parametrize("spelt", ["091 234 5678", "+385 91 2345678", "00385912345678", "(091) 234-5678", "091/2345678", "385 91 234 5678"])
def test_phone_spellings(spark, spelt):
    assert one(spark, contact.e164(F.col("p")), p=spelt) == "+385912345678"
    assert one(spark, contact.phone_kind(F.col("p")), p=spelt) == "mobile"


@pytest.mark.parametrize("junk", [None, "", "112", "n/a", "0123456789012345"])
def test_phone_junk(spark, junk):
    assert one(spark, contact.e164(F.col("p")), p=junk) is None


@pytest.mark.parametrize("spelt", ["https://www.Klub.hr/a?b#c", "klub.hr", "HTTP://klub.hr:8080/x", "www.klub.hr/", "http://me@klub.hr"])
def test_domain_spellings(spark, spelt):
    assert one(spark, url.norm_domain(F.col("u")), u=spelt) == "klub.hr"


@pytest.mark.parametrize(("spelt", "key"), [("https://facebook.com/nkx", "nkx"), ("facebook.com/nkx/", "nkx"), ("https://m.facebook.com/pg/nkx/about", "nkx"), ("https://facebook.com/profile.php?id=77", "profile:77"), ("https://example.com/nkx", None)])
def test_social_spellings(spark, spelt, key):
    assert one(spark, url.social_slug(F.col("u"), "facebook.com"), u=spelt) == key


def test_marks_and_tokens(spark):
    assert one(spark, text.fold(F.col("s")), s="  Đurđevac   ŠĆČ ") == "durdevac scc"
    assert one(spark, text.deburr(F.col("s")), s="Đakovo Š") == "đakovo s"
    assert one(spark, text.club_tokens(F.col("s"), F.col("c")), s="NK Sloga (Ž)", c="Nova Gradiška") == ["gradiska", "nova", "sloga"]


def evidence(spark, specific, found, county, codes=()):
    df = spark.createDataFrame([(specific, found, county, list(codes))], "s array<string>, f array<string>, c string, z array<string>")
    r = df.select(resolve.place_evidence(F.col("s"), F.col("f"), F.col("c"), F.col("z")).alias("x")).first().x
    return r.ok, r.reason


def test_place_evidence_from_specific_to_coarse(spark):
    assert evidence(spark, ["kutina"], ["kutina"], "Sisačko-moslavačka županija") == (True, "specific place")
    assert evidence(spark, ["kutina"], ["split"], "Sisačko-moslavačka županija") == (False, "another place")
    assert evidence(spark, [], ["ulica"], "Grad Zagreb", ["zagrebacka"]) == (True, "postcode")
    assert evidence(spark, [], ["ulica"], "Istarska", ["zagrebacka"]) == (False, "postcode elsewhere")
    assert evidence(spark, [], ["istarskog"], "Istarska županija") == (True, "county stem")
    assert evidence(spark, [], ["split"], None) == (False, "no signal")
    assert evidence(spark, [], [], "Istarska") == (False, "no place")


def test_quarantine_twice_is_once(spark):
    e = clubs(spark, [dict(id=1, canonical_name="NK Plitvica", email="a@plitvica.hr"), dict(id=2, canonical_name="NK Drugo (X)", email="a@plitvica.hr")])
    plan = state.quarantine_plan(e, resolve.detect(e), {"email": ["email"]})
    assert [(r.id, r.column, r.old_value) for r in plan.collect()] == [(2, "email", "a@plitvica.hr")]
    after = state.apply_plan(e, plan, ["email"])
    assert {r.id: r.email for r in after.collect()} == {1: "a@plitvica.hr", 2: None}
    assert resolve.detect(after).isEmpty()


def test_phrase_search(spark):
    docs = spark.createDataFrame([(1, "NK Sveti-Ivan Zelina"), (2, "Ivan NK Sveti"), (3, None)], "id long, name string")
    index = search.build_index(docs, "id", ["name"])
    assert {r.id for r in search.search(index, "id", "sveti-iv").collect()} == {1}
    assert {r.id for r in search.search(index, "id", "sv iv").collect()} == {1, 2}


def test_postcodes(spark):
    assert one(spark, place.postcode_counties(F.col("a")), a="Put 1, 21000 Split; 10000 Zagreb") == ["grad zagreb", "splitsko-dalmatinska"]
    assert one(spark, place.zip_from(F.col("a")), a="HR-10 000 Zagreb") == "10000"


def test_marks_of_other_scripts_go(spark):
    import unicodedata

    from kartoteka.functions import text

    base = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    spelt = ["Динамо Ћуприја й Ѓ", "Άρης Θεσσαλονίκης ἀΰ", "m² x₃ № ℂ Ｎｋ", "Čakovec ﬁ", "plain", "Ǻ ḱ ȱ ứ"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(spelt)], "i int, t string").select("i", text.strip_marks(F.col("t")).alias("s")).collect()
    assert {r.i: r.s for r in rows} == {i: base(t).replace("đ", "d") if "№" not in t else base(t).replace("No", "№") for i, t in enumerate(spelt)}
