import random

import pytest
from pyspark.sql import functions as F

from kartoteka.operators import repair, search
from kartoteka.operators.shared import shared_dir

COLUMNS = "id long, canonical_name string, city string, phone string, phone_kind string, phone_e164 string, email string, website string, fb_url string, ig_url string, oib string, udruga_id string, president string, registry_naziv string, address string, lat double, lng double, geo_source string, semafor_url string"


def frame(spark, rows):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], COLUMNS)


def cohort():
    own = dict(id=1, canonical_name="NK Jezero", city="Plitvica", website="https://www.nk-plitvica.hr/x", email="info@plitvica.hr", phone="091 234 5678", phone_kind="mobile", phone_e164="+385912345678", oib="12345678901", udruga_id="7", president="P", registry_naziv="NK Jezero Plitvica", address="Put 1", lat=45.1, lng=16.2, geo_source="both", semafor_url="u")
    return [own, *[own | dict(id=k, canonical_name=f"NK Jezero ({k})", city="Drugo", registry_naziv="Udruga", semafor_url=None) for k in range(2, 5)], dict(id=9, canonical_name="NK Sam", city="Sam", email=" ", phone="01 555 5555")]


@pytest.fixture
def store(spark):
    s = repair.Store(spark, f"{shared_dir(spark)}/store-{random.random()}")
    s.begin(frame(spark, cohort()), "2024-01")
    return s


def rows(df):
    return {r.id: r for r in df.collect()}


def test_dry_run_then_execute_then_again(spark, store):
    planned = repair.plan(store.clubs())
    n = planned.count()
    assert n > 0 and store.versions() == ["2024-01"] and store.history().count() == 0
    assert store.run("2024-02") and store.versions() == ["2024-01", "2024-02"]
    after, before = rows(store.clubs()), rows(store.clubs("2024-01"))
    for k in (2, 3, 4):
        assert [after[k][c] for c in ("phone", "phone_kind", "phone_e164", "email", "website", "oib", "udruga_id", "president", "registry_naziv")] == [None] * 9
        assert after[k].lat == 45.1 and after[k].geo_source == "both" and before[k].email == "info@plitvica.hr"
    assert after[1] == before[1] and after[9] == before[9]
    log = store.history().collect()
    assert len(log) == n and all(r.batch == "2024-02" and r.new_value is None and r.old_value == str(before[r.id][r.field]) for r in log)
    assert {r.id: r.fields for r in store.queue().collect()}.keys() == {2, 3, 4}
    assert not store.run("2024-03") and store.versions() == ["2024-01", "2024-02"]  # nothing is found anew


def test_coordinates_only_when_asked_for(store):
    assert store.run("2024-02", include_geo=True)
    assert {k: (r.lat, r.lng, r.geo_source) for k, r in rows(store.clubs()).items() if k in (2, 3)} == {2: (None, None, None), 3: (None, None, None)}


def test_a_batch_is_taken_back_exactly(store):
    store.run("2024-02")
    store.take_back("2024-02", "2024-03")
    assert rows(store.clubs()) == rows(store.clubs("2024-01"))
    assert store.history().filter("batch = '2024-03'").count() == store.history().filter("batch = '2024-02'").count()


def test_a_lost_run_does_not_count_and_order_is_kept(spark, store):
    store.history().drop("batch").write.parquet(f"{store.base}/repairs/v=2024-05")
    assert store.versions() == ["2024-01"] and store.run("2024-05") and store.versions() == ["2024-01", "2024-05"]
    with pytest.raises(ValueError):
        store.begin(frame(spark, []), "2024-04")


def test_empty_table(spark):
    s = repair.Store(spark, f"{shared_dir(spark)}/store-{random.random()}")
    s.begin(frame(spark, []), "1")
    assert not s.run("2") and s.clubs().count() == 0


def test_stored_index_prunes(spark):
    docs = spark.createDataFrame([(i, f"word{i % 50} alpha{i} Šuma") for i in range(500)] + [(1000, None), (1001, "")], "id long, t string")
    path = f"{shared_dir(spark)}/index-{random.random()}"
    search.write_index(search.build_index(docs, "id", ["t"]), path)
    index = search.read_index(spark, path)
    found = search.search(index, "id", "word4")
    plan = found._jdf.queryExecution().toString()
    assert "StringStartsWith(token,word4)" in plan and "PartitionFilters" in plan and "(letter" in plan
    assert {r.id for r in found.collect()} == {i for i in range(500) if str(i % 50).startswith("4")}
    assert len(index.filter("letter = 'w'").select("token").inputFiles()) >= 1 and index.filter(F.col("letter") == "š").count() == 0  # folded
    changed = docs.filter("id < 10").withColumn("t", F.lit("nova word4"))
    fresh = search.refreshed_index(index, changed, "id", ["t"], docs.filter("id = 44").select("id"))
    assert {r.id for r in search.search(fresh, "id", "word4").collect()} == {i for i in range(500) if str(i % 50).startswith("4") and i != 44} | set(range(10))
