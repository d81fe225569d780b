"""Landing data, sinks and the streaming extension."""

import json

from pyspark.sql import functions as F

from kartoteka.functions import markup
from kartoteka.session import table
from kartoteka.sources import landing, snapshots
from kartoteka.streaming import events


def test_team_payloads(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"team": {"id": 5, "shortName": "Sloga", "foundationDateTimestamp": -1000000000, "venue": {"name": "V", "capacity": 900, "city": {"name": "Kutina"}, "venueCoordinates": {"latitude": 45.5, "longitude": 16.7}}}}))
    (tmp_path / "2.json").write_text(json.dumps({"team": {"id": 6}}))
    found = {r.team_id: r for r in landing.teams(spark, str(tmp_path)).collect()}
    assert (found[5].founded, found[5].city, found[5].lat, found[6].city) == (1938, "Kutina", 45.5, None)


def test_geodata_payloads(spark, tmp_path):
    elements = [{"type": "way", "id": 1, "center": {"lat": 45.0, "lon": 16.0}, "tags": {"leisure": "stadium", "capacity": "5000"}}, {"type": "node", "id": 2, "center": {"lat": 45.1, "lon": 16.1}, "tags": {"leisure": "pitch", "capacity": "about 10"}}]
    (tmp_path / "x.json").write_text(json.dumps({"elements": elements}))
    found = {r.osm_id: (r.kind, r.capacity) for r in landing.features(spark, str(tmp_path)).collect()}
    assert found == {1: ("stadium", 5000), 2: ("pitch", None)}


def test_dump_and_lists(spark, tmp_path):
    (tmp_path / "d.csv").write_text('name,note\n"A ""x""","two\nlines"\nB,\n')
    assert [(r.name, r.note) for r in landing.dump(spark, str(tmp_path / "d.csv")).collect()] == [('A "x"', "two\nlines"), ("B", None)]
    (tmp_path / "l.txt").write_text("# comment\n a \n\nb\n")
    assert [r.value for r in landing.lines(spark, str(tmp_path / "l.txt")).collect()] == ["a", "b"]


def test_csv_round_trip_and_partitioned_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id long, t string")
    snapshots.write_csv(df, str(tmp_path / "c"))
    back = landing.dump(spark, str(tmp_path / "c"))
    assert {(r.id, r.t) for r in back.collect()} == {("1", "a,b"), ("2", None)}
    snapshots.write_documents(df, str(tmp_path / "j"), "id")
    assert (tmp_path / "j" / "id=1").is_dir()
    assert json.loads(snapshots.manifest({"clubs": 2}, "2024-01-01"))["counts"] == {"clubs": 2}


def test_markup(spark):
    df = spark.createDataFrame([("# A\nx\n## Contact\n01 234\n# B\ny", "1. Naziv: NK 2. OIB: 7")], "m string, n string")
    r = df.select(markup.markdown_section(F.col("m"), "Contact").alias("m"), markup.numbered_fields(F.col("n")).alias("n")).first()
    assert r.m == "01 234" and [x.strip() for x in r.n] == ["1. Naziv: NK", "2. OIB: 7"]


def test_labelled_fields(spark):
    pages = ["13. Adresa sjedišta Ulica 5 16. 17. Račun (IBAN) HR12 21. 01 234 IZVJEŠTAJI x 23. a@b.hr 23. e-mail c@d.hr", "no fields", None]
    found = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, p string").select("i", markup.labelled_fields(F.col("p")).alias("f")).orderBy("i").collect()
    assert {k: v for k, v in found[0].f.asDict().items() if v} == {"adresa": "Ulica 5", "iban": "HR12", "telefon": "01 234", "email": "c@d.hr"}
    assert not any(found[1].f) and not any(found[2].f)


def test_stream_equals_batch(spark, tmp_path):
    batch = table(spark, "/root/testdata/sf0.001", "events")
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = events.windowed_counts(events.read_events(spark, str(tmp_path / "in")), "6 hours", "3650 days")
    q = stream.writeStream.format("memory").queryName("counted").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    of = lambda df: {(r.start, r.event_type): (r.n, round(r.total, 6)) for r in df.collect()}
    assert of(spark.table("counted")) == of(events.windowed_counts(batch, "6 hours"))
