import random

from kartoteka.operators.shared import shared_dir, versions
from kartoteka.streaming import events

SF = "/root/testdata/sf0.001"


def test_latest_events_by_version(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/events.parquet")
    for i, part in enumerate(rows.randomSplit([1.0, 1.0, 1.0], 7)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    state = f"{shared_dir(spark)}/latest-{random.random()}"

    def put(batch, batch_id):
        events.upsert_latest(batch, batch_id, state)
        events.upsert_latest(batch, batch_id, state)  # a batch that is run again changes nothing

    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None
    known = versions(spark, state)
    assert len(known) == 3
    got = {r.user_id: r.event_id for r in spark.read.parquet(f"{state}/v={known[-1]}").collect()}
    want = {}
    for r in rows.collect():
        want[r.user_id] = max(want.get(r.user_id, (r.ts, r.event_id)), (r.ts, r.event_id))
    assert got == {k: v[1] for k, v in want.items()}
