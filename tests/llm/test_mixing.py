import duckdb
import pytest

from kartoteka.llm import mixing as m

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    out = [(i, f"text {i}", "en", "big", 5) for i in range(300)] + [(1000 + i, None, None, "small", None) for i in range(20)]
    out += [(2000 + i, "", "de", None, 0) for i in range(9)] + [(None, "no id", "en", "big", 5), (None, "no id", "en", None, 5), (7, "text 7", "en", "big", 5), (7, "again", "en", "small", 5)]
    return out + out[:5] + [(3000, "long " * 200_000, "en", "lone", 1)]


def sql(frame):
    c = duckdb.connect()
    c.register("documents", frame.toArrow())
    return sorted(map(str, c.sql(f"select doc_id, md5(coalesce(text, 'x')), source, copy, shuffle_key from ({m.ORACLE_SQL})").fetchall()))


def got(frame):
    c = duckdb.connect()
    c.register("found", frame.toArrow())
    return sorted(map(str, c.sql("select doc_id, md5(coalesce(text, 'x')), source, copy, shuffle_key from found").fetchall()))


@pytest.mark.parametrize("broadcast", [100, 0])
def test_rows_equal_sql_by_either_join(spark, broadcast):
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    assert got(m.mix(frame, broadcast_sources=broadcast)) == sql(frame)


def test_counts_do_not_depend_on_partitions(spark):
    frame = spark.createDataFrame(rows(), SCHEMA)
    assert got(m.mix(frame.repartition(7))) == got(m.mix(frame.coalesce(1))) == got(m.mix(frame, shuffled=False))


def test_clashing_columns_stay(spark):
    schema = SCHEMA + ", copy string, _source string, _count int, shuffle_key string, _row int, `a.b` int"
    frame = spark.createDataFrame([(*r, "mine", "own", 77, "key", 5, 6) for r in rows()[:50]], schema)
    out = m.mix(frame)
    assert out.columns == [*frame.columns, "copy_", "shuffle_key_"]
    found = out.collect()
    assert found and {(r["copy"], r["_source"], r["_count"], r["shuffle_key"], r["_row"], r["a.b"]) for r in found} == {("mine", "own", 77, "key", 5, 6)}
    assert {r["copy_"] for r in found} <= set(range(50)) and len({(r.doc_id, r["copy_"], r["shuffle_key_"]) for r in found}) == len(found)


def test_weights_and_mean(spark):
    frame = spark.createDataFrame([(i, "t", "en", "a" if i % 4 else "b", 1) for i in range(8000)], SCHEMA)
    n = {r.source: r["count"] for r in m.mix(frame, {"a": 1.0, "b": 3.0}).groupBy("source").count().collect()}
    assert abs(n["a"] - 2000) < 200 and abs(n["b"] - 6000) < 300  # four standard deviations
    assert {r.source for r in m.mix(frame, {"a": 1.0}).collect()} == {"a"}
    assert m.mix(frame, {"other": 1.0}).count() == 0


def test_hot_id_is_dealt_apart(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = spark.createDataFrame([(1, "same", "en", "a", 1)] * 4000, SCHEMA).repartition(16)
        sizes = [len(p) for p in m.mix(frame, {"a": 1.0}).rdd.glom().collect()]
        assert sum(sizes) == 0 or max(sizes) < sum(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty(spark):
    assert m.mix(spark.createDataFrame([], SCHEMA)).count() == 0
