import random
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline
import test_decontaminate
import test_jaccard
from kartoteka.llm import mixing, pii, quality


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n)) + "."
    rows, bench = [], [(i, prose(20)) for i in range(5)]
    base = [prose(r.randrange(5, 80)) + "\n" + prose(40) for _ in range(60)]
    for t in base:
        rows += [t] * r.choice([1, 1, 3])
        if r.random() < 0.3:
            rows.append(t.replace(".", " more.", 1))
    rows += [f"{t} write to me.{i}@mail.example.com or +1 (717) 555-02{i:02d}." for i, t in enumerate(base[:10])]
    rows += [prose(30) + " " + t + " " + prose(9) for _, t in bench] + ["menu | home | about | more\n" * 9, None, "", "ha ha " * 40, "All rights reserved.\n" + base[0]]
    docs = [(i, t, r.choice(["en", None]), r.choice(["big", "big", "small", None]), len(t or "")) for i, t in enumerate(rows)]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, docs, bench


def test_stages_against_brute_force(spark, sf_dir):
    d, rows, bench = sf_dir
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, d), name)
        assert out.columns == columns
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        kept[name] = {r.doc_id: r.text for r in out.collect()}
        assert len(kept[name]) == out.count()
        if name == "quality_rules":
            c = duckdb.connect()
            c.sql(f"create view documents as select * from '{d}/documents.parquet/*.parquet'")
            assert set(kept[name]) == {r[0] for r in c.sql(f"select doc_id from ({quality.ORACLE_SQL}) where kept").fetchall()}
            assert not any("rights reserved" in t for t in kept[name].values())
        if name == "near_duplicates":
            assert set(kept[name]) == {g for g, _ in test_jaccard.brute([(i, t.replace("\n", " ")) for i, t in texts]).values()}
        if name == "decontamination":
            assert set(kept[name]) == {i for i, x in test_decontaminate.brute(texts, bench).items() if not x[3]}
        if name == "surrogates":
            assert set(kept[name]) == {i for i, _ in texts}
            for i, t in texts:
                found = pii.detect(t)
                assert (kept[name][i] == t) == (not found) and not any(t[s:e] in kept[name][i] for s, e, *_ in found)
        docs = out
    c = duckdb.connect()
    rows = docs.toPandas()
    c.register("documents", rows)
    want = sorted(c.sql(f"select doc_id, copy, shuffle_key from ({mixing.ORACLE_SQL})").fetchall())
    got = sorted((r.doc_id, r.copy, r.shuffle_key) for r in corpus_pipeline.run(spark, d).collect())
    assert got == want and 0 < len(got)


def test_empty_tables(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key"]


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    prose = "The river ran past the old mill, and nobody came to see it before the evening fell on the town."
    odd = [(None, prose + " Please call the owner of the mill today on this new number: +1 (717) 555-0202.", None, None, None), (1, None, None, None, None), (1, "", "en", "a", 0), (2, prose * 1 + "\nMenu", "en", "a", 9), (2, prose, "en", "a", 9), (2, prose, "en", "a", 9)]
    odd += [(10 + i, " ".join(f"w{i}x{k}" for k in range(4000)) + ".", "en", "b", 1) for i in range(20)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, copy string, _source int, kept boolean, n_entities int"
    spark.createDataFrame([(*r, "mine", 5, None, 7) for r in odd], kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (None, "one two three")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        assert out.columns == docs.columns, name
        docs = out
    got = docs.collect()
    assert len(got) == 22 and {(r["copy"], r["_source"], r["kept"], r["n_entities"]) for r in got} == {("mine", 5, None, 7)}
    assert sum(r.text == prose for r in got) == 1 and not any("717" in r.text and "555-0202" in r.text for r in got)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.columns == [*docs.columns, "copy_", "shuffle_key"] and last.count() >= 0
