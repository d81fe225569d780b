"""State transitions, marks and gates on small rows."""

from pyspark.sql import functions as F

from kartoteka.functions import clubs, colour, contact, text, url
from kartoteka.operators import audit, matching, state


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_upsert_overwrites_what_is_supplied(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, name string, year int")
    new = spark.createDataFrame([(2, None), (3, 9), (3, 8)], "id int, year int")
    assert rows(state.upsert(old, new, "id"), "id") == [(1, "a", 5), (2, "b", None), (3, None, 8)]
    assert rows(state.upsert(old, new, "id", F.desc("year")), "id")[2] == (3, None, 9)
    assert rows(state.insert_or_ignore(old.drop("name"), new, "id"), "id") == [(1, 5), (2, 6), (3, 8)]


def test_move_latest_and_columns(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, "y"), (3, "z", "w")], "id int, a string, b string")
    assert rows(state.move_column(df, "a", "b", F.col("a") == "x"), "id") == [(1, None, "x"), (2, None, "y"), (3, "z", "w")]
    assert rows(state.latest(df.withColumn("k", F.lit(1)), "k", F.desc("id")).select("id"), "id") == [(3,)]
    assert state.add_missing_columns(df, {"b": "int", "c": "double"}).dtypes[-2:] == [("b", "string"), ("c", "double")]
    value, place = state.cascade(F.col("a"), F.col("b"))
    assert rows(df.select("id", value, place), "id") == [(1, "x", 1), (2, "y", 2), (3, "z", 1)]


def test_batches_number_the_whole_order(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = {r.k: r.batch for r in audit.with_batches(df, 4, F.col("k")).collect()}
    assert got == {k: k % 4 for k in range(1000)} and audit.with_batches(df.limit(0), 4, F.col("k")).count() == 0


def test_marks_of_any_form(spark):
    cases = {"Čačak": "cacak", "Đuro": "duro", "éa": "ea", "ﬁn": "fin", "ＡＢ": "ab", "Ṣa": "sa", "": ""}
    df = spark.createDataFrame(list(cases.items()), "x string, want string").withColumn("got", text.fold(F.col("x")))
    assert [(r.x, r.got) for r in df.collect()] == list(cases.items())
    assert spark.createDataFrame([("Đé",)], "x string").select(text.deburr(F.col("x"))).first()[0] == "đe"


def test_hosts_phones_and_mail(spark):
    one = lambda c, v: spark.createDataFrame([(v,)], "x string").select(c(F.col("x"))).first()[0]
    assert [one(url.own_site, x) for x in ("https://fb.com/x", "https://t.co/1", "https://vm.tiktok.com", "https://nk.hr")] == [False, False, False, True]
    assert one(contact.phones_in, "on 12.05.2019 call 01/2345-678 or +385 91 123 4567") == ["01/2345-678", "+385 91 123 4567"]
    assert one(contact.emails_in, "a@nk.hr, page@facebook.com") == ["a@nk.hr"]
    assert one(clubs.league_tier, "1. ŽNL") == 6 and one(clubs.league_tier, "x") is None
    dark = colour.dark_lightness(lambda x: x * 2)
    assert spark.range(1).select(dark).first()[0] == 0.25


def test_one_page_for_each_club(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", None), (4, "c", None), (5, "z", "x"), (6, None, "x")], "id int, name string, city string")
    own = spark.createDataFrame([(10, "a", "x"), (11, "a", "y"), (12, "b", "q"), (13, "c", "q"), (14, "c", None)], "id int, name string, city string")
    want = [(1, 10, "matched"), (2, None, "ambiguous"), (3, 12, "matched"), (4, None, "ambiguous"), (5, None, "no_name_hit"), (6, None, "no_name_hit")]
    assert rows(matching.one_to_one(pages, own), "page_id") == want


def test_better_on_the_border(spark, tmp_path):
    from oracle import connect, differences

    from kartoteka.plans import registry

    # 1.3 * 3 * 1000 is a little more than 3900 in doubles, 1.3 * 3000 is not.
    lines = [(q, n, float(q), 1300.0 * q + d) for q in range(1, 51) for n, d in enumerate((-0.01, 0.0, 0.01))]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    name = "e17_upgrade_if_better"
    assert not differences(spark, connect(tmp_path), tmp_path, registry.QUERIES[name], registry.ORACLES[name])


def test_margin_on_the_border_is_exact(spark, tmp_path):
    import random
    from decimal import Decimal

    from oracle import connect, differences

    from kartoteka.plans import registry

    deal, events, kept = random.Random(4), [], set()
    for user in range(300):
        a = [Decimal(deal.randrange(1, 20000)) / 100 for _ in range(12)]
        margin = Decimal(50 - user % 2) / 100  # .50 or .49
        b = [*a[:11], a[11] - margin]
        deal.shuffle(a)
        events += [(user, "a", float(x)) for x in a] + [(user, "b", float(x)) for x in b]
        kept |= {user} if margin >= Decimal("0.5") else set()
    put = lambda rows, path: spark.createDataFrame(rows, "user_id long, event_type string, value double").write.parquet(str(path / "events.parquet"))
    put(events, tmp_path)
    name = "w04_margin_winner"
    assert {(r.user_id, r.event_type) for r in registry.QUERIES[name](spark, str(tmp_path)).collect()} == {(u, "a") for u in kept}
    # Values that are no decimals, and none at all: as in SQL.
    odd = [float("nan"), float("inf"), float("-inf"), None, 1e300, 1e-300, 0.1 + 0.2, 5.0, -5.0]
    (tmp_path / "odd").mkdir()
    put([(i * 10 + j, t, v) for i, x in enumerate(odd) for j, y in enumerate(odd) for t, v in (("a", x), ("b", y), ("b", 1.0))], tmp_path / "odd")
    assert not differences(spark, connect(tmp_path / "odd"), tmp_path / "odd", registry.QUERIES[name], registry.ORACLES[name])
