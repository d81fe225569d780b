import re
from collections import Counter

import pytest

from kartoteka.llm import quality as q

SPACE = "[\x20\x09-\x0d]+"
PROSE = "The river ran past the old mill, and nobody came to see it before the evening fell on the town."
ONE_LINE = [  # clean documents of one line that hold words of notices, or inside other words
    "The catalog in the reading room lists every map that was printed before the war, and some later ones too.",
    "Its market share on Friday was the largest ever seen in the valley, said the owner of the small shop, and he smiled.",
    "They worked on the design up to the last day; the blog in question told the story of the house in nine parts.",
    "He had to log in the evening what he saw in the morning, as the old captain used to do on every one of his ships at sea, without fail.",
    "She wanted to sign up for the evening class before the end of the week came.",
    "The boy will share on the way home whatever he has found in the forest, she said.",
    "They log in every morning at nine and read the letters of the day before lunch.",
    "Wer sich nicht anmelden will, der kann auch ohne Namen in den Saal gehen und dort bis zum Abend bleiben.",
]
NOTICES = ["All rights reserved.", "© 2020 Some Company", "Licensed under CC BY-NC 4.0.", "Please log in to read on.", "Alle Rechte vorbehalten.", "Tous droits réservés.", "Todos los derechos reservados.", "COPYRIGHT (C) Some", "Sign up now!", "Share on Friendbook.", "Cliquez ici pour lire."]


def words(t):
    return [w for w in re.split(SPACE, t or "") if w]


def brute(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    starts = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if starts[tuple(w[i : i + 5])] > 1 for k in range(5)}
    count = lambda x: sum(c in "#*$%&|<>" for c in x)
    holds = lambda x, phrases: any(re.search(rf"(?<![^\W_]){re.escape(p)}(?![^\W_])", x.lower()) for p in phrases)
    notice = lambda x: len(words(x)) <= q.NOTICE_WORDS and ("©" in x or "copyright (c)" in x.lower() or holds(x, q.BOILERPLATE)) or len(words(x)) <= q.CALL_WORDS and holds(x, q.CALLS)
    bad = lambda x: count(x) * 10 > len(x) or len(x) - len(x.replace("!!", "")) >= 6 or (len(words(x)) < 3 and x.rstrip(" \t\x0b\x0c\r")[-1] not in q.CLOSING) or notice(x)
    good = [x for x in lines if not bad(x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    whole = len("\n".join(lines))
    kept = not failed and 100 * (whole - len("\n".join(good))) <= 50 * whole
    return len(w), sum(map(len, w)), count(t), len(lines) - len(set(lines)), len(hit), failed, kept, "\n".join(good)


def texts():
    out = [None, "", " \n\t", "few words only", PROSE, PROSE + "\n" + PROSE, "\n".join([PROSE, *NOTICES]), *ONE_LINE, *NOTICES, "a b c d e f g h i j", "a b c d e a b c d e x y z"]
    out += [PROSE + "\nHome\nAbout us\n| a | b | c |\n" + PROSE.replace("river", "brook"), "wow!!!!!! " + PROSE, "x\r\n" + PROSE, "é😀 " * 20, PROSE + " ".join(f"w{i}" for i in range(60_000))]
    return out + ["\n".join(f"{i} {PROSE}" for i in range(300)), PROSE + "\n" + PROSE[:60]]


def test_matches_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, PROSE), (3, PROSE), (3, PROSE)]
    got = q.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text"]
    for r in got:
        assert tuple(r[n] for n in names) == brute(r.text), (r.text or "")[:80]


def test_clean_lines_stay_and_notices_go():
    for t in ONE_LINE:
        assert brute(t)[6] and brute(t)[7] == t
    for n in NOTICES:
        assert brute(PROSE + "\n" + n)[7] == PROSE


@pytest.mark.parametrize("names", ["doc_id long, text string, lang string, n_chars long, kept string, clean_text string, _t int, _words int, `a.b` int, _row int"])
def test_clashing_columns_stay(spark, names):
    rows = [(1, PROSE + "\nMenu", None, 5, "mine", "own", 1, 2, 3, 4), (2, "short", "en", 5, None, None, None, None, None, None)]
    out = q.clean(spark.createDataFrame(rows, names))
    assert out.columns == spark.createDataFrame(rows, names).columns
    (r,) = out.collect()
    assert tuple(r) == (1, PROSE, None, len(PROSE), "mine", "own", 1, 2, 3, 4)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert q.report(none).count() == 0 and q.clean(none).count() == 0


def test_sql(spark, tmp_path):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parents[1]))
    from oracle import connect, differences

    spark.createDataFrame([(i, t) for i, t in enumerate(texts()) if len(t or "") < 100_000], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert not differences(spark, connect(tmp_path), tmp_path, lambda s, d: q.report(s.read.parquet(f"{d}/documents.parquet")), q.ORACLE_SQL)
