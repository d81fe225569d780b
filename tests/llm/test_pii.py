from kartoteka.llm import pii

SCHEMA = "doc_id long, text string, _rid int, n_chars long"


def test_detection_and_formats():
    text = "Mail a.b43@mail7.example.com or +1 (717) 555-0202, 10.0.12.5, card 4111 1111 1111 1111, id 078-05-1120. Mr. John Smith, Frau Petra MÜLLER, Анна Иванова."
    kinds = [k for *_, k, _ in pii.detect(text)]
    assert kinds == ["email", "phone", "ip", "card", "national", "given:m:latin", "surname:n:latin", "given:f:latin", "surname:n:latin", "given:f:cyrillic", "surname:f:cyrillic"]
    for s, e, k, c in pii.detect(text):
        new = pii.render(k, text[s:e], pii.surrogate(k, c, 1))
        assert new != text[s:e]
        if k in ("phone", "card", "national"):
            assert [x if not x.isdigit() else "0" for x in new] == [x if not x.isdigit() else "0" for x in text[s:e]]
        if k == "card":
            assert pii._luhn("".join(filter(str.isdigit, new)))
        if "cyrillic" in k:
            assert pii.script_of(new) == "cyrillic"
    assert pii.render("surname:n:latin", "MÜLLER", "weber") == "WEBER"
    assert pii.detect("no entities: 12.5 and 2024 or version 1.2.3") == [] == pii.detect(None)


def test_replacement(spark):
    rows = [
        (1, "call +1 (717) 555-0202 or 717-555-0202 now", 1, 5), (2, "again +1 (717) 555-0202.", 2, 5), (3, None, 3, 0), (4, "", 4, 0), (5, "plain words", 5, 11),
        (5, "plain words", 5, 11), (6, "é😀 x.43@mail7.example.com x.44@mail7.example.com X.43@MAIL7.example.com", 6, 1), (None, "from 83.229.25.121 " * 500, 7, 1),
    ]
    out = pii.replace(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "_rid", "n_chars", "n_entities"]
    got = sorted(out.collect(), key=lambda r: r._rid)
    assert len(got) == len(rows)
    first, second = got[0].text, got[1].text
    new = first[len("call ") :].split(" or ")[0]
    assert second == f"again {new}." and new.startswith("+1 (") and "717" not in new[:8]
    assert "".join(filter(str.isdigit, first.split(" or ")[1])) == "".join(filter(str.isdigit, new))[1:]
    assert [r.text for r in got[2:6]] == [None, "", "plain words", "plain words"]
    a, b, c = got[6].text.split()[1:]
    assert len({a.casefold(), b.casefold(), c.casefold()}) == 2 and a.casefold() == c.casefold() and a.split("@")[1] == b.split("@")[1]
    assert got[7].n_entities == 500 and "83.229.25.121" not in got[7].text and len(set(got[7].text.split())) == 2
    assert got[7].n_chars == len(got[7].text) and got[4].n_chars == 11


def test_collisions_are_drawn_again(spark):
    # Far more surnames than the list holds, and e-mail addresses of one letter.
    names = [(i, f"Mr. Qx{chr(97 + i // 26)}{chr(97 + i % 26)} met", 0, 0) for i in range(300)]
    mails = [(1000 + i, f"to {chr(97 + i)}@b.co", 0, 0) for i in range(26)]
    out = pii.replace(spark.createDataFrame(names + mails, SCHEMA)).collect()
    assert len({r.text for r in out}) == 326
    originals = {t for _, t, _, _ in names + mails}
    assert not originals & {r.text for r in out}


def test_empty(spark):
    assert pii.replace(spark.createDataFrame([], SCHEMA)).count() == 0


# Listed apart from the detector: written as people write them.
PHONES = [
    "+33 1 23 45 67 89", "+49 30 12345678", "01234 567890", "555-0123", "+44 20 7946 0958", "+44 (0)20 7946 0958", "030 / 1234567", "(030) 1234567", "01 23 45 67 89", "+49-171-1234567",
    "0171 1234567", "+34 612 345 678", "+1 212 555 0199", "(212) 555-0199", "212.555.0199", "+14155550123", "0800 123 456", "+41 44 668 18 00",
]
NO_PHONES = ["2024-01-15", "15.01.2024", "in 2019-2024", "01.02.2024 10", "1,234-5678", "12:30", "0.5 and 0.25", "3 of 10", "01-02-2024", "$100-2000"]
NAMED = [  # (text, the words of names)
    ("Contact John Smith today", "John Smith"), ("Director Mary Johnson said", "Mary Johnson"), ("Der Herr Müller kam", "Müller"), ("by John Q. Smith in", "John Smith"),
    ("Ask Dr. Weber", "Weber"), ("Sehr geehrte Frau Dr. Schneider", "Schneider"), ("Dear Mr. Albert Quux", "Albert Quux"), ("Die Kollegin Heike Lehmann", "Heike Lehmann"),
    ("Écrire à Madame Odile Renard", "Odile Renard"), ("Kevin Durant wrote", "Kevin Durant"), ("Mr. J. R. Hartley", "Hartley"), ("Позвонить: Господин Орлов", "Орлов"),
    ("Signed JOHN SMITH", "JOHN SMITH"), ("Paul Smith And Mary Jones", "Paul Smith Mary Jones"), ("Priya Raman and Wei Zhang met Olivia Nakamura", "Priya Raman Wei Zhang Olivia Nakamura"),
    ("ο Σωκράτης Παπάς είπε", "Σωκράτης Παπάς"), ("Dear Xolani Quux, hello", "Xolani Quux"), ("Regards,\nNaledi Okafor", "Naledi Okafor"), ("Olivia Nakamura came. Later Nakamura left with Olivia.", "Olivia Nakamura Nakamura Olivia"),
]


def test_phone_formats():
    for p in PHONES:
        text = f"Please call {p}, or write."
        ((s, e, kind, canon),) = pii.detect(text)
        assert (text[s:e], kind) == (p, "phone"), p
        new = pii.render(kind, p, pii.surrogate(kind, canon, 1))
        assert new != p and [c if not c.isdigit() else "0" for c in new] == [c if not c.isdigit() else "0" for c in p]
        assert not p.startswith("+") or new[:2] == p[:2]
    for p in NO_PHONES:
        assert pii.detect(f"It was {p} then") == [], p


def test_names_in_context():
    for text, words in NAMED:
        found = [text[s:e] for s, e, *_ in pii.detect(text)]
        assert found == words.split(), (text, found)
    assert pii.detect("The Old Bridge In Paris. New York City Council. Dear Customer, Contact The City Council") == []


def test_no_listed_original_stays(spark):
    rows = [(i, f"Please call {p} soon", i, 0) for i, p in enumerate(PHONES)] + [(100 + i, t, 0, 0) for i, (t, w) in enumerate(NAMED)]
    got = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not [p for i, p in enumerate(PHONES) if p in got[i]]
    assert not [w for i, (_, ws) in enumerate(NAMED) for w in ws.split() if w in got[100 + i].split()]


def brute(texts, key=pii.DEMO_KEY):
    """Replaced texts by plain loops over the whole corpus."""
    found = [pii.detect(t) for t in texts]
    entities = {(k, c) for f in found for *_, k, c in f}
    attempt = dict.fromkeys(entities, 0)
    while True:
        drawn = {e: pii.surrogate(*e, attempt[e], key) for e in entities}
        best = {}
        for (k, c), s in drawn.items():
            best[k, s] = min(best.get((k, s), (99, "")), (attempt[k, c], c)) if (k, s) in best else (attempt[k, c], c)
        lost = [(k, c) for (k, c), s in drawn.items() if best[k, s][1] != c or (k, s) in entities]
        if not lost:
            break
        for e in lost:
            attempt[e] += 1
    out = []
    for t, f in zip(texts, found, strict=True):
        for s, e, k, c in sorted(f, reverse=True):
            t = t[:s] + pii.render(k, t[s:e], drawn[k, c]) + t[e:]
        out.append(t)
    return out, drawn


def corpus():
    names = [n for ns in pii.GIVEN.values() for n in ns] + [n for ns in pii.MORE_GIVEN.values() for n in ns]
    out = [f"Then {n} {s} came; {s} saw {n}." for n, s in zip(names, [*pii.SURNAMES, "Иванова", "Петров"] * 20, strict=False)]
    out += [f"Please call {p} soon" for p in PHONES] + [t for t, _ in NAMED] + [None, "", "plain words", "plain words"]
    out += [f"pay to GB82 WEST 1234 5698 7654 32 or DE89370400440532013000 or GB00 WEST 1234 5698 7654 32, mail x{i}@y.example.com" for i in range(30)]
    return out


def test_whole_corpus_against_plain_loops(spark):
    texts = corpus()
    rows = [(i, t, i, 0) for i, t in enumerate(texts)]
    got = {r._rid: r.text for r in pii.replace(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    want, drawn = brute(texts)
    assert [got[i] for i in range(len(texts))] == want
    for kind in {k for k, _ in drawn}:  # distinct, no original, same script and gender
        own = {c: s for (k, c), s in drawn.items() if k == kind}
        assert len(set(own.values())) == len(own) and not set(own) & set(own.values())
        if kind.startswith(("given", "surname")):
            role, gender, script = kind.split(":")
            listed = {n.casefold() for n in (pii.DRAWN.get((script, gender), []) if role == "given" else pii.SURNAMES)}
            for s in own.values():
                assert pii.script_of(s) == script and (s in listed or s.endswith(tuple(pii.ENDINGS[role, script, gender]))), (kind, s)
    valid = lambda x: pii._mod97(x[4:] + x[:4]) == 1
    ibans = {c: s for (k, c), s in drawn.items() if k == "iban"}
    assert len(ibans) == 3 and all(valid(c) == valid(s) and c[:2] == s[:2] for c, s in ibans.items())


def test_clashing_columns_stay(spark):
    rows = [("mine", 1, "call +1 (717) 555-0202", "f", 7, 9), ("own", 2, None, None, None, None)]
    frame = spark.createDataFrame(rows, "n_entities string, doc_id long, text string, _found string, _n int, `a.b` int")
    out = pii.replace(frame)
    assert out.columns == [*frame.columns, "n_entities_"]
    got = sorted(out.collect(), key=lambda r: r.doc_id)
    assert [tuple(r)[:2] + tuple(r)[3:] for r in got] == [("mine", 1, "f", 7, 9, 1), ("own", 2, None, None, None, 0)] and got[1].text is None


def test_many_entities_in_one_text():
    import time

    began = time.perf_counter()
    text = " ".join(f"a{i}@b{i}.example.com" for i in range(20_000))
    assert len(pii.detect(text)) == 20_000 and time.perf_counter() - began < 5


def shown(text):
    return [(text[a:b], k) for a, b, k, _ in pii.detect(text)]


def test_repeats_in_capitals_and_small_letters():
    assert [t for t, _ in shown("Mr. Smithson came. SMITHSON and smithson said so; Smithsonian stays.")] == ["Smithson", "SMITHSON", "smithson"]
    assert [t for t, _ in shown("Mrs. Brown sat in the brown chair, wrote BROWN.")] == ["Brown", "BROWN"]
    assert len({c for *_, c in pii.detect("Mr. Smithson SMITHSON smithson")}) == 1


def test_ipv6_in_its_format():
    text = "from 2001:db8::ff00:42:8329 or 2001:0db8:0000:0000:0000:ff00:0042:8329 at 12:30:45, a::b::c, ::1, FE80::1:AB"
    found = [(text[a:b], k, c) for a, b, k, c in pii.detect(text)]
    assert [t for t, *_ in found] == ["2001:db8::ff00:42:8329", "2001:0db8:0000:0000:0000:ff00:0042:8329", "FE80::1:AB"]
    assert found[0][2] == found[1][2]  # one address, two formats
    for t, k, c in found:
        new = pii.render(k, t, pii.surrogate(k, c, 0))
        assert new != t and [len(g) for g in new.split(":")] == [len(g) for g in t.split(":")] and new.isupper() == t.isupper()
        assert pii._is_ipv6(new)


def test_numbers_that_are_no_phones():
    for text in ("Price 10 000 000 000 units", "invoice 2023-0456-7891", "total: 250 000 000 EUR", "order no. 4021-3345-887", "1 250 000 people came", "Rechnung 12-345-6789"):
        assert not shown(text), text
    for text in ("call 612 345 678", "tel 0049 30 123456", "ring +34 612 345 000 today", "his number is 555-0123"):
        assert [k for _, k in shown(text)] == ["phone"], text
