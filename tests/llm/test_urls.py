from kartoteka.llm import urls

SCHEMA = "page_id long, url string, html string, host int"
RULED = [
    ("https://WWW.Example.com/en/x?y", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://m.www.example.com/en/", "m.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("http://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
    ("http://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
    ("http://x.net/es/#a/b", "x.net", "/es/", "net/es/", "block"),
    ("http://x.com", "x.com", "", None, "allow"),
    ("http://x.com?u=http://y.net/es/", "x.com", "", None, "allow"),
    ("x.net/es/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("://é.NET/fr/", "é.net", "/fr/", "net/fr/", "block"),
]


def test_rules(spark):
    rows = [(i, r[0], None, 1) for i, r in enumerate(RULED)]
    got = {r.page_id: tuple(r)[1:] for r in urls.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(len(RULED))] == [r[1:] for r in RULED]


def pages():
    link = lambda *hosts: " ".join(f'<a href="https://{h}/x">' for h in hosts)
    return [
        (1, "http://bad.net/es/1", None, 0), (2, "http://bad.net/es/2", "<p>", 0),
        (3, "http://friend.org/a", link("bad.net", "bad.net"), 0),  # links to a blocked host
        (4, "http://far.org/a", link("friend.org", "good.com", "other.org"), 0),
        (5, "http://good.com/a", link("praised.org", "GOOD.com"), 0),
        (6, "http://praised.org/a", link("bad.net"), 0),  # links to a blocked host, and a trusted one links to it
        (7, "http://lone.org/", "", 0), (8, "http://shop.bad.net/de/", None, 0), (8, "http://shop.bad.net/de/", None, 0),
    ]


def brute(rows):
    graph, hosts, count = {}, set(), {}
    ruled = {r[0]: r for r in rows}
    import re

    for _, url, html, _ in rows:
        host = re.match(r".*?://([^/?#]*)", url)[1].lower()
        hosts.add(host)
        good, bad, n = count.get(host, (0, 0, 0))
        path = url.split(host, 1)[-1]
        count[host] = (good + host.endswith(".com"), bad + (host.endswith(".net") and path.startswith(("/es/", "/fr/"))), n + 1)
        for dst in set(re.findall(r'href="https://([^/]*)', html or "")):
            if dst.lower() != host:
                graph[host, dst.lower()] = graph.get((host, dst.lower()), 0) + 1
                hosts.add(dst.lower())
    for h in hosts:
        if h.count(".") >= urls.PARENT_LABELS:
            up = h.split(".", 1)[1]
            graph[h, up] = graph.get((h, up), 0) + 1
            graph[up, h] = graph.get((up, h), 0) + 1
    assert ruled
    rank = []
    for k in (0, 1):
        seeds = {h for h, c in count.items() if c[k] > c[2] / 2}
        start = {h: (1 - urls.DAMPING) / len(seeds) for h in seeds}
        now, whole = dict(start), {}
        for e, m in graph.items():
            whole[e[k]] = whole.get(e[k], 0) + m
        for _ in range(300):  # far beyond the tolerance
            fresh = dict(start)
            for e, m in graph.items():
                fresh[e[1 - k]] = fresh.get(e[1 - k], 0) + urls.DAMPING * m / whole[e[k]] * now.get(e[k], 0)
            now = fresh
        rank.append(now)
    t, d = ({h: r.get(h, 0) for h in {*rank[0], *rank[1]}} for r in rank)
    reached = {h for h in t if d[h] > urls.SHARE * (t[h] + d[h]) and d[h] * len(count) > urls.FLOOR}
    seeds = {h for h, c in count.items() if c[1] > c[2] / 2}
    links = lambda h, to: sum(m for (a, b), m in graph.items() if a == h and (to is None or b in to))
    return {h for h in reached if h in seeds or links(h, None) and links(h, reached) >= urls.LINKS * links(h, None)}


def test_propagation(spark):
    rows = pages()
    blocked = brute(rows)
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {r.host for r in got.values() if r.rule is None and r.verdict == "block"} == {h for h in blocked if h not in ("bad.net",)} & {r.host for r in got.values() if r.rule is None}
    assert got[3].verdict == "block" and got[7].verdict == "allow"


def test_empty(spark):
    assert urls.judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hundreds_of_hosts_that_link_to_one_blocked_host(spark):
    link = lambda h: f'<a href="https://{h}/x">'
    rows = [(0, "http://hub.net/es/", None, 0)] + [(i, f"http://l{i}.org/", link("hub.net"), 0) for i in range(1, 401)]
    rows += [(500, "http://good.com/", " ".join(link(f"p{i}.org") for i in range(300)), 0)] + [(600 + i, f"http://p{i}.org/", "", 0) for i in range(300)]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {got[i] for i in range(401)} == {"block"} and {got[i] for i in (500, *range(600, 900))} == {"allow"}


def few_bad_links():
    link = lambda *hosts: " ".join(f'<a href="https://{h}/x">' for h in hosts)
    good = [f"good{i}.com" for i in range(50)]
    rows = [(i, f"http://{h}/", "", 0) for i, h in enumerate(good)] + [(100, "http://bad.net/es/", "", 0)]
    return rows + [(101, "http://small.org/", link(*good, "bad.net"), 0), (102, "http://half.org/", link("good1.com", "bad.net"), 0), (103, "http://far.org/", link("half.org"), 0)]


def test_one_bad_link_among_many_is_no_reason(spark):
    rows = few_bad_links()
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[101], got[102], got[103], got[100]) == ("allow", "block", "block", "block")
    assert brute(rows) == {"bad.net", "half.org", "far.org"}


def test_odd_pages(spark):
    far = "x" * 2_000_000 + '<a href="https://bad.net/">'
    rows = [(1, "http://bad.net/es/", None, 5), (2, "http://long.org/", far, None), (3, "http://none.org/", None, 1), (None, None, None, None)]
    names = "page_id long, url string, html string, by_rule int, host string, verdict string"
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame([(*r, "x", "y") for r in rows], names)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", None: "allow"}


def test_far_links_and_rounds(spark):
    chain = [(i, f"http://c{i}.org/", f'<a href="https://c{i + 1}.org/">', 0) for i in range(15)] + [(15, "http://c15.org/", '<a href="//end.net/">', 0), (16, "http://end.net/fr/", "", 0)]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(chain, SCHEMA)).collect()}
    assert {v for v in got.values()} == {"block"}  # more than eight links away, too
    assert urls.DAMPING**urls.ROUNDS <= urls.TOLERANCE


def test_sql(spark, tmp_path):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).parents[1]))
    from oracle import connect, differences

    spark.createDataFrame(pages() + few_bad_links(), SCHEMA).write.parquet(str(tmp_path / "pages.parquet"))
    assert not differences(spark, connect(tmp_path), tmp_path, lambda s, d: urls.judge(s.read.parquet(f"{d}/pages.parquet")), urls.ORACLE_SQL)
