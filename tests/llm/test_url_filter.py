from stockrecon.llm import registry, url_filter
from stockrecon.sources.scratch import Shelf

SCHEMA = "page_id long, url string, html string, host string, good int"
URLS = [
    ("http://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("https://example.org/en/1?x#y", "example.org", "/en/1", "example.org/en/1", "block"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("https://example.org?p=/es/", "example.org", "", None, "allow"),
    ("ftp://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
    ("x.com/fr/a", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("http://x.com#/fr/", "x.com", "", None, "allow"),
    ("http://É.com/de/\n?q", "É.com", "/de/\n", "com/de/", "block"),
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u[0], "<p>", "clash", None) for i, u in enumerate(URLS)]
    rows.append(rows[0])
    pages = spark.createDataFrame(rows, SCHEMA)
    got = url_filter.judge_pages(pages, registry.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == URLS[r.page_id][1:]


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert url_filter.judge_pages(pages, registry.URL_RULES).count() == 0


def test_bad_hosts_are_blocked_and_lend_their_domain_a_bad_name(spark):
    rows, n = [], 0
    for host, bad, good in [("a.bad.net", 200, 0), ("b.bad.net", 150, 2), ("c.bad.net", 180, 1),
                            ("a.fine.net", 1, 90), ("b.fine.net", 0, 80), ("a.good.de", 0, 300)]:
        for k in range(bad + good):
            rows.append((n + k, f"http://{host}/{k}", "", "", int(k >= bad)))
        n += bad + good
    rows += [(n, "http://new.bad.net/", "", "", None), (n + 1, "http://new.fine.net/", "", "", None),
             (n + 2, "http://other.de/", "", "", None)]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = url_filter.judge_pages(pages, [("allow", "a.bad.net/7")], good_col="good").collect()
    verdicts = {}
    for r in got:
        verdicts.setdefault(r.host, set()).add(r.verdict)
    assert verdicts["b.bad.net"] == verdicts["c.bad.net"] == {"block"}
    assert verdicts["a.bad.net"] == {"block", "allow"}  # a rule comes first
    assert verdicts["new.bad.net"] == {"block"}
    for host in ("a.fine.net", "b.fine.net", "a.good.de", "new.fine.net", "other.de"):
        assert verdicts[host] == {"allow"}


def test_small_hosts_are_shrunk_to_their_domain(spark):
    rows = [("big.x.com", 0)] * 90 + [("big.x.com", 1)] * 10
    rows += [("s.x.com", 1)] + [("t.y.com", 1)] * 50 + [("u.y.com", 1)]
    outcomes = spark.createDataFrame(rows, "host string, good int")
    found = {r.host: r for r in url_filter.host_reputation(outcomes, Shelf(spark)).collect()}
    assert found["s.x.com"].mean < found["u.y.com"].mean
    assert abs(found["big.x.com"].mean - 0.1) < 0.05


def test_domains_and_suffixes(spark):
    hosts = {
        "a.co.uk": ("a.co.uk", "co.uk"), "x.b.co.uk:80": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"),
        "www.a.org:8080": ("a.org", "org"), "org": ("org", "org"), "": ("", ""), "b:": ("b", "b"),
        "x.y.city.zz": ("city.zz", "zz"),
    }
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    for extra, want in (((), None), (("city.zz",), ("y.city.zz", "city.zz"))):
        listed = (*url_filter.PUBLIC_SUFFIXES, *extra)
        got = frame.select(
            "host", url_filter.domain_of(frame.host, listed), url_filter.suffix_of(frame.host, listed)
        ).collect()
        for host, domain, suffix in got:
            assert (domain, suffix) == (want if want and "city" in host else hosts[host])


def test_neighbours_under_a_public_suffix_do_not_share_a_name(spark):
    rows = [(k, f"http://www.bad.co.uk:80/{k}", "", "", 0) for k in range(300)]
    rows += [(300 + k, f"http://www.fine.co.uk/{k}", "", "", 1) for k in range(300)]
    rows += [(900, "http://new.bad.co.uk/", "", "", None), (901, "http://www.bad.co.uk/", "", "", None),
             (902, "http://other.co.uk/", "", "", None),
             (903, "http://x.com/" + "y" * 2_000_000, "", "", None)]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = url_filter.judge_pages(pages, [], good_col="good").collect()
    verdict = {r.page_id: r.verdict for r in got}
    assert verdict[900] == verdict[901] == "block"  # the port is not part of the domain
    assert verdict[902] == verdict[903] == "allow" and len(got) == len(rows)
