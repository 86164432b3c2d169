from __future__ import annotations

import math

from pyspark.sql import functions as F

from vecloom.llm.hosts import judge_urls, registered_domain, reputations, site, suffix

PAGES = [
    (1, "http://a.example.com/en/x?q#f", 1),
    (2, "HTTPS://WWW.Example.com/en/1", 0),
    (3, "https://b.net/es/", None),
    (4, "https://netx/es/", 1),
    (5, None, None),
    (6, "no scheme", 1),
    (7, "x://h?/p", 1),
    (8, "http://example.com", 0),
    (8, "http://example.com", 0),
    (9, "http://É.com/", 0),
    (10, "http://sub.b.net/fr/1", 0),
    (11, "http://c.org/a://b/c", 0),
    (None, "http://example.com/enx", 1),
    *((100 + i, "http://bad.org/p", 1) for i in range(40)),
    *((200 + i, "http://good.org/p", 0) for i in range(40)),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1.0, "z") for r in rows], "page_id long, url string, outcome int, host string, n string, p double, rule string")


def test_hosts_paths_rules(spark):
    found = {r.page_id: r for r in judge_urls(table(spark, PAGES)).collect()}
    expected = {
        1: ("a.example.com", "/en/x", "example.com/en/", "block"),
        2: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        3: ("b.net", "/es/", "net/es/", "block"),
        8: ("example.com", "", None, None),
        9: ("É.com", "/", "com/", "allow"),
        10: ("sub.b.net", "/fr/1", "net/fr/", "block"),
        11: ("c.org", "/a://b/c", None, None),
        7: ("h", "", None, None),
        None: ("example.com", "/enx", "com/", "allow"),
    }
    for page, (host, path, rule, verdict) in expected.items():
        r = found[page]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert verdict is None or r.verdict == verdict
    assert (found[5].host, found[5].path, found[6].host, found[6].path) == ("", "", "", "")
    assert found[100].verdict == "block" and found[200].verdict == "allow" and found[4].rule is None
    assert judge_urls(table(spark, PAGES)).count() == len(PAGES)


def test_shrinks_step_by_step(spark):
    rows = [("a.x.com", o) for o in [1] * 8 + [0] * 2] + [("b.x.com", 0)] * 20 + [("c.y.org", 1)] * 5 + [("d.y.org", None)]
    found = {r.host: r for r in reputations(spark.createDataFrame(rows, "host string, outcome int")).collect()}

    def weight(groups):
        extra = sum((b / n - p) ** 2 * n - p * (1 - p) for n, b, p in groups)
        r = extra / sum(p * (1 - p) * (n - 1) for n, _, p in groups)
        return max(1.0, min(1000.0, 1 / r - 1 if r > 0 else 1000.0))

    total = (13 + 0.5) / (35 + 1)
    suffixes = {"com": (30, 8), "org": (5, 5)}
    w = weight([(n, b, total) for n, b in suffixes.values()])
    suffix = {k: (b + w * total) / (n + w) for k, (n, b) in suffixes.items()}
    domains = {"x.com": (30, 8, suffix["com"]), "y.org": (5, 5, suffix["org"])}
    w = weight(domains.values())
    domain = {k: (b + w * p) / (n + w) for k, (n, b, p) in domains.items()}
    hosts = {"a.x.com": (10, 8, domain["x.com"]), "b.x.com": (20, 0, domain["x.com"]), "c.y.org": (5, 5, domain["y.org"])}
    w = weight(hosts.values())
    for k, (n, b, p) in hosts.items():
        mean = (b + w * p) / (n + w)
        assert math.isclose(found[k].mean, mean, rel_tol=1e-9)
        assert math.isclose(found[k].bound, mean - 1.645 * math.sqrt(mean * (1 - mean) / (n + w + 1)), rel_tol=1e-9)
    assert math.isclose(found["d.y.org"].mean, domain["y.org"], rel_tol=1e-9)


def test_empty(spark):
    assert judge_urls(table(spark, [])).count() == 0


def test_sites_domains_suffixes(spark):
    expected = {
        "bad1.co.uk": ("bad1.co.uk", "bad1.co.uk", "co.uk"),
        "a.b.com.br.": ("a.b.com.br", "b.com.br", "com.br"),
        "co.uk": ("co.uk", "co.uk", "co.uk"),
        "t.co": ("t.co", "t.co", "co"),
        "me:pw@x.org:8080": ("x.org", "x.org", "org"),
        "10.0.0.1:80": ("10.0.0.1", "10.0.0.1", "ip"),
        "[2001:db8::1]:443": ("[2001:db8::1]", "[2001:db8::1]", "ip"),
        "a.1.2.3.4": ("a.1.2.3.4", "3.4", "4"),
        "localhost": ("localhost", "localhost", "localhost"),
        "": ("", "", ""),
    }
    hosts = spark.createDataFrame([(h,) for h in expected], "host string").withColumn("site", site(F.col("host")))
    found = hosts.select("host", "site", registered_domain(F.col("site")).alias("domain"), suffix(F.col("site")).alias("suffix")).collect()
    assert {r.host: tuple(r)[1:] for r in found} == expected


def test_neighbours_under_a_country_suffix_and_addresses_do_not_share_blame(spark):
    rows = [(i, f"http://bad{i % 4}.co.uk/p", 1) for i in range(80)] + [(100 + i, f"http://good{i % 4}.co.uk:{80 + i}/p", 0) for i in range(80)]
    rows += [(200 + i, f"http://10.0.0.1:{i}/", 1) for i in range(40)] + [(300 + i, "http://10.9.0.1/", 0) for i in range(40)]
    found = {r.page_id: r.verdict for r in judge_urls(table(spark, rows)).collect()}
    assert found == {i: "block" if outcome else "allow" for i, _, outcome in rows}
