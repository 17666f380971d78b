import random

from edgeframe.llm import urls


def _plain(rules, host, path):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: r.length, default=None)


def test_trie_against_all_rules():
    rng = random.Random(0)
    hosts = ["org", "example.org", "a.example.org", "com", "x.com", ""]
    paths = ["", "/", "/e", "/en/", "/en/1", "/en", "/en/12/x", "//"]
    for _ in range(300):
        rules = [
            urls.Rule(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths))
            for _ in range(rng.randint(0, 8))
        ]
        trie = urls.Trie(rules)
        for _ in range(20):
            host = rng.choice(["", "b.", "b..", "."]) + rng.choice(hosts)
            path = rng.choice(paths) + rng.choice(["", "1", "/x", "2/x/y"])
            assert trie.longest(host, path) == _plain(rules, host, path)


def test_host_and_path():
    cases = {
        "http://A.Example.ORG/x?y#z": ("a.example.org", "/x"),
        "http://host?x/y": ("host", ""),
        "http://host#x": ("host", ""),
        "http://host": ("host", ""),
        "no mark/x": ("", ""),
        "a://b://c": ("b:", "//c"),
        "://É.org/É?": ("É.org", "/É"),
        None: ("", ""),
        "": ("", ""),
    }
    for url, wanted in cases.items():
        assert urls.host_and_path(url) == wanted


RULES = [urls.rule("allow", "org/"), urls.rule("block", "example.org/es/"), urls.rule("block", "example.org/en/1")]


def _pages(spark):
    rows = [
        (1, "http://example.org/es/1", 0),
        (2, "http://x.example.org/en/15?a", 0),
        (3, "http://other.org/es/", 0),
        (4, "http://a.net/", 0),
        (5, None, 0),
        (5, None, 0),
        (None, "http://example.org", 0),
        (7, "http://example.org/" + "x" * 20_000, 0),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, Host int")


def test_verdicts(spark):
    found = urls.judged(_pages(spark), RULES, carry=["page_id"])
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    got = sorted([(r.page_id, r.rule, r.verdict) for r in found.collect()], key=str)
    assert got == sorted(
        [
            (1, "example.org/es/", "block"),
            (2, "example.org/en/1", "block"),
            (3, "org/", "allow"),
            (4, None, "allow"),
            (5, None, "allow"),
            (5, None, "allow"),
            (None, None, "allow"),
            (7, "org/", "allow"),
        ],
        key=str,
    )


def test_long_rule_lists_are_applied_in_parts(spark):
    whole = sorted(map(tuple, urls.judged(_pages(spark), RULES, carry=["page_id"]).collect()), key=str)
    for order in (RULES, RULES[::-1]):
        parts = urls.judged(_pages(spark), order, carry=["page_id"], most=1)
        assert sorted(map(tuple, parts.collect()), key=str) == whole


def test_filter_and_edges(spark):
    kept = urls.filtered(_pages(spark), RULES)
    assert kept.columns == ["page_id", "url", "Host"] and kept.count() == 6
    assert urls.filtered(_pages(spark), [], default="block").count() == 0
    assert urls.judged(_pages(spark).where("false"), RULES).count() == 0
