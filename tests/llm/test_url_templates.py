"""Hosts, rules and templates against plain Python."""

import random
import string

from surveylake.llm import url_templates as urls
from surveylake.llm.queries import URL_RULES


def brute(url):
    whole = url or ""
    if "://" not in whole:
        return "", "", None, None
    rest = whole.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    host = "".join(c.lower() if c in string.ascii_uppercase else c for c in host)
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for rule in URL_RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.host + rule.path) > len(best.host + best.path):
                best = rule
    return host, path, best and best.host + best.path, best and best.verdict


CASES = [
    None, "", "no scheme", "://", "http://", "http://A.Example.ORG/es/1?x#y", "http://example.org", "http://example.org/en/12", "a://b://c/d",
    "http://xexample.org/es/", "https://m.com/fr/1", "https://m.com/de/1", "https://com/de/", "http://ÀB.org/é#", "http://h?q/x", "http://h#f://g",
    "x\n://a.com/de/\n?z",
]


def judged(spark, rows):
    return urls.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES)


def test_parts_and_rules(spark):
    rng = random.Random(1)
    cases = CASES + ["".join(rng.choice(["http", "://", "/", "?", "#", "a", "COM", ".", "com", "org", "/fr/", "/de/", "/en/1"]) for _ in range(8)) for _ in range(400)]
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged(spark, list(enumerate(cases))).collect()}
    for i, url in enumerate(cases):
        host, path, rule, verdict = brute(url)
        assert rows[i][:3] == (host, path, rule) and rows[i][3] == (verdict or rows[i][3])
        assert rows[i][3] in ("allow", "block")


def test_templates_generalise_and_carry_labels_to_other_hosts(spark):
    rows = [(i, f"http://h{i % 5}.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(400)]
    rows += [(1000 + i, f"http://n.net/{'de' if i % 2 else 'fr'}/{i}") for i in range(40)]
    rows += [(2000 + i, f"http://h1.com/{'de' if i % 2 else 'fr'}x/{i}?a") for i in range(10)]
    found = {r.page_id: r for r in judged(spark, rows).collect()}
    assert len(found) == len(rows)
    assert {found[i].template for i in range(400)} == {"/de/*", "/fr/*"}
    assert found[0].block_rate < 0.1 and found[1].block_rate > 0.9


def test_variable_segments_are_one_wildcard(spark):
    rows = [(i, f"http://a.com/fr/{chr(97 + i % 26)}{chr(97 + i // 26)}/p{i}") for i in range(300)]
    assert {r.template for r in judged(spark, rows).collect()} == {"/*/*/*"}


def test_without_labels_all_is_allowed_and_depth_is_no_limit(spark):
    deep = "http://q.net/" + "/".join("abcdefghijklmnop")
    rows = [(1, deep), (1, deep), (None, None), (3, "http://q.net/")]
    assert [r.verdict for r in judged(spark, rows).collect()] == ["allow"] * 4
    assert judged(spark, []).count() == 0


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.com/de/", 2, "x")], "page_id long, url string, salt int, host string")
    assert urls.judge(pages, URL_RULES).first().verdict == "block"


def test_hosts_without_labels_take_literal_branches_from_elsewhere(spark):
    rows = [(i, f"http://h{i % 5}.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(400)]
    rows += [(1000 + i, f"http://n.net/{'de' if i % 2 else 'fr'}/{i}") for i in range(40)]
    rows += [(2000, "http://small.com/de/1"), (2001, "http://small.com/de/2"), (2002, "http://small.com/en/3"), (2003, "http://one.net/de/4")]
    rows += [(3000 + i, f"http://h{i % 5}.com/en/{i}") for i in range(20)]
    found = {r.page_id: r for r in judged(spark, rows).collect()}
    for i in range(40):
        assert found[1000 + i].verdict == ("block" if i % 2 else "allow")
        assert found[1000 + i].template == ("/de/*" if i % 2 else "/fr/*")
    assert found[2002].template == "/*/*" and found[2000].template == "/de/*" and found[2003].verdict == "block"


def test_deep_and_rare_branches_are_judged(spark):
    rules = [urls.Rule("block", "a.com", "/1/2/3/4/5/6/7/8/9/bad/x"), urls.Rule("allow", "a.com", "/1/2/3/4/5/6/7/8/9/good/x")]
    rows = [(i, f"http://a.com/1/2/3/4/5/6/7/8/9/{'bad' if i % 2 else 'good'}/{'xy'[i // 20]}") for i in range(40)]
    found = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert all(found[i].verdict == ("block" if i % 2 else "allow") for i in range(40))
