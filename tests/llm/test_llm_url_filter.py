import random

import pytest

from curato.llm import url_filter as U


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), ".".join(reversed(h.split("."))).encode() + b"#" + p.encode() + b"\xff", h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


def judged(spark, urls, rules, **kw):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string")
    table = U.rule_table(spark, rules)
    rows = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(pages, table, **kw).collect()}
    return [rows[i] for i in range(len(urls))]


URLS = [None, "", "no scheme", "http://", "http://ORG", "http://org/", "https://www.Example.org/es/1?q#f",
        "https://example.org/en/123", "https://example.org/en/2", "https://notexample.org/es/", "http://a.com/fr/x",
        "http://a.com/de", "http://a.com/de/", "http://com/de/?x", "http://example.org./es/", "http://example.org:80/es/",
        "http://x.example.org?/es/", "x://y://example.org/es/", "http://É.org/É", "http://" + "a." * 100 + "org/" + "p" * 5000,
        "http://org/", "http://org/", "http://a#b/org/", "http://or g/x", "http://example.org/es/\U0010FFFF"]


def test_contract_rules(spark):
    assert judged(spark, URLS, U.CONTRACT_RULES) == [brute(u, U.CONTRACT_RULES) for u in URLS]


def test_nested_rules_against_brute_force(spark):
    rng = random.Random(5)
    labels, paths = ["a", "b", "ab", "c"], ["", "/", "/a", "/a/", "/ab", "/a/b", "/b/a/c"]
    hosts = [".".join(rng.choices(labels, k=rng.randint(1, 4))) for _ in range(60)]
    rules, seen = [], set()
    for h in hosts:
        p = rng.choice(paths)
        if (h, p) not in seen:
            seen.add((h, p))
            rules.append((rng.choice(["allow", "block"]), h, p))
    urls = [f"http://{rng.choice(hosts)}{rng.choice(['', '.x', '.a'])}{rng.choice(paths)}{rng.choice(['', 'q', '?z'])}"
            for _ in range(400)]
    got = judged(spark, urls, rules, default="block")
    for u, g in zip(urls, got, strict=True):
        host, path, rule, verdict = brute(u, rules, "block")
        assert g == (host, path, rule, verdict)     # also where rules of one length fit together
        if rule is None:
            assert g[3] == "block"


def test_block_wins_over_allow_and_empty_tables(spark):
    rules = [("allow", "a.b", "/x"), ("block", "a.b", "/x")]
    assert judged(spark, ["http://a.b/x"], rules) == [("a.b", "/x", "a.b/x", "block")]
    assert judged(spark, ["http://a.b/x", None], []) == [("a.b", "/x", None, "allow"), ("", "", None, "allow")]
    assert judged(spark, [], rules) == []
    loose = spark.createDataFrame([("block", None, "/x"), ("block", "", "/x"), ("block", "a.b", None)],
                                  "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.b/x")], "page_id long, url string")
    assert U.judge_urls(pages, loose).collect()[0].rule == "a.b"
    with pytest.raises(ValueError):
        U.rule_table(spark, [("block", "", "/x")])
