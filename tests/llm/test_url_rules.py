from domus.llm import queries, url_rules

URLS = [None, "", "no scheme", "http://", "https://WWW.Example.COM/en/x", "https://a.example.com/en/1?q=/de/",
        "http://example.com/en", "http://example.com/en/", "http://x.net/fr/1", "http://net/es/", "http://com",
        "http://com/", "http://.com/a", "http://notcom/", "http://a.com:80/", "x://u.com?en", "ftp://b.com#/en/",
        "http://a://b.net/es/", "http://" + "a." * 3000 + "example.com/en/" + "x" * 5000, "http://ÄB.com/Ü", "http://a.com\n/x"]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    for c in "?#":
        rest = rest.split(c, 1)[0]
    host, slash, tail = rest.partition("/")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = slash + tail
    fit = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else default


def _check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "r", None) for i, u in enumerate(urls)],
                                  "page_id long, url string, rule string, Host string")
    table = url_rules.rule_table(spark, rules)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, table).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_contract_rules_on_odd_urls(spark):
    _check(spark, URLS + URLS[4:8], queries.URL_RULES)


def test_ties_deep_rules_and_no_rules(spark):
    _check(spark, URLS, [("allow", "com", "/en"), ("block", "com", "/en"), ("block", "a.example.com", ""), ("allow", "u.com", "")])
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rows = url_rules.judge_urls(pages, url_rules.rule_table(spark, queries.URL_RULES).limit(0)).collect()
    assert [(r.rule, r.verdict) for r in rows] == [(None, "allow")]
    assert url_rules.judge_urls(pages.limit(0), url_rules.rule_table(spark, queries.URL_RULES)).count() == 0
