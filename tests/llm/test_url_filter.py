import random

from pulse.llm.url_filter import UrlFilter, judge_urls

from .brute import judge_url

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.b.c.d", "/x/y/z", "block"), ("b.c.d", "/x/y/zz", "allow"), ("com", "", "allow"), ("q.com", "/e", "block")]


def test_as_by_brute_force(spark):
    rng = random.Random(4)
    hosts = ["net", "example.net", "EXAMPLE.net", "m.example.com", "xexample.net", "org", "a.org", "a.b.c.d", "z.a.b.c.d", "b.c.d", "q.com", "", "net.", "example.net:80", "u@x.net"]
    paths = ["", "/", "/en/", "/en", "/en/1", "/de/2/", "/fr/x", "/x/y/z", "/x/y/zz/9", "/x/y/", "/e", "/eee/1", "//en/", "/EN/"]
    tails = ["", "?a=/en/", "#/fr/", "?x#y"]
    urls = [f"http://{h}{p}{t}" for h in hosts for p in paths for t in tails]
    urls += [None, "", "no scheme", "://net/", "a://b://example.net/en/", "http://net\n/x", "http:///en/", "http://" + "s." * 300 + "net/" + "p/" * 300]
    rng.shuffle(urls)
    pages = [(i, u, "old") for i, u in enumerate(urls)] + [(0, urls[0], "old")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, rule string").repartition(4)
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), RULES[0]], "rule_host string, rule_path string, rule_verdict string")
    rows = judge_urls(df, rules).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge_url(r["url"], RULES), r["url"]
    # digests decide where short prefixes collide
    for r in judge_urls(df, rules, UrlFilter(prefix_digits=1, salts=1)).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge_url(r["url"], RULES), r["url"]


def test_empty_tables(spark):
    rules = spark.createDataFrame([], "rule_host string, rule_path string, rule_verdict string")
    df = spark.createDataFrame([(1, "http://a.net/x")], "page_id bigint, url string")
    assert [tuple(r) for r in judge_urls(df, rules).collect()] == [(1, "http://a.net/x", "a.net", "/x", None, "allow")]
    assert judge_urls(df.limit(0), rules).collect() == []
