import random
import re

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import url_filter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def judge(url, rules):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, None, "allow")
    return host, path, best[1], best[2]


def run(spark, urls, rules=RULES):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "url AS host", "1 AS keys")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_filter(pages, table).collect()}


def test_contract_rules(spark):
    urls = [None, "", "no scheme", "http://", "http:///x", "HTTP://A.Example.NET/en/1", "http://example.net/en", "http://net/",
            "http://net", "http://x.net?q=/en/", "http://example.com/de/a", "http://notexample.com/de/a", "http://org/fr/#x",
            "https://a.b.org/fr/x?y", "http://x.org/en/", "http://É.net/ü", "ftp://u@example.com:80/de/", "a://b.net/c://d.org/fr/",
            "http://example.com/de/\nnext", "http://a..net/", "http://.net/x"]
    assert run(spark, urls) == {i: judge(u, RULES) for i, u in enumerate(urls)}


def test_many_rules_and_a_large_universe(spark):
    rng = random.Random(4)
    hosts = [f"h{i}.site{i % 40}.{rng.choice(['net', 'org', 'com'])}" for i in range(400)]
    paths = ["/", "/a/", "/a/b/", "/de/"]
    rules = list({(rng.choice(hosts + ["site3.net", "net"]), rng.choice(paths)): rng.choice(["block", "allow"])
                  for _ in range(300)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{rng.choice(['', 'www.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.randint(0, 9)}" for _ in range(1500)]
    assert run(spark, urls, rules) == {i: judge(u, rules) for i, u in enumerate(urls)}


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    listed = keys.filter("hash(key) % 7 = 0")
    levels = url_filter.cascade(keys, listed, "key", 5000)
    assert len(levels) > 2
    wrong = keys.withColumn("got", url_filter.is_listed(F.col("key"), levels)).filter("got <> (hash(key) % 7 = 0)")
    assert wrong.count() == 0
    assert "Join" not in wrong._jdf.queryExecution().executedPlan().toString()


def test_sizes_are_bounded(spark):
    keys = spark.range(10).select(F.col("id").cast("string").alias("key"))
    with pytest.raises(ValueError):
        url_filter.cascade(keys, keys, "key", 10, max_listed=5)


def test_empty(spark):
    assert run(spark, []) == {}
    assert run(spark, ["http://a.net/"], []) == {0: ("a.net", "/", None, "allow")}
