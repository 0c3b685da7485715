import re

import math

import pytest
from pyspark.sql import functions as F

from lectern.llm import urls
from lectern.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http://net", "http://x.NET/", "http://x.net?q=/en/", "https://a.b.example.net/en/1#f",
    "https://example.net/en", "https://badexample.net/en/2", "http://example.com/de/x?y", "http://example.com/DE/x", "http://de.org/fr/",
    "http://org/fr/1", "http://org.example.com/fr/1", "http://a://b.org/fr/", "x://Ünï.net/é\nb", "http://example.net./en/", "http://.net/a",
    "http://" + "a." * 3000 + "net/" + "p" * 20_000,
]
URLS += [f"http://h{i % 17}.example.{'net' if i % 2 else 'com'}/{'en' if i % 3 else 'de'}/{i}" for i in range(300)]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and (m := re.search(r"://([^/?#]*)([^?#]*)", url)):
        host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1])
        path = m[2]
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if ("." + host).endswith("." + h) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def rules_of(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, action string")


@pytest.mark.parametrize("bits", [urls.MOST_BITS, 1])
def test_rules_match_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(urls, "MOST_BITS", bits)
    pages = spark.createDataFrame([(i, u, "net/", "v") for i, u in enumerate([*URLS, URLS[5]])], "page_id long, url string, rule string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, rules_of(spark, URL_RULES)).collect()}
    assert len(got) == len(URLS) + 1
    for i, u in enumerate([*URLS, URLS[5]]):
        assert got[i] == brute(u, URL_RULES), u
    assert urls.judge(pages.limit(0), rules_of(spark, URL_RULES)).count() == 0
    none = urls.judge(pages, rules_of(spark, URL_RULES).limit(0))
    assert none.where("rule IS NULL AND verdict = 'allow'").count() == len(URLS) + 1


def test_cascade_is_exact_with_false_positives(spark, monkeypatch):
    monkeypatch.setattr(urls, "FIRST", (1, 1))
    monkeypatch.setattr(urls, "BELOW", (1, 1))
    universe = spark.range(5000).selectExpr("concat('k', id) AS key")
    listed = universe.where("key RLIKE '7$'")
    cascade = urls.Cascade(listed, universe)
    assert len(cascade.levels) > 3
    wrong = universe.where(cascade.has(F.col("key")) != F.col("key").rlike("7$"))
    assert wrong.count() == 0
    plan = universe.select(cascade.has(F.col("key")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0] and "Python" not in plan


def test_no_list(spark):
    universe = spark.range(3).selectExpr("cast(id AS string) AS key")
    assert universe.where(urls.Cascade(universe.limit(0), universe).has(F.col("key"))).count() == 0


def test_first_level_keeps_the_next_small():
    """However large the universe, it takes about as many keys wrongly as are listed."""
    for keys, universe in ((4, 10), (4, 10**11), (10**6, 10**11)):
        bits, hashes = urls.first_level(keys, universe)
        assert universe * (1 - math.exp(-hashes / bits)) ** hashes <= 1.1 * keys + 1


def test_too_long_a_list_is_joined_with_the_same_result(spark, monkeypatch):
    rows = [(i, f"https://{h}/{p}x?q") for i, (h, p) in enumerate((h, p) for h in ("a.net", "example.net", "www.example.com", "x.org") for p in ("en/", "de/", "fr/", ""))]
    pages = spark.createDataFrame([*rows, (99, None), (100, "no scheme")], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")], "host string, path string, action string")
    want = sorted(map(tuple, urls.judge(pages, rules).collect()))
    monkeypatch.setattr(urls, "MOST_BITS", 32)
    assert sorted(map(tuple, urls.judge(pages, rules).collect())) == want and {r[4] for r in want} == {"allow", "block"}
