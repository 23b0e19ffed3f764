import numpy as np
import pytest
from pyspark.sql import functions as F

from lapstar.llm import urls
from lapstar.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http:///x", "https://A.Example.NET/en/1?x#y", "https://example.net/EN/1", "x://net/",
    "x://net", "x://a.net?q=/en/", "x://notexample.com/de/1", "x://Example.com/de/", "x://example.com/de", "a://b://c.org/fr/x",
    "http://org/fr/#", "http://sub.org/fr", "http://example.net./en/1", "http://ÄÖ.net/é", "http://user@net:80/a", "http://.net/a",
    "http://x.org/a\nb", "http://same.example/path", "http://same.example/path?utm=1", "http://once.example/path",
]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    best = None
    for rule in rules:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.text) > len(best.text):
                best = rule
    return host, path, best


def pages(spark, found):
    return spark.createDataFrame([(i, u, "<p>", "k", "b") for i, u in found], "page_id long, url string, html string, key string, host string")


@pytest.mark.parametrize("rules", [URL_RULES, [], [*URL_RULES, urls.Rule("net", "/a", "allow"), urls.Rule("", "/", "block")]])
def test_against_all_rules(spark, rules):
    found = list(enumerate(URLS)) + [(3, URLS[3]), (None, URLS[5]), (None, None)]
    frame = pages(spark, found)
    listed = urls.repeated_urls(frame)
    rows = urls.judge(frame, rules, listed).collect()
    want = []
    for page_id, url in found:
        host, path, rule = brute(url, [r for r in rules if r.host])
        verdict = rule.verdict if rule else "block" if (host, path) == ("same.example", "/path") else "allow"
        want.append((page_id, host, path, rule.text if rule else None, verdict))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    unlisted = urls.judge(frame, rules).collect()
    assert {r["verdict"] for r in unlisted if r["rule"] is None} == {"allow"}
    assert urls.judge(frame.limit(0), rules, listed).collect() == []


def test_collisions_are_told_apart(tmp_path):
    entries = ["a", "b", "c", "dd", "a"]
    digests = np.array([7, 7, 7, 2**64 - 1, 7], np.uint64)
    for array in (urls.DigestArray.build(entries, digests), urls.DigestArray.build(entries, digests).mapped(str(tmp_path))):
        probes = ["b", "c", "x", "dd", "a", "e"]
        found = array.find(probes, np.array([7, 7, 7, 2**64 - 1, 7, 9], np.uint64)).tolist()
        assert found[:4] == [1, 2, -1, 3] and found[4] in (0, 4) and found[5] == -1
    assert urls.DigestArray.build([]).find(["a"]).tolist() == [-1]


def test_many_entries(spark, monkeypatch):
    monkeypatch.setattr(urls, "PART_ENTRIES", 50)
    listed = spark.range(0, 4000, 2).select(F.concat(F.lit("h/"), "id").alias("key"))
    keys = spark.range(4000).select(F.concat(F.lit("h/"), "id").alias("key"))
    found = urls.found_in(keys, listed.union(listed), 4000).collect()
    assert sorted(r["key"] for r in found) == sorted(f"h/{i}" for i in range(0, 4000, 2))


def test_digests_are_those_of_spark(spark):
    texts = ["", "a", "é.example/x", "x" * 100]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("d")).collect()
    assert [r["d"] % 2**64 for r in rows] == [urls.digest(t) for t in texts]


def test_long_lists_of_rules(spark, monkeypatch):
    """Beyond the limit rules are dealt into parts; the rows are the same."""
    monkeypatch.setattr(urls, "RULE_LIMIT", 2)
    monkeypatch.setattr(urls, "PART_ENTRIES", 5)
    found = list(enumerate(URLS)) + [(3, URLS[3]), (None, URLS[5]), (None, None)]
    rules = [*URL_RULES, *[urls.Rule(f"h{i}.org", "/" * (i % 3), "block") for i in range(60)], urls.Rule("net", "/a", "allow")]
    found += [(100 + i, f"http://www.h{i}.org//x") for i in range(0, 60, 7)]
    want = []
    for page_id, url in found:
        host, path, rule = brute(url, rules)
        want.append((page_id, host, path, rule.text if rule else None, rule.verdict if rule else "allow"))
    assert sorted(map(tuple, urls.judge(pages(spark, found), rules).collect()), key=repr) == sorted(want, key=repr)


def test_the_array_decides(spark):
    """Rules whose texts are equal but for the border of host and path are told apart."""
    rules = [urls.Rule("a.b", "/c", "block"), urls.Rule("a", "/", "allow")]
    found = [(1, "x://a.b/c"), (2, "x://a/.b/c"), (3, "x://b/c"), (4, "x://z.a.b/cd"), (5, "x://a.b")]
    rows = sorted(map(tuple, urls.judge(pages(spark, found), rules).collect()))
    assert [r[3] for r in rows] == ["a.b/c", "a/", None, "a.b/c", None]


def test_anonymous_map():
    array = urls.DigestArray.build([f"k{i}" for i in range(100)] + [""]).mapped()
    assert array.find([f"k{i}" for i in range(0, 200, 9)] + [""]).tolist() == [i if i < 100 else -1 for i in range(0, 200, 9)] + [100]
