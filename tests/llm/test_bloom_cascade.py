import random

import numpy as np
from pyspark.sql import functions as F

from spindle.llm import bloom_cascade as B

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def plain(url, listed):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
        path = rest[:end]
    under = lambda h: bool(host) and (host == h or host.endswith("." + h))
    fits = [r for r in RULES if under(r.split("/")[0]) and path.startswith("/" + r.split("/", 1)[1])]
    rule = max(fits, key=len, default=None)
    verdict = RULES[rule] if rule else "block" if any(map(under, listed)) else "allow"
    return host, path, rule, verdict


URLS = [None, "", "no scheme", "http://", "https://a.net", "https://a.net/", "HTTP://A.NET/x?y#z", "http://x.example.net/en/1", "http://example.net/en",
        "http://example.net/en/", "http://notexample.net/en/1", "https://b.example.com/de/9.html", "https://example.com/DE/", "http://c.org/fr/x", "http://c.org/en/x",
        "http://spam.example.org/en/1", "http://www.spam.example.org?x", "http://nospam.example.org/", "ftp://net/a", "a://b://c.net/", "http://.net/", "http://a..net/de/",
        "http://ÀB.org/fr/", "http://spam.example.org:80/", "http://x.y.z.w.v.u.t.spam.example.org/fr/1", "http://spam.example.org#/fr/"]


def test_rules_and_list_against_a_plain_version(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://spam.example.org"), (3, URLS[3])]
    pages = spark.createDataFrame(rows, "page_id long, url string").select("*", F.lit("x").alias("host"), F.lit("y").alias("keys"), F.lit(1).alias("listed"))
    hosts = spark.createDataFrame([("spam.example.org",), ("Spam.Example.Org",), (None,)], "host string").where("host IS NOT NULL")
    got = [tuple(r) for r in B.judge(pages, RULES, hosts).collect()]
    want = [(i, *plain(u, ["spam.example.org"])) for i, u in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_membership_is_exact_over_the_universe(spark):
    rng = random.Random(2)
    keys = [f"key {i}" for i in range(20_000)]
    listed = set(rng.sample(keys, 3_000))
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    lists = spark.createDataFrame([(k,) for k in listed], "key string")
    for how in ({}, {"rate": 0.3}, {"max_bytes": 2_000}):
        cascade = B.build(universe, lists, **how)
        assert len(cascade.levels) >= 2
        rows = universe.select(F.array("key").alias("keys"))
        got = {k for r in B.members(rows, "keys", cascade).collect() for k in r.listed}
        assert got == listed


def test_edges(spark):
    none = spark.createDataFrame([], "key string")
    keys = spark.createDataFrame([("a",), ("b",), ("a",)], "key string")
    assert B.build(keys, none).levels == []
    only = B.build(none, keys)
    h = np.array([1, 2, 3])
    assert len(only.levels) == 1 and len(only.member(h, h)) == 3
    every = B.build(keys, keys)
    got = B.members(keys.select(F.array("key", F.lit("b")).alias("keys")), "keys", every).collect()
    assert sorted(sum((r.listed for r in got), [])) == ["a", "a", "b", "b", "b", "b"]
    empty = spark.createDataFrame([], "page_id long, url string")
    hosts = spark.createDataFrame([], "host string")
    assert B.judge(empty, RULES, hosts).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in B.judge(one, {}, hosts).collect()] == [(1, "a.org", "/", None, "allow")]


def test_listed_hosts_of_many_labels(spark):
    deep = "a.b.c.d.e.f.g.h.i.example.com"
    pages = spark.createDataFrame([(1, f"http://{deep}/x"), (2, f"http://w.{deep}/"), (3, "http://b.c.d.e.f.g.h.i.example.com/")], "page_id long, url string")
    hosts = spark.createDataFrame([(deep,)], "host string")
    judged = B.judge(pages, {}, hosts).collect()
    assert {r.page_id for r in judged if r.verdict == "block"} == {1, 2}
