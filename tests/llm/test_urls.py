"""Cascades against sets, rules against a plain loop."""

import numpy as np
from pyspark.sql import functions as F

from candlewick.llm import urls


def test_cascade_is_exact(spark):
    rng = np.random.default_rng(5)
    every = sorted({f"k{i}" for i in rng.integers(0, 10**6, 6000)})
    listed = every[::7]
    universe = spark.createDataFrame([(k,) for k in every] + [(None,)], "key string")
    cascade = urls.Cascade.of(spark.createDataFrame([(k,) for k in listed + listed[:5]], "key string"), universe)
    assert len(cascade.levels) > 2 and sum(level.size for level in cascade.levels) < 40 * len(listed)
    got = {r.key for r in universe.where(cascade.holds(F.col("key"))).collect()}
    assert got == set(listed)
    none = urls.Cascade.of(spark.createDataFrame([], "key string"), universe)
    assert universe.where(none.holds(F.col("key"))).count() == 0


ODD = [
    (1, "http://A.Example.NET/en/x?y#z"), (2, "https://net"), (3, "http://net/"), (4, None), (5, ""), (6, "no scheme/en/"),
    (7, "http://x.org/fr/"), (8, "http://xorg/fr/"), (9, "http://a.b.c.example.com/de/1"), (10, "http://example.com#/de/"),
    (11, "://net/q"), (12, "http://u:p@h.net:80/"), (None, "http://b.net/en/"), (13, "http://x/a://y.net/"), (14, "http://" + "a." * 3000 + "net/" + "p" * 9000),
    (1, "http://A.Example.NET/en/x?y#z"), (15, "http://É.net/é\nf"),
]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    whole = rest.split("#")[0].split("?")[0]
    host, path = whole.split("/")[0], whole[len(whole.split("/")[0]) :]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fit, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_rules_on_odd_urls(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("b.net", "", "allow")]
    pages = spark.createDataFrame([(i, u, u) for i, u in ODD], "page_id long, url string, host string")
    got = urls.judge(pages, urls.rule_table(spark, rules)).collect()
    want = sorted((str(i), *map(str, plain(u, rules))) for i, u in ODD)
    assert sorted(tuple(map(str, r)) for r in got) == want
    assert {r.verdict for r in urls.judge(pages, urls.rule_table(spark, rules).limit(0)).collect()} == {"allow"}
    assert urls.judge(pages.limit(0), urls.rule_table(spark, rules)).count() == 0


def test_many_rules_and_one_verdict_for_each(spark):
    rules = [(f"h{i}.com", f"/{i % 3}", "block" if i % 2 else "allow") for i in range(300)]
    pages = [(i, f"http://x.h{i}.com/{i % 4}/a") for i in range(400)]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), urls.rule_table(spark, rules)).collect()
    assert sorted(tuple(map(str, r)) for r in got) == sorted((str(i), *map(str, plain(u, rules))) for i, u in pages)


def test_a_list_of_more_keys_than_a_cascade_holds(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_KEYS", 100)
    rules = [(f"h{i}.com", f"/{i % 3}", "block" if i % 2 else "allow") for i in range(440)]
    pages = [(i, f"http://x.h{i}.com/{i % 4}/a") for i in range(500)]
    universe = spark.createDataFrame([(f"k{i}",) for i in range(900)], "key string")
    listed = universe.where("key LIKE '%3%'")
    cascade = urls.Cascade.of(listed, universe)
    assert len(cascade.cascades) == 3
    assert {r.key for r in universe.where(cascade.holds(F.col("key"))).collect()} == {r.key for r in listed.collect()}
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), urls.rule_table(spark, rules)).collect()
    assert sorted(tuple(map(str, r)) for r in got) == sorted((str(i), *map(str, plain(u, rules))) for i, u in pages)
