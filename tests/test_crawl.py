"""The crawl over landed pages against a breadth-first search in plain Python."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from watchloom.operators import crawl

PAGES = [
    ("http://A.example/", '<a href="/x/1">1</a> <a href=\'x/2?q=1#f\'>2</a> <a href="mailto:me@a.example">m</a> <a href="http://b.example/z">b</a>'),
    ("https://a.example/x/1", '<a href="3.html">3</a> <a href="//a.example/y/">y</a> <a href="https://A.EXAMPLE/x/2/">same</a>'),
    ("http://a.example/x/2?page=2", '<a href="/deep/er/one">d</a> <a href="#top">t</a> <a href="">e</a>'),
    ("http://a.example/y", "no links"),
    ("http://b.example/z/q?x", '<a href="/">home</a>'),
    ("http://b.example/z/q#again", None),
    ("http://c.example", ""),
    (None, "<a href='/lost'>"),
]


def test_links_become_places(spark):
    base = "http://Host.example/dir/page.html?x=1"
    cases = {"/a/b/": "host.example/a/b", "c": "host.example/dir/c", "../up": "host.example/dir/../up", "//Other.example/p#f": "other.example/p", "HTTPS://Q.example/p?x": "q.example/p", "mailto:x@y": None, "javascript:go()": None, "?page=2": "host.example/dir", "/": "host.example"}
    df = spark.createDataFrame([(base, h) for h in cases], "base string, href string").select("href", crawl.resolved(F.col("base"), F.col("href")).alias("p"))
    assert {r.href: r.p for r in df.collect()} == cases
    root = spark.createDataFrame([("http://h.example", "c")], "base string, href string").select(crawl.resolved(F.col("base"), F.col("href")).alias("p"))
    assert root.first().p == "h.example/c"


@pytest.mark.parametrize(("depth", "most"), [(0, 9), (1, 100), (2, 100), (2, 4), (3, 5), (5, 100)])
def test_crawl_by_brute_force(spark, depth, most):
    pages = spark.createDataFrame(PAGES, "url string, html string").repartition(3)
    edges = crawl.edges(pages)
    graph = defaultdict(set)
    for r in edges.collect():
        graph[r.src].add(r.dst)
    assert "a.example/x/2" in graph["a.example"] and "a.example/x" in graph["a.example/x/1"] and not any(d.startswith("b.") for d in graph["a.example"])
    want = {}
    for domain, start in (("a.example", "a.example"), ("b.example", "b.example/z/q"), ("c.example", "c.example")):
        seen, level = {start: 0}, [start]
        for d in range(1, depth + 1):
            new = sorted({y for x in level for y in graph[x]} - seen.keys())[: most - len(seen)]
            seen |= dict.fromkeys(new, d)
            level = new
        want |= {(domain, p): d for p, d in seen.items()}
    got = crawl.crawl(crawl.entries(pages), edges, depth, most)
    assert {(r.domain, r.place): r.depth for r in got.collect()} == want and got.count() == len(want)
    landed = {r.place: r.landed for r in crawl.with_pages(got, pages).collect()}
    assert landed["b.example/z/q"] == 2 and Counter(landed.values())[0] == len(want) - sum(v > 0 for v in landed.values())


def test_no_pages(spark):
    none = spark.createDataFrame([], "url string, html string")
    assert crawl.crawl(crawl.entries(none), crawl.edges(none)).count() == 0
