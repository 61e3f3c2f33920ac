"""Reconnaissance of landed pages: breadth first from each domain's entry page, over links and folders.

A place is a host and a path, without scheme, query, fragment and closing slash. Two places are neighbours where a page of the first links to the second, or
where one is the folder of the other. A level is one join of the frontier with the edges and one anti-join with what was seen; all domains go side by side.
A domain stops at ``depth`` levels and ``most`` places; within a level places come in the order of their names. Links to other hosts don't count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut

HREF = r"""href=["']([^"']*)["']"""
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def place(url: Column) -> Column:
    """Host and path."""
    bare = F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//|[?#].*$", "")
    return F.concat(F.lower(F.regexp_extract(bare, r"^[^/]*", 0)), F.regexp_extract(bare, r"^[^/]*(.*?)/*$", 1))


def host_of(place_: Column) -> Column:
    return F.substring_index(place_, "/", 1)


def resolved(base: Column, href: Column) -> Column:
    """The place of a link on a page at the URL ``base``; null for what isn't a page (mail, scripts)."""
    link = F.trim(href)
    host = F.regexp_extract(base, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", 0)
    folder = F.regexp_extract(base, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(?:[^?#]*/)?", 0)
    before = F.when(link.rlike(r"^(?i)(?:https?:)?//"), F.lit("")).when(link.rlike(SCHEME), None).when(link.startswith("/"), host).otherwise(F.concat(F.rtrim(folder, F.lit("/")), F.lit("/")))
    return place(F.concat(before, link))


def edges(pages: DataFrame) -> DataFrame:
    """``(src, dst)`` between places of one host: links of ``pages(url, html)``, and folders both ways."""
    p = pages.where("url is not null").select("url", "html", place(F.col("url")).alias("src"))
    links = p.select("src", "url", F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("href")).where(F.regexp_replace(F.trim("href"), "#.*$", "") != "").select("src", resolved(F.col("url"), F.col("href")).alias("dst"))
    parts = F.split("src", "/")
    steps = F.transform(F.sequence(F.lit(2), F.size("parts")), lambda i: F.struct(F.array_join(F.slice("parts", F.lit(1), i - 1), "/").alias("up"), F.array_join(F.slice("parts", F.lit(1), i), "/").alias("down")))
    folders = p.select("src").distinct().select(parts.alias("parts")).where(F.size("parts") > 1).select(F.explode(steps).alias("s")).select("s.*").distinct()
    both = folders.select(F.col("up").alias("src"), F.col("down").alias("dst")).unionByName(folders.select(F.col("down").alias("src"), F.col("up").alias("dst")))
    return links.unionByName(both).where((host_of(F.col("src")) == host_of(F.col("dst"))) & (F.col("src") != F.col("dst"))).distinct()


def entries(pages: DataFrame) -> DataFrame:
    """``(domain, place)``: the first landed place of each host."""
    p = pages.where("url is not null").select(place(F.col("url")).alias("place"))
    return p.groupBy(host_of(F.col("place")).alias("domain")).agg(F.min("place").alias("place"))


def crawl(seeds: DataFrame, links: DataFrame, depth: int = 2, most: int = 100) -> DataFrame:
    """``(domain, place, depth)`` of ``seeds(domain, place)`` over ``links(src, dst)``."""
    links = cut(links)
    first = Window.partitionBy("domain").orderBy("place")
    seen = cut(seeds.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= most).select("domain", "place", F.lit(0).alias("depth")))
    for d in range(1, depth + 1):
        frontier = seen.where(F.col("depth") == d - 1).select("domain", F.col("place").alias("src"))
        found = frontier.join(links, "src").select("domain", F.col("dst").alias("place")).distinct().join(seen, ["domain", "place"], "left_anti")
        room = seen.groupBy("domain").agg((F.lit(most) - F.count("*")).alias("room"))
        ranked = found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= most)  # a task keeps so many of each domain before they meet
        new = ranked.join(room, "domain").where(F.col("n") <= F.col("room")).select("domain", "place", F.lit(d).alias("depth"))
        seen = cut(seen.unionByName(new))
    return seen


def with_pages(found: DataFrame, pages: DataFrame) -> DataFrame:
    """``found`` with ``landed``: how many pages lie at a place; 0 is what would have to be fetched."""
    n = pages.where("url is not null").groupBy(place(F.col("url")).alias("place")).agg(F.count("*").alias("landed"))
    return found.join(n, "place", "left").withColumn("landed", F.coalesce("landed", F.lit(0)))
