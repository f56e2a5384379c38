"""Crawling a table of pages: frontier, links, fetching by join, visited sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import dates, urls
from corpusloom.operators.order import cut_lineage


def page_links(pages: DataFrame, accept: str | None = None, reject: str | None = None) -> DataFrame:
    """Distinct links of every page, in order: url, pos, link."""
    return pages.select("url", F.posexplode(urls.links(F.col("url"), F.col("html"), accept, reject)).alias("pos", "link")).withColumn("pos", F.col("pos").cast("long"))


def judged_urls(frontier: DataFrame, accept: str | None, reject: str | None, replacements: list[tuple[str, str]] | None = None) -> DataFrame:
    """Adds status (accepted or rejected) and, for accepted ones, the rewritten address to ``frontier(url)``."""
    ok = urls.accepted(F.col("url"), accept, reject)
    return frontier.withColumn("status", F.when(ok, "accepted").otherwise("rejected")).withColumn("target", F.when(ok, urls.rewrite(F.col("url"), replacements or [])))


def unseen(links: DataFrame, *seen: DataFrame) -> DataFrame:
    """Distinct new urls of ``links(url)``: exact, by anti-join."""
    new = links.select("url").filter("url is not null").distinct()
    for table in seen:
        new = new.join(table.select("url"), "url", "left_anti")
    return new


def fetched(frontier: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fetching from a table: the pages of ``frontier(url)``, and the urls that have none."""
    return frontier.join(pages, "url"), frontier.join(pages.select("url"), "url", "left_anti")


def dated(pages: DataFrame, start: str, end: str, pattern: str = dates.DATE_PATTERN, compat: bool = False) -> DataFrame:
    """Adds the latest date of ``pages(html)`` and whether it lies in the window; a page without any date doesn't."""
    latest = pages.withColumn("latest", dates.latest(F.col("html"), pattern))
    return latest.withColumn("in_window", dates.in_window(F.col("latest"), start, end, compat))


def limited_body(pages: DataFrame, most_bytes: int) -> DataFrame:
    """Cuts ``html`` to so many bytes; 0 means no limit."""
    if most_bytes <= 0:
        return pages
    return pages.withColumn("html", F.decode(F.substring(F.encode("html", "UTF-8"), 1, most_bytes), "UTF-8"))


def crawl_levels(seeds: DataFrame, edges: DataFrame, levels: int | None = None) -> DataFrame:
    """(url, depth) of all that ``edges(url, link)`` reach from ``seeds(url)``, level by level, each url once at its least depth.

    One job a level; the visited table is cut from its lineage every time, so a
    lost executor costs one level at most.  Stops when a level brings nothing
    new, or after so many levels.
    """
    visited = cut_lineage(seeds.select("url").distinct().withColumn("depth", F.lit(0).cast("long")))
    frontier, depth = visited, 0
    while levels is None or depth < levels:
        depth += 1
        links = frontier.select("url").join(edges, "url").select(F.col("link").alias("url"))
        frontier = cut_lineage(unseen(links, visited).withColumn("depth", F.lit(depth).cast("long")))
        if frontier.isEmpty():
            break
        visited = cut_lineage(visited.unionByName(frontier))
    return visited


def crawl_pages(
    seeds: DataFrame, pages: DataFrame, accept: str | None = None, reject: str | None = None, levels: int | None = None, *,
    replacements: list[tuple[str, str]] | None = None, window: tuple[str, str] | None = None, pattern: str = dates.DATE_PATTERN, max_body: int = 0,
) -> DataFrame:
    """(url, depth, status): crawls ``pages(url, html)`` from ``seeds(url)``.

    Status is visited, failed (accepted, but there is no page), rejected (by its
    url) or, with a ``window``, date_rejected: the page's latest date lies
    outside or it has none; its links are followed nevertheless.  Links are
    rewritten by ``replacements`` if they are accepted, and seeds too.  Bodies
    are cut to ``max_body`` bytes first (0: not at all).
    """
    rewritten = lambda c: F.when(urls.accepted(c, accept, reject), urls.rewrite(c, replacements)).otherwise(c) if replacements else c
    held = limited_body(pages.select("url", "html").dropDuplicates(["url"]), max_body)
    edges = cut_lineage(page_links(held, accept, reject).select("url", rewritten(F.col("link")).alias("link")).distinct())
    reached = crawl_levels(seeds.select(rewritten(F.col("url")).alias("url")), edges, levels)
    there = dated(held, *window, pattern=pattern).select("url", "in_window") if window else held.select("url", F.lit(True).alias("in_window"))
    status = F.when(~urls.accepted(F.col("url"), accept, reject), "rejected").when(F.col("in_window").isNull(), "failed").when(~F.col("in_window"), "date_rejected").otherwise("visited")
    return reached.join(there.withColumn("in_window", F.coalesce("in_window", F.lit(False))), "url", "left").select("url", "depth", status.alias("status"))


def bootstrapped(stored: DataFrame, seed_pages: DataFrame, accept: str | None = None, reject: str | None = None) -> DataFrame:
    """The stored frontier; if there is none, the seed pages and their links."""
    if not stored.isEmpty():
        return stored.select("url")
    return page_links(seed_pages, accept, reject).select(F.col("link").alias("url")).unionByName(seed_pages.select("url")).distinct()


def throughput(visits: DataFrame, ts: str = "ts", seconds: int = 10) -> DataFrame:
    """Visits in windows of so many seconds, and as a rate per minute."""
    counted = visits.groupBy(F.window(ts, f"{seconds} seconds").alias("w")).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), "n", (F.col("n") * F.lit(60 // seconds)).alias("per_minute"))
