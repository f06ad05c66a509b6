"""Which pages to visit next: bounded link following, budgets, per-host lists, retries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webcorpus import settings
from webcorpus.functions import urls
from webcorpus.functions.text import once
from webcorpus.operators.dedupe import first_wins, not_in, unseen
from webcorpus.operators.extract import build_articles
from webcorpus.session import written
from webcorpus.sources.store import KeyedTable


def crawl_frontier(seeds: DataFrame, links: KeyedTable, admit: Callable[[DataFrame], DataFrame],
                   depth_limit: int = settings.DEPTH_LIMIT, follow_links: bool = True,
                   known: DataFrame | None = None) -> DataFrame:
    """(url, url_fp, depth): every URL reached from `seeds` in at most `depth_limit` hops, once.

    `links` is the stored link graph (sources/links.py); no page is read. `admit` filters a frame with
    a `url` column; it sees the URLs of a hop that were not reached before, not the graph. `known` holds
    fingerprints of earlier runs; leave it out for a fresh run. A hop reads the graph in the buckets of
    the URLs it starts from, and is written to the shared folder so that plans do not grow.
    """
    start = once(admit(seeds.select("url")), url_fp=urls.fingerprint(F.col("url")))
    level = unseen(start, "url_fp", "url", known).select(
        "url", "url_fp", F.lit(0).cast("long").alias("depth"))
    reached = level = written(level, "frontier")
    state = links.state()
    for depth in range(1, depth_limit + 1 if follow_links else 1):
        pages = links.among(level.select(F.col("url_fp").alias("src_fp")), state)
        if pages is None:
            break
        fresh = not_in(first_wins(pages.select(F.inline("links")), "url_fp", "url"), "url_fp", reached)
        if known is not None:
            fresh = not_in(fresh, "url_fp", known)
        level = written(admit(fresh).select("url", "url_fp", F.lit(depth).cast("long").alias("depth")),
                        "frontier")
        if level.isEmpty():
            break
        reached = reached.unionByName(level)
    return reached


def frontier_budget(frontier: DataFrame, pages: DataFrame,
                    page_budget: int = settings.PAGE_BUDGET,
                    item_budget: int = settings.ITEM_BUDGET,
                    items_of: Callable[[DataFrame], DataFrame] = build_articles) -> DataFrame:
    """The visits made before a budget runs out, in order of (depth, url_fp).

    `items_of` turns visited pages into items; the visit that fills the item budget is the last.
    The window holds at most `page_budget` rows, and only visited pages are extracted.
    """
    visits = frontier.orderBy("depth", "url_fp").limit(page_budget)
    keyed = once(pages, url_fp=urls.fingerprint(F.col("url")))
    visited = keyed.join(visits.select("url_fp"), "url_fp", "left_semi")
    items = items_of(visited.select(pages.columns)).select("url_fp").distinct()
    before = W.orderBy("depth", "url_fp").rowsBetween(W.unboundedPreceding, -1)
    counted = visits.join(items.withColumn("_item", F.lit(1)), "url_fp", "left").withColumn(
        "_done", F.coalesce(F.sum(F.coalesce("_item", F.lit(0))).over(before), F.lit(0)))
    return counted.filter(F.col("_done") < item_budget).select(frontier.columns)


def frontier_host_cap(df: DataFrame, arrival: str, per_host: int = settings.URLS_PER_HOST,
                      host: str = "host") -> DataFrame:
    """The next fetch list: at most `per_host` URLs of each host, earliest first."""
    rank = F.row_number().over(W.partitionBy(host).orderBy(arrival))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= per_host).drop("_rank")


def retry_candidates(fetch_log: DataFrame, retries: int = settings.RETRY_TIMES) -> DataFrame:
    """URLs whose latest response calls for another try and that have tries left."""
    latest = fetch_log.groupBy("url").agg(
        F.max("attempt").alias("attempts"), F.max_by("status", "attempt").alias("last_status"))
    return latest.filter(F.col("last_status").isin(settings.RETRY_STATUSES)
                         & (F.col("attempts") <= retries))
