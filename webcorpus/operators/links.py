"""Link discovery: which article links a page holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.functions import html, urls
from webcorpus.functions.text import once
from webcorpus.settings import ERROR_WORD


def _with_markup(pages: DataFrame) -> DataFrame:
    return once(pages.select("page_id", "url", "html"),
                markup=html.linking(F.col("html"))).drop("html")


def _targets() -> Column:
    return F.transform(html.hrefs(F.col("markup")), lambda h: urls.resolve(F.col("url"), h))


def extract_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, href): one row per `<a href>`."""
    return _with_markup(pages).select(
        "page_id", "url", F.explode(html.hrefs(F.col("markup"))).alias("href"))


def resolve_links(links: DataFrame) -> DataFrame:
    """Add `abs_url`: the link target as an absolute URL."""
    return once(links, abs_url=urls.resolve(F.col("url"), F.col("href")))


def article_url_filter(links: DataFrame, url: str = "abs_url") -> DataFrame:
    return links.filter(urls.is_article_url(F.col(url)))


def error_link_filter(links: DataFrame, url: str = "abs_url") -> DataFrame:
    return links.filter(~F.col(url).contains(ERROR_WORD))


def page_link_distinct(pages: DataFrame) -> DataFrame:
    """(page_id, url, abs_url): each link target once per page.

    Repeats are dropped inside the row, before the links become rows: no shuffle.
    """
    return _with_markup(pages).select(
        "page_id", "url", F.explode(F.array_distinct(_targets())).alias("abs_url"))


def _wanted() -> Column:
    """The links of a page worth following, each once."""
    return F.array_distinct(F.filter(_targets(), lambda u: urls.is_article_url(u) & ~u.contains(ERROR_WORD)))


def article_links(pages: DataFrame) -> DataFrame:
    """(page_id, url, abs_url): links worth following, each once per page."""
    return _with_markup(pages).select("page_id", "url", F.explode(_wanted()).alias("abs_url"))


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, src_fp, links): a row per page, also without links; each link with its fingerprint."""
    linked = F.transform(_wanted(), lambda u: F.struct(u.alias("url"), urls.fingerprint(u).alias("url_fp")))
    return _with_markup(pages).select("page_id", urls.fingerprint(F.col("url")).alias("src_fp"), linked.alias("links"))
