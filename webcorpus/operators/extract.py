"""Pages to articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.functions import html, urls
from webcorpus.functions.text import once
from webcorpus.settings import MIN_ARTICLE_CHARS


def normalize_urls(df: DataFrame, url: str = "url") -> DataFrame:
    return df.withColumn("norm_url", urls.normalized_url(F.col(url)))


def url_fingerprints(df: DataFrame, url: str = "url") -> DataFrame:
    return once(df, url_fp=urls.fingerprint(F.col(url)))


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    return once(df, scheme=urls.scheme_of(F.col(url)), host=urls.host_of(F.col(url)))


def url_domain(df: DataFrame, url: str = "url") -> DataFrame:
    return df.withColumn("domain", urls.domain_of(F.col(url)))


def _marked(pages: DataFrame) -> DataFrame:
    keep = [c for c in pages.columns if c != "html"]
    return once(pages, markup=html.visible(F.col("html"))).select(*keep, "markup")


def _marked_with_data(pages: DataFrame) -> DataFrame:
    """Visible markup, and what the page's JSON-LD states, which is in its scripts."""
    keep = [c for c in pages.columns if c != "html"]
    return once(pages, markup=html.visible(F.col("html")), linked=html.linked_data(F.col("html"))) \
        .select(*keep, "markup", "linked")


def extract_text(pages: DataFrame) -> DataFrame:
    """Replace the page's HTML by its main text in Markdown."""
    return once(_marked(pages), content_md=html.markdown(F.col("markup"))).drop("markup")


def _described(marked: DataFrame) -> DataFrame:
    markup, linked = F.col("markup"), F.col("linked")
    return once(marked, title=html.title(markup, linked), published=html.published(markup, linked)) \
        .drop("markup", "linked")


def extract_metadata(pages: DataFrame) -> DataFrame:
    """Replace the page's HTML by its title and date; '' where missing."""
    return _described(_marked_with_data(pages))


def min_article_chars(df: DataFrame, min_chars: int = MIN_ARTICLE_CHARS) -> DataFrame:
    """Pages with too little text are lists, not articles."""
    return df.filter(F.length("content_md") >= min_chars)


def build_articles(pages: DataFrame, min_chars: int = MIN_ARTICLE_CHARS) -> DataFrame:
    """(page_id, url, url_fp, title, published, content_md, content_fp) of every article page.

    Text first: pages that hold no article never reach the metadata step.
    """
    with_text = once(_marked_with_data(pages), content_md=html.markdown(F.col("markup")))
    return _described(min_article_chars(with_text, min_chars)).select(
        "page_id", "url", urls.fingerprint(F.col("url")).alias("url_fp"), "title", "published",
        "content_md", F.sha1("content_md").alias("content_fp"))
