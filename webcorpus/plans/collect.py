"""Whole runs in batch: pages to the store, comment pages to the comment table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from webcorpus.operators import analytics, comments as ops
from webcorpus.operators.dedupe import content_dedupe
from webcorpus.operators.extract import build_articles
from webcorpus.operators.joins import lookup
from webcorpus.operators.quality import QualityRules, quality_filter, tag_quality
from webcorpus.schemas import PROGRESS
from webcorpus.session import written
from webcorpus.sources.articles import articles_sink
from webcorpus.sources.comments import (
    comments_sink, load_progress, save_progress, seen_comment_ids)


def run_stages(df: DataFrame, stages: dict[Callable[[DataFrame], DataFrame], int]) -> DataFrame:
    """Pass a frame through stages in ascending order of their numbers."""
    for stage in sorted(stages, key=stages.__getitem__):
        df = df.transform(stage)
    return df


def good_articles(pages: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """Unique articles of good quality; quality comes first, so dropped pages claim no content."""
    return content_dedupe(quality_filter(build_articles(pages), rules), "page_id")


def top_domains(pages: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """Top source domains of unique, good articles."""
    good = quality_filter(build_articles(pages), rules).select("page_id", "url", "content_fp")
    return analytics.domain_top10(content_dedupe(good, "page_id"))


def ingest_pages(pages: DataFrame, store: str, rules: QualityRules | None = None) -> int:
    """Extract, filter, dedupe and store a batch of pages; returns the rows inserted."""
    return ingest_articles(build_articles(pages), store, "page_id", rules)["inserted"]


def ingest_articles(articles: DataFrame, store: str, arrival: str, rules: QualityRules | None = None) -> dict[str, int]:
    """Filter, dedupe and store articles; returns dropped, duplicate, inserted and sent.

    The rows are counted while they pass on their way to the shared folder, so `articles` is computed
    once: its extraction is the costly part, and the insert reads its input twice. Inserted rows are
    sent.
    """
    seen = Observation()
    tagged = tag_quality(articles, rules).observe(
        seen, F.count_if(F.col("drop_reason").isNotNull()).alias("dropped"),
        F.count_if(F.col("drop_reason").isNull()).alias("passed"))
    good = written(tagged.filter(F.col("drop_reason").isNull()).drop("drop_reason"), "articles")
    inserted = articles_sink(good, store, arrival)
    counts = seen.get
    return {"dropped": counts["dropped"], "duplicate": counts["passed"] - inserted,
            "inserted": inserted, "sent": inserted}


def collect_comments(spark: SparkSession, posts: DataFrame, pages: DataFrame, store: str,
                     progress_path: str, cap: int | None = None,
                     fmt: str = "csv") -> None:
    """Store the new comments of all pages not done yet and move the progress on.

    Comments are stored before the progress: after a failure in between, the pages come again and
    their comments are recognised by id.
    """
    progress = load_progress(spark, progress_path)
    todo = ops.pending_posts(posts, progress).select("post", F.col("page").alias("_from"))
    left = lookup(pages, todo, "post", "inner").filter(F.col("page") > F.col("_from"))
    chosen = left if cap is None else ops.page_cap(left, cap)
    fresh = written(chosen.select(pages.columns), "pages")
    new = ops.comment_dedupe(ops.flatten_comments(fresh), seen_comment_ids(spark, store, fmt))
    comments_sink(new, store, fmt)
    save_progress(ops.comment_progress(fresh, todo.withColumnRenamed("_from", "page")).select(PROGRESS.fieldNames()), progress_path)
