"""Raw comment pages to comments, and the progress of their collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus import schemas, settings
from webcorpus.functions.text import once, or_empty
from webcorpus.operators.dedupe import unseen
from webcorpus.operators.numbering import running_total
from webcorpus.session import written


def parse_pages(raw: DataFrame) -> DataFrame:
    """(post, page, data, max_id) from (post, page, body) with `body` as JSON."""
    parsed = once(raw, _doc=F.from_json("body", schemas.COMMENT_PAGE))
    return parsed.select("post", "page", "_doc.*")


def flatten_comments(pages: DataFrame) -> DataFrame:
    """One row per comment, with its place on the page; missing values are ''."""
    rows = pages.select("post", "page", F.posexplode("data").alias("pos", "c"))
    return rows.select(
        "post", "page", F.col("pos").cast("long").alias("pos"),
        or_empty(F.col("c.id")).alias("id"),
        or_empty(F.col("c.user.screen_name")).alias("screen_name"),
        F.replace(or_empty(F.col("c.source")), F.lit(settings.REGION_PREFIX), F.lit(""))
         .alias("region"),
        or_empty(F.col("c.text_raw")).alias("text"))


def next_page_token(pages: DataFrame) -> DataFrame:
    """(post, page, next_max_id): 0 when there is no further page."""
    return pages.select("post", "page",
                        F.coalesce("max_id", F.lit(0)).cast("long").alias("next_max_id"))


def comment_dedupe(comments: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """First occurrence of every comment id that is not known; ids compare as text."""
    return unseen(comments.withColumn("id", F.col("id").cast("string")), "id",
                  ["post", "page", "pos"], known)


def _page_counts(pages: DataFrame, known: DataFrame | None) -> DataFrame:
    """(post, page, n_rows, n_new); a page without comments counts as a page with 0 rows."""
    new = comment_dedupe(flatten_comments(pages), known).groupBy("post", "page").agg(
        F.count("*").alias("n_new"))
    held = F.when(F.col("data").isNull(), 0).otherwise(F.size("data")).cast("long")
    every = pages.groupBy("post", "page").agg(F.sum(held).alias("n_rows"))
    return every.join(new, ["post", "page"], "left").select(
        "post", "page", "n_rows", F.coalesce("n_new", F.lit(0)).alias("n_new"))


def comment_page_totals(pages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Comments and new comments per post."""
    return _page_counts(pages, known).groupBy("post").agg(
        F.sum("n_rows").alias("comments"), F.sum("n_new").alias("new_comments"))


def comment_page_log(pages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per page: rows, new rows, and the running total of new rows of the post.

    The page counts, a small table that is read twice, are written to the shared folder.
    """
    counts = written(_page_counts(pages, known), "page-counts")
    return running_total(counts, ["post"], "page", F.col("n_new"), "total")


def page_cap(pages: DataFrame, cap: int = settings.PAGES_PER_POST) -> DataFrame:
    return pages.filter(F.col("page") <= cap)


def comment_progress(pages: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Per post: last page of the unbroken run, its continuation token, and whether it is the end.

    The run begins behind the page that `start` (post, page) gives, or at page 1. Pages beyond a gap
    do not count, so that what is missing is not passed over; a post without its next page has no
    row. The run's end is the lowest page without a successor: no group is sorted.
    """
    tokens = next_page_token(pages).groupBy("post", "page").agg(F.max("next_max_id").alias("max_id"))
    origin = tokens.select("post", F.lit(0).cast("long").alias("page")).distinct()
    if start is not None:
        given = start.select("post", F.col("page").alias("_from"))
        origin = origin.join(given, "post", "left").select(
            "post", F.coalesce("_from", "page").cast("long").alias("page"))
    every = tokens.select("post", "page").union(origin)
    before = tokens.select("post", (F.col("page") - 1).alias("page"))
    ends = every.join(before, ["post", "page"], "left_anti").groupBy("post").agg(F.min("page").alias("page"))
    if start is not None:  # a page behind the start may lack its successor
        ends = every.join(before, ["post", "page"], "left_anti").join(
            origin.withColumnRenamed("page", "_from"), "post").filter("page >= _from") \
            .groupBy("post").agg(F.min("page").alias("page"))
    return tokens.join(ends, ["post", "page"]).select("post", "max_id", "page") \
        .withColumn("done", F.col("max_id") == 0)


def pending_posts(posts: DataFrame, progress: DataFrame) -> DataFrame:
    """Posts not complete yet, with the token and page to go on from (0, 0 for a new post)."""
    state = posts.select("post").join(progress, "post", "left")
    return state.filter(~F.coalesce("done", F.lit(False))).select(
        "post", F.coalesce("max_id", F.lit(0)).cast("long").alias("max_id"),
        F.coalesce("page", F.lit(0)).cast("long").alias("page"))


def seen_count(comments: DataFrame) -> DataFrame:
    return comments.agg(F.count_distinct(F.col("id").cast("string")).alias("seen"))
