"""Reports over the article store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webcorpus import settings
from webcorpus.functions import urls
from webcorpus.functions.text import or_default
from webcorpus.operators.quality import QualityRules, tag_quality

# Consecutive ids that are counted together, to find the place of a list page.
BLOCK = 1 << 16
# Buckets of a sketch as a power of two: the standard error of its counts is 1.04 / sqrt(2 ** SKETCH), 1.6 %.
SKETCH = 12


def article_totals(articles: DataFrame, as_of: str | None = None) -> DataFrame:
    """total, and today: the articles collected on the day `as_of` (default: the current date)."""
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    return articles.agg(
        F.count("*").alias("total"),
        F.count_if(F.to_date("crawled_at") == day).alias("today"))


def article_count(articles: DataFrame) -> DataFrame:
    return articles.agg(F.count("*").alias("total"))


def domain_counts(articles: DataFrame) -> DataFrame:
    return articles.groupBy(urls.domain_of(F.col("url")).alias("name")).agg(
        F.count("*").alias("value"))


def domain_top10(articles: DataFrame, n: int = settings.TOP_DOMAINS) -> DataFrame:
    """The `n` domains with most articles; ties by name."""
    return domain_counts(articles).orderBy(F.desc("value"), "name").limit(n)


def day_counts(articles: DataFrame) -> DataFrame:
    """Articles per day of collection."""
    return articles.groupBy(F.to_date("crawled_at").alias("day")).agg(F.count("*").alias("count"))


def daily_trend(articles: DataFrame) -> DataFrame:
    """Articles per month-day; the same day of different years is one row."""
    return (articles.groupBy(F.date_format("crawled_at", "MM-dd").alias("date"))
            .agg(F.count("*").alias("count")).orderBy("date"))


def kpi_cards(articles: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row: total, today, number of domains shown, articles on the busiest day."""
    shown = domain_top10(articles).agg(F.count("*")).scalar()
    peak = daily_trend(articles).agg(F.max("count")).scalar()
    return article_totals(articles, as_of).select(
        "total", "today", shown.alias("domains"),
        F.greatest(F.lit(0), F.coalesce(peak, F.lit(0))).cast("long").alias("peak_day"))


def domain_share(articles: DataFrame) -> DataFrame:
    """Percentage of each shown domain within the shown ones (at most ten rows)."""
    share = 100 * F.col("value") / F.sum("value").over(W.partitionBy())
    return domain_top10(articles).withColumn("share", F.round(share, 4))


def fingerprint_cardinality(articles: DataFrame, approximate: bool = False) -> DataFrame:
    """Sizes of the URL and the content fingerprint set."""
    size = F.approx_count_distinct if approximate else F.count_distinct
    return articles.agg(size("url_fp").alias("urls"), size("content_fp").alias("contents"))


def fingerprint_sketch(articles: DataFrame, size: int = SKETCH) -> DataFrame:
    """One row: the URL and the content fingerprints of a load as sketches, some kilobytes each."""
    return articles.agg(F.hll_sketch_agg("url_fp", F.lit(size)).alias("urls"),
                        F.hll_sketch_agg("content_fp", F.lit(size)).alias("contents"))


def sketched_cardinality(sketches: DataFrame) -> DataFrame:
    """Estimated sizes of the sets that the sketches of several loads make up together."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("urls")).alias("urls"),
                        F.hll_sketch_estimate(F.hll_union_agg("contents")).alias("contents"))


def ingest_run_stats(incoming: DataFrame, target: DataFrame,
                     rules: QualityRules | None = None) -> DataFrame:
    """One row: dropped, duplicate, inserted and sent of one run over `incoming`.

    Counted per fingerprint, so bodies never move; of each passing fingerprint one row is
    inserted unless the store has it, and the rest are duplicates. Inserted rows are sent.
    """
    per_fp = tag_quality(incoming, rules).groupBy("content_fp").agg(
        F.count_if(F.col("drop_reason").isNotNull()).alias("_dropped"),
        F.count_if(F.col("drop_reason").isNull()).alias("_passed"))
    stored = target.select("content_fp").distinct().withColumn("_stored", F.lit(True))
    new = (F.col("_passed") > 0) & F.col("_stored").isNull()
    return per_fp.join(stored, "content_fp", "left").agg(
        F.coalesce(F.sum("_dropped"), F.lit(0)).alias("dropped"),
        F.coalesce(F.sum(F.col("_passed") - new.cast("long")), F.lit(0)).alias("duplicate"),
        F.count_if(new).alias("inserted"),
        F.count_if(new).alias("sent"))


def _minute(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def article_rows(articles: DataFrame) -> DataFrame:
    """List view: everything but the body, of which only the length is shown."""
    return articles.select(
        "id", or_default(F.col("title"), settings.NO_TITLE).alias("title"), "url",
        or_default(F.col("published"), settings.NO_DATE).alias("published"),
        F.length("content_md").cast("long").alias("content_len"),
        _minute("crawled_at").alias("crawled_at"))


def id_blocks(articles: DataFrame, block: int = BLOCK) -> DataFrame:
    """(block, n): how many ids each range of `block` ids holds. A small table, which may be stored."""
    return articles.groupBy(F.floor(F.col("id") / block).alias("block")).agg(F.count("*").alias("n"))


def _page_ids(articles: DataFrame, offset: int, size: int, blocks: DataFrame, block: int) -> DataFrame:
    """(id): the ids of one page, newest first.

    The counts of the blocks tell which of them hold the page, one or a few; only their ids are ordered.
    """
    newer = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    placed = blocks.withColumn("_before", F.coalesce(F.sum("n").over(newer), F.lit(0)))
    hit = placed.filter((F.col("_before") < offset + size) & (F.col("_before") + F.col("n") > offset))
    found = hit.agg(F.struct(F.min("block").alias("first"), F.max("block").alias("last"),
                             F.min("_before").alias("before"))).scalar()
    ids = articles.select("id").filter((F.col("id") >= found["first"] * block)
                                       & (F.col("id") < (found["last"] + 1) * block))
    rank = found["before"] + F.row_number().over(W.orderBy(F.desc("id")))
    return ids.withColumn("_rank", rank).filter(F.col("_rank").between(offset + 1, offset + size)).select("id")


def article_page(articles: DataFrame, page: int = 1, size: int = settings.PAGE_SIZE,
                 blocks: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """One page of the list, newest id first; page and size are clamped to their legal range.

    One plan for pages of any depth: counts per block of ids find the place, the ids of that place are
    ordered, and their bounds go to the scan as a range, so only the row groups that hold the page
    give up their bodies. `blocks` may be a stored id_blocks(articles, block).
    """
    size = min(max(size, 1), settings.MAX_PAGE_SIZE)
    counted = id_blocks(articles, block) if blocks is None else blocks
    ids = _page_ids(articles, (max(page, 1) - 1) * size, size, counted, block)
    ends = ids.agg(F.struct(F.min("id").alias("low"), F.max("id").alias("high"))).scalar()
    shown = articles.filter((F.col("id") >= ends["low"]) & (F.col("id") <= ends["high"]))
    return article_rows(shown).orderBy(F.desc("id"))


def article_detail(articles: DataFrame, article_id: int) -> DataFrame:
    """One article with its body; no row when there is none."""
    return articles.filter(F.col("id") == article_id).select(
        "id", or_default(F.col("title"), settings.NO_TITLE).alias("title"), "url",
        or_default(F.col("published"), settings.NO_DATE).alias("published"), "content_md",
        _minute("crawled_at").alias("crawled_at"))


def content_length_meta(articles: DataFrame) -> DataFrame:
    """Length of the shown body in characters."""
    return articles.select("id", F.length("content_md").cast("long").alias("content_len"))
