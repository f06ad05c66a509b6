"""First-wins dedupe, fingerprint sets and insert-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webcorpus.functions import urls
from webcorpus.functions.text import once
from webcorpus.operators.numbering import assign_ids
from webcorpus.schemas import ARTICLE_FIELDS


def first_wins(df: DataFrame, key: str, arrival: str | list[str]) -> DataFrame:
    """Keep the earliest row per key; `arrival` must order the rows of a key totally.

    The filter on the row number lets Catalyst place a group limit before the shuffle: each map
    task sends at most one row per key, so copies of one body never gather in one task.
    """
    order = [arrival] if isinstance(arrival, str) else arrival
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def not_in(df: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Rows whose key is not among the keys of `known`."""
    return df.join(known.select(key), key, "left_anti").select(df.columns)


def unseen(df: DataFrame, key: str, arrival: str | list[str],
           known: DataFrame | None = None) -> DataFrame:
    """First row per key, unless the key is already known.

    Copies go first, so the anti-join meets each key once and cannot be skewed by a hot key.
    """
    first = first_wins(df, key, arrival)
    return first if known is None else not_in(first, key, known)


def unseen_urls(df: DataFrame, arrival: str, known: DataFrame | None = None,
                url: str = "url") -> DataFrame:
    """First arrival of every URL whose fingerprint is not known yet; adds `url_fp`."""
    return unseen(once(df, url_fp=urls.fingerprint(F.col(url))), "url_fp", arrival, known)


def content_dedupe(articles: DataFrame, arrival: str = "id",
                   known: DataFrame | None = None) -> DataFrame:
    return unseen(articles, "content_fp", arrival, known)


def rank_duplicates(articles: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Number of rows that content_dedupe rejects, per fingerprint, where there are any."""
    counted = articles.groupBy("content_fp").agg(F.count("*").alias("n"))
    if known is None:
        rejected = counted.withColumn("rejected", F.col("n") - 1)
    else:
        flags = known.select("content_fp").distinct().withColumn("_known", F.lit(True))
        rejected = counted.join(flags, "content_fp", "left").withColumn(
            "rejected", F.col("n") - F.when(F.col("_known"), 0).otherwise(1))
    return rejected.filter(F.col("rejected") > 0).select("content_fp", "rejected")


def register_fingerprints(known: DataFrame, incoming: DataFrame, key: str = "url_fp") -> DataFrame:
    return known.select(key).union(incoming.select(key)).distinct()


def new_fingerprints(known: DataFrame, incoming: DataFrame, key: str = "url_fp") -> DataFrame:
    return not_in(incoming.select(key).distinct(), key, known)


def max_id(target: DataFrame) -> Column:
    """Highest id of the store as a scalar subquery; 0 when it is empty."""
    return target.select(F.coalesce(F.max("id"), F.lit(0))).scalar()


def insert_if_absent(target: DataFrame, incoming: DataFrame, arrival: str,
                     known: DataFrame | None = None) -> DataFrame:
    """The rows to append: new content fingerprints only, first arrival each, with serial ids.

    `known` may narrow the stored fingerprints to those that matter.

    Fingerprints and arrivals alone decide who wins and get numbered; the bodies are then moved
    once, joined on both. A page may arrive with several bodies, and a row may be repeated.
    `incoming` is read twice: hand in a stored or cached frame.
    """
    winners = content_dedupe(arrivals(incoming, arrival), "_at", target if known is None else known)
    return numbered(incoming, arrival, assign_ids(winners, ["_at", "content_fp"], max_id(target)))


def arrivals(incoming: DataFrame, arrival: str) -> DataFrame:
    """(_at, content_fp): all that decides which rows are inserted."""
    return incoming.select(F.col(arrival).alias("_at"), "content_fp")


def numbered(incoming: DataFrame, arrival: str, ids: DataFrame) -> DataFrame:
    """The rows of `incoming` that `ids` (_at, content_fp, id) lists, each once, as stored articles."""
    rows = incoming.withColumn("_at", F.col(arrival)).drop("id")
    # The last step meets rows that the join has dealt by the same keys: no further shuffle.
    return rows.join(ids, ["_at", "content_fp"]).dropDuplicates(["_at", "content_fp"]) \
        .select(ARTICLE_FIELDS)


def fulltext_lookup(messages: DataFrame, articles: DataFrame) -> DataFrame:
    """Messages with the stored body of their article."""
    bodies = articles.select("url_fp", "content_fp", "content_md")
    return messages.join(bodies, ["url_fp", "content_fp"])
