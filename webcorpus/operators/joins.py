"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than one in this many rows, so there are fewer hot keys than this.
HOT_KEYS = 1000


def is_small(table: DataFrame) -> bool:
    """Whether Catalyst's size estimate lets it broadcast `table`; runs no job."""
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that hold more than 1 / HOT_KEYS of all rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") * HOT_KEYS > total).select(key)


def lookup(df: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join `df` with `table`, which has one row per (non-null) key; how: left, inner or left_semi.

    A table small enough to be broadcast is simply joined. Otherwise rows of hot keys meet a
    broadcast of their few table rows first. These rows, and those without a key, are settled then:
    they go through the one shuffle join under a number of their own, evenly spread, and find
    nothing there. Adaptive execution would not split hot keys here: it leaves joins alone whose
    other side is an aggregate. Of `df` the key is read once more, to count.
    """
    if is_small(table):
        return df.join(table, key, how)
    others = [c for c in table.columns if c != key]
    found = table.select(key, F.struct(F.lit(True).alias("_found"), *others).alias("_row"))
    hot = hot_keys(df.select(key), key).filter(F.col(key).isNotNull())
    few = hot.join(found, key, "left").select(
        key, F.lit(True).alias("_hot"), F.col("_row").alias("_few"))
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    place = F.when(settled, F.monotonically_increasing_id()).otherwise(F.xxhash64(key))
    joined = (df.join(F.broadcast(few), key, "left").withColumn("_place", place)
              .join(found.withColumn("_place", F.xxhash64(key)), [key, "_place"], "left")
              .withColumn("_row", F.coalesce("_few", "_row")))
    if how != "left":
        joined = joined.filter(F.col("_row").isNotNull())
    added = [] if how == "left_semi" else [F.col("_row")[c].alias(c) for c in others]
    return joined.select(key, *[c for c in df.columns if c != key], *added)
