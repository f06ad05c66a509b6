"""Dashboard figures that refresh themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webcorpus import settings
from webcorpus.operators import analytics

# Refreshes kept per view, so that a reader never meets the one being replaced.
SLOTS = 8


def _refresh(path: str) -> Callable[[DataFrame, int], None]:
    def write(view: DataFrame, batch: int) -> None:
        # A batch that runs again after a failure replaces its own slot.
        (view.withColumn("batch", F.lit(batch).cast("long")).coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/slot={batch % SLOTS}"))
    return write


def stream_stats(articles: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """Keep counts per day and the top domains of a stream of articles below `path`.

    Both folders must be shared by all executors. A query goes on from its checkpoint after a
    restart. What depends on the present day is derived when read, see `totals`.
    """
    views = {"days": analytics.day_counts(articles), "domains": analytics.domain_top10(articles)}
    when = trigger or {"processingTime": settings.STATS_INTERVAL}
    return {view: df.writeStream.foreachBatch(_refresh(f"{path}/{view}")).outputMode("complete")
                    .option("checkpointLocation", f"{checkpoint}/{view}").trigger(**when).start()
            for view, df in views.items()}


def _latest(spark: SparkSession, path: str) -> DataFrame:
    """The last refresh of a view: a row per day, or at most ten domains, in each slot."""
    slots = spark.read.option("ignoreMissingFiles", True).parquet(path)
    last = slots.agg(F.max("batch")).scalar()
    return slots.filter(F.col("batch") == last).drop("batch", "slot")


def totals(spark: SparkSession, path: str, as_of: str | None = None) -> DataFrame:
    """total, and today: the articles collected on the day `as_of` (default: the day of reading)."""
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    return _latest(spark, f"{path}/days").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("day") == day, F.col("count"))), F.lit(0)).alias("today"))


def domains(spark: SparkSession, path: str) -> DataFrame:
    return _latest(spark, f"{path}/domains").orderBy(F.desc("value"), "name")


def trend(spark: SparkSession, path: str) -> DataFrame:
    """Articles per month-day, over all years."""
    return (_latest(spark, f"{path}/days").groupBy(F.date_format("day", "MM-dd").alias("date"))
            .agg(F.sum("count").alias("count")).orderBy("date"))
