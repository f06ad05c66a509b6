"""Job lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus import settings
from webcorpus.functions.text import or_empty


def _brief() -> list[Column]:
    return [
        F.substring("id", 1, 8).alias("id"),
        or_empty(F.col("spider")).alias("spider"),
        F.substring(or_empty(F.col("start_time")), 1, 19).alias("start_time"),
        F.substring(or_empty(F.col("end_time")), 1, 19).alias("end_time"),
    ]


def job_briefs(jobs: DataFrame) -> DataFrame:
    return jobs.select("seq", "state", *_brief())


def elapsed_mmss(seconds: Column) -> Column:
    """Whole seconds as MM:SS; minutes may pass 59."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d", F.floor(whole / 60), F.pmod(whole, F.lit(60)))


def recent_jobs(jobs: DataFrame, finished: int = settings.RECENT_FINISHED) -> DataFrame:
    """Pending and running jobs in full, and the last `finished` finished ones.

    A top-k for the finished jobs: no window, so no state ever gathers in one task.
    """
    done = jobs.filter(F.col("state") == "finished").orderBy(F.desc("seq")).limit(finished)
    return job_briefs(jobs.filter(F.col("state").isin("pending", "running")).unionByName(done))
