"""Seed lists and host lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.functions.text import strip
from webcorpus.sources.files import exists


def seeds_source(spark: SparkSession, path: str, seed_url: str | None = None) -> DataFrame:
    """(url): the lines of a text file without blank lines and lines that start with '#'.

    An explicit `seed_url` replaces the file; a missing file holds no seeds.
    """
    if seed_url:
        return spark.createDataFrame([(seed_url,)], "url string").select(
            strip(F.col("url")).alias("url"))
    if not exists(spark, path):
        return spark.createDataFrame([], "url string")
    lines = spark.read.text(path).select(strip(F.col("value")).alias("url"))
    return lines.filter((F.col("url") != "") & ~F.col("url").startswith("#"))


def host_list(df: DataFrame, column: str = "hosts") -> DataFrame:
    """(host): the distinct entries of comma-separated lists."""
    entries = df.select(F.explode(F.split(column, ",")).alias("host")) \
        .select(strip(F.col("host")).alias("host"))
    return entries.filter(F.col("host") != "").distinct()
